"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter

import duckdb
import xxhash

from brisa.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(sf_dir, table="documents"):
    return duckdb.sql(f"SELECT * FROM '{sf_dir}/{table}.parquet'").to_arrow_table().to_pylist()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def simhash(text):
    w = WORD.findall(lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(fps, bits=4):
    """Index of the first member of each item's component."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= bits:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [find(i) for i in range(len(fps))]


def kept_bytes(texts, width=200):
    """(kept, removed, spans) of each text without strings that begin elsewhere."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        covered = bytearray(len(d))
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                covered[i : i + width] = b"\1" * width
        spans = sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered))
        out.append((bytes(b for b, c in zip(d, covered) if not c), sum(covered), spans))
    return out


def base_figures(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    again = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again)


def mixed(rows):
    """(doc_id, text, low, high) for every pass of the mix over rows (doc_id, source, text)."""
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += len(WORD.findall(text or ""))
    goal = mixing.targets(dict(sizes))
    out = []
    for source in goal:
        own = []
        for doc, s, text in rows:
            if s == source:
                order = hashlib.md5(f"mix:{'' if doc is None else doc}".encode()).hexdigest()
                own.append((order, len(WORD.findall(text or "")), doc, text))
        start = 0
        own.sort(key=lambda x: x[:2])
        for _, size, doc, text in own:
            for n in range(math.ceil(int(goal[source]) / max(1, sizes[source]))):
                high = min(size, int(goal[source]) - n * sizes[source] - start)
                if high > 0:
                    out.append((doc, text, 0, high))
            start += size
    return out
