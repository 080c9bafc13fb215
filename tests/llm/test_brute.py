"""Fingerprints, language profiles and shards against versions by definition."""

import hashlib
import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from brisa.llm import langid, shards, winnow
from tests.llm import brute

U64 = (1 << 64) - 1


# --- winnowing ----------------------------------------------------------------


def mixed(h):
    """The finalizer of the rolling hash: fixed constants."""
    h ^= h >> 33
    h = h * 0xFF51AFD7ED558CCD & U64
    h ^= h >> 29
    h = h * 0xC4CEB9FE1A85EC53 & U64
    return h ^ (h >> 32)


def hashes(text, k):
    """Hash of every run of k code points, by Horner's rule for each by itself."""
    out = []
    for i in range(len(text) - k + 1):
        h = 0
        for c in text[i : i + k]:
            h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) & U64
        out.append(mixed(h))
    return out


def kept(text, k=winnow.K, window=winnow.WINDOW):
    """(hash, place) of the least hash of every window, the rightmost of equal ones; hashes
    are told apart by their first 44 bits."""
    h = hashes(text, min(k, len(text))) if text else []
    found = []
    for at in range(max(1, len(h) - window + 1) if h else 0):
        place = min(range(at, min(at + window, len(h))), key=lambda i: (h[i] >> 20, -i))
        if not found or found[-1] != (h[place], place):
            found.append((h[place], place))
    return found


def test_winnow_by_definition():
    rng = random.Random(1)
    for _ in range(300):
        letters = rng.choice(["ab", "abc é", "日本語🙂x "])
        text = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 15, 16, 17, 63, 64, 65, 300])))
        k, window = rng.choice([(16, 49), (3, 4), (5, 1)])
        h, p = winnow.winnow(text, k, window)
        assert list(zip(h.tolist(), p.tolist())) == kept(text, k, window)


def test_fingerprints_of_the_query(spark, sf):
    docs = sorted(brute.documents(sf), key=lambda d: d["doc_id"])
    rows = {r.doc_id: r for r in entry.queries()["op3_fingerprints"](spark, sf).collect()}

    def named(found):
        h, p = (np.array(x, t) for x, t in zip(zip(*found) if found else ((), ()), (np.uint64, np.int64)))
        return hashlib.blake2b(h.tobytes() + p.tobytes(), digest_size=16).hexdigest()

    short = [i for i, d in enumerate(docs) if len(d["text"]) < 1_500]
    assert len(short) > 50
    for i in short:
        text, after = docs[i]["text"], docs[(i + 1) % len(docs)]["text"]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r, a, b = rows[docs[i]["doc_id"]], kept(text), kept(edited)
        assert (r.fingerprint, r.edited_fingerprint) == (named(a), named(b))
        x, y = ({h for h, _ in f} for f in (a, b))
        assert r.near_edited == pytest.approx(len(x & y) / len(x | y) if x | y else 1.0)


# --- language profiles ----------------------------------------------------------


def letter_vector(code):
    bits = hashlib.shake_128(b"letter %d" % code).digest(langid.DIMENSIONS // 8)
    return np.array([1 if b >> (7 - i) & 1 else -1 for b in bits for i in range(8)])


def profile(text):
    """Unit sum over all runs of three letters (a gap counts as one, so do both ends) of the
    product of the letters' vectors, each rotated by how far it stands from the end."""
    codes = [0]
    for c in text or "":
        code = ord(c.lower()[0]) if c.isalpha() else 0
        if code or codes[-1]:
            codes.append(code)
    if codes[-1]:
        codes.append(0)
    if not any(codes):
        return None
    vectors = {c: letter_vector(c) for c in set(codes)}
    out = np.zeros(langid.DIMENSIONS)
    for gram, n in Counter(zip(codes, codes[1:], codes[2:])).items():
        out += n * np.prod([np.roll(vectors[c], langid.N - 1 - i) for i, c in enumerate(gram)], axis=0)
    size = np.linalg.norm(out)
    return out / size if size else None


def test_vectors_by_definition():
    for text in ("Hello, world", "a", "  x  ", "naïve Straße ÄÖÜ", "日本語 und 🙂 mehr", "a-b--c", "12 !", ""):
        want, got = profile(text), langid.vector(text)
        assert (want is None) == (got is None), text
        if want is not None:
            assert np.allclose(got, want, atol=1e-5), text


def test_predictions_by_definition(spark, sf):
    docs = brute.documents(sf)
    out = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0 for d in docs}
    vectors = {d["doc_id"]: profile(d["text"]) for d in docs}
    sums = defaultdict(lambda: np.zeros(langid.DIMENSIONS))
    for d in docs:
        if not out[d["doc_id"]] and d["lang"] is not None and vectors[d["doc_id"]] is not None:
            sums[d["lang"]] += vectors[d["doc_id"]]
    names = sorted(sums)
    prototypes = np.array([sums[n] / np.linalg.norm(sums[n]) for n in names])
    centre = prototypes.mean(axis=0)
    for r in entry.queries()["op6_language_id"](spark, sf).collect():
        assert r.held_out == out[r.doc_id]
        v = vectors[r.doc_id]
        if v is None:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosines = [(p - centre) @ (v - centre) / np.linalg.norm(p - centre) / np.linalg.norm(v - centre) for p in prototypes]
        assert r.score == pytest.approx((1 + max(cosines)) / 2, abs=1e-5)
        assert cosines[names.index(r.lang_pred)] == pytest.approx(max(cosines), abs=1e-5)


# --- shards -----------------------------------------------------------------------


def point(*values):
    """The session's 64-bit hash of some longs, one after the other."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
    return h


def test_owners_by_definition(spark):
    """Rows class by class of falling size, inside a class by cell of the ring and point: each
    belongs to the next virtual node clockwise whose shard still has room where it begins."""
    sf = "/root/testdata/sf0.01"
    docs = brute.documents(sf)
    rows = {r.doc_id: r for r in entry.queries()["op8_sharding"](spark, sf).collect()}
    assert len(rows) == len(docs) == len({d["doc_id"] for d in docs})
    given = []
    for d in docs:
        data = (d["text"] or "").encode()
        size, crc = len(data) + 1, zlib.crc32(data)
        r = rows[d["doc_id"]]
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (size, crc, "bytes", None)
        p = point(d["doc_id"], crc)
        signed = p - (1 << 64) if p >> 63 else p
        given.append((-int(math.log2(size)), p >> 52, signed, d["doc_id"], size))
    circle = sorted(
        (int.from_bytes(hashlib.md5(f"{s}:{v}".encode()).digest()[:8], "big"), s) for s in range(8) for v in range(shards.VIRTUAL_NODES)
    )
    room = {s: (1 + shards.SLACK) * sum(g[4] for g in given) / 8 for s in range(8)}
    cells = defaultdict(list)
    for g in sorted(given):
        cells[g[:2]].append(g)
    for (_, cell), own in sorted(cells.items()):
        load, cuts, at = sum(g[4] for g in own), [], 0.0
        start = next((i for i, (p, _) in enumerate(circle) if p >= cell << 52), 0)
        for _, s in circle[start:] + circle[:start]:
            if at >= load:
                break
            share = min(load - at, room[s])
            if share > 0 and all(s != c for _, c in cuts):
                cuts.append((at, s))
                room[s] -= share
                at += share
        before = 0
        for *_, doc, size in own:
            assert rows[doc].shard == [s for a, s in cuts if a <= before][-1]
            before += size
    for s in range(8):
        assert sorted(r.slot for r in rows.values() if r.shard == s) == list(range(sum(r.shard == s for r in rows.values())))
