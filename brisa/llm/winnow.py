"""Document fingerprints by winnowing.

Every run of K code points has a rolling hash. Of every WINDOW consecutive hashes the
smallest is kept with its position, the rightmost of equal ones. Two texts that share
K + WINDOW - 1 code points in a row therefore share a kept hash, and the positions
say where. Texts shorter than that keep the smallest of what they have; a text
shorter than K is hashed as a whole; an empty or null text keeps nothing.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 16
WINDOW = 49
#: Window starts handled at once: bounds memory on very long texts.
_BLOCK = 1 << 19
#: Low bits of a sort key that hold the place inside a block.
_PLACE = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def kgram_hashes(codes: np.ndarray, k: int = K) -> np.ndarray:
    """Hash of every run of k codes, by doubling: h(2m) at i joins h(m) at i and i + m."""
    out, done, part, size = None, 0, codes + np.uint64(1), 1
    while True:
        if k & size:
            if out is None:
                out, done = part, size
            else:
                n = len(codes) - done - size + 1
                out = out[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + part[done : done + n]
                done += size
        if done == k:
            return _mixed(out)
        part = part[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + part[size:]
        size *= 2


def _minima(keys: np.ndarray, window: int) -> np.ndarray:
    """Smallest key of every window."""
    size = 1
    while size * 2 <= window:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    rest = window - size
    return np.minimum(keys[:-rest], keys[rest:]) if rest else keys


def winnow(text: str | None, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes of a whole text and their positions, in order of position."""
    if not text:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(text) < k:
        return kgram_hashes(_codes(text), len(text)), np.zeros(1, np.int64)
    hashes, places = [], []
    total = len(text) - k + 1
    starts = max(1, total - window + 1)
    for at in range(0, starts, _BLOCK):
        h = kgram_hashes(_codes(text[at : min(at + _BLOCK, starts) + window - 1 + k - 1]), k)
        order = _PLACE - np.arange(len(h), dtype=np.uint64)
        least = _minima((h & ~_PLACE) | order, min(window, len(h)))
        keep = np.ones(len(least), bool)
        keep[1:] = least[1:] != least[:-1]
        local = (_PLACE - (least[keep] & _PLACE)).astype(np.int64)
        hashes.append(h[local])
        places.append(local + at)
    h, p = np.concatenate(hashes), np.concatenate(places)
    new = np.ones(len(p), bool)
    new[1:] = p[1:] != p[:-1]  # a block may begin with the last one's choice
    return h[new], p[new]


def digest(h: np.ndarray, p: np.ndarray) -> str:
    """Short name of a fingerprint: 32 hex digits over its hashes and positions."""
    return hashlib.blake2b(h.tobytes() + p.tobytes(), digest_size=16).hexdigest()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two fingerprints' hashes; two empty ones are alike."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def fingerprints(df: DataFrame, text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """Add ``fp_hashes`` (array<long>, unsigned bits) and ``fp_positions`` (array<long>).

    Columns of these names are replaced, others kept; repeated rows stay rows.
    """

    @F.pandas_udf("fp_hashes array<long>, fp_positions array<long>")
    def kept(texts):
        import pandas as pd

        found = [winnow(t, k, window) for t in texts]
        return pd.DataFrame(
            {"fp_hashes": [h.view(np.int64) for h, _ in found], "fp_positions": [p for _, p in found]}
        )

    both = df.withColumn("__fp", kept(F.col(text)))
    return both.withColumns({c: F.col(f"__fp.{c}") for c in ("fp_hashes", "fp_positions")}).drop("__fp")


#: Bytes of text in a part of the order, and the most parts there are.
PART_BYTES = 8 << 20
MAX_PARTS = 20_000
#: Sampled rows for each part.
_PER_PART = 50


def _rank(key, mark):
    return (key is not None, 0 if key is None else key, mark)


def in_order(df: DataFrame, key: str, text: str) -> tuple[DataFrame, int]:
    """Rows as (part, wrap, key, mark, copy, text): parts follow each other in the order
    of the key (nulls first, ties by a hash of the text), and every part also holds a
    copy of the row that comes after its last one (the last part: the first row).

    Parts begin at sampled rows, so the row after a part's last one is known beforehand
    and neighbours never need a window over the whole table.
    """
    rows = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    size = rows.agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b"), F.min(F.struct("key", "mark")).alias("first")
    ).first()
    parts = min(MAX_PARTS, 1 + (size.b or 0) // PART_BYTES)
    sample = []
    if parts > 1:
        share = min(1.0, _PER_PART * parts / size.n)
        sample = sorted(_rank(r.key, r.mark) for r in rows.select("key", "mark").sample(share, seed=3).collect())
    starts = sorted({sample[i * len(sample) // parts] for i in range(1, parts)} if sample else set())
    first = _rank(*size.first) if size.n else None
    last = len(starts)

    @F.pandas_udf("array<struct<part: int, wrap: int, copy: int>>")
    def dealt(keys, marks):
        import pandas as pd

        out = []
        for k, m in zip(keys.astype(object), marks, strict=True):
            rank = _rank(None if pd.isna(k) else k, m)
            part = bisect.bisect_right(starts, rank)
            to = [{"part": part, "wrap": 0, "copy": 0}]
            if part and rank == starts[part - 1]:
                to.append({"part": part - 1, "wrap": 0, "copy": 1})
            if rank == first:
                to.append({"part": last, "wrap": 1, "copy": 1})
            out.append(to)
        return pd.Series(out)

    rows = rows.withColumn("to", F.explode(dealt("key", "mark"))).select("to.*", "key", "mark", "text")
    rows = rows.repartitionById(last + 1, F.col("part"))
    return rows.sortWithinPartitions("wrap", F.asc_nulls_first("key"), "mark", "copy"), last + 1


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many of another text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edit_likeness(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and how like the edited
    and the next document's fingerprints are to it. Null texts count as empty."""
    rows, _ = in_order(df, key, text)
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def compared(batches):
        before = None
        over = False
        for batch in batches:
            out = []
            for k, copy, value in zip(
                batch.column("key").to_pylist(), batch.column("copy").to_pylist(), batch.column("text"), strict=True
            ):
                if over:
                    break
                value = value.as_py() or ""
                h, p = winnow(value)
                if before is not None:
                    bk, bt, bh, bp = before
                    new = edited(bt, value)
                    eh, ep = winnow(new)
                    sha = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((bk, len(bt), sha, digest(bh, bp), digest(eh, ep), likeness(bh, eh), likeness(bh, h)))
                before, over = (k, value, h, p), bool(copy)
            columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return rows.select("key", "copy", "text").mapInArrow(compared, schema)


