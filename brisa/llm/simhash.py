"""Near duplicates: 64-bit SimHash fingerprints matched by Golay-code fuzzy hashing.

The perfect binary Golay code puts each of the 2**23 words within three bits of
exactly one of 4,096 codewords. The words within one bit of a segment decode to one or
six codewords; two segments that differ in at most two bits always share one of them
(both are one bit from a word between them), so codeword numbers are fuzzy keys.

A fingerprint is three segments of 22, 21 and 21 bits. Of at most four differing bits
some two segments hold at most two, for the third holds the most: so a pair of
segments shares a key in both. Fingerprints meet on (pair, key, key), about 84 rows
for each distinct fingerprint, and those that meet are verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.components import components
from brisa.llm.text import hold, row_mark, stored, trim
from brisa.operators.sizes import join_checked

SHINGLE = 4
SEED = 42
BITS = 4
#: (shift, width) of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
_PAIRS = ((0, 1), (0, 2), (1, 2))
#: Fixed value: generator polynomial of the Golay code.
_GENERATOR = 0b101011100011
#: Fingerprints of one key that are compared in one place; more are split in blocks.
BLOCK = 8_192
_HASHED = 65_536


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of the lower-cased words' shingles, repeats included; 0 without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII gaps only
    if not words:
        return 0
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(joined)]))
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_intdigest
    return majority(
        [digest(joined[a:b], seed) for a, b in zip(first[at : at + _HASHED], last[at : at + _HASHED], strict=True)]
        for at in range(0, n, _HASHED)
    )


def majority(parts: Iterable) -> int:
    """SimHash of 64-bit hashes that come in parts: the bits that over half of them have set."""
    n, ones = 0, np.zeros(64, np.int64)
    for hashes in parts:
        raw = np.asarray(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(raw)
    bits = (2 * ones > n).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


_golay: list[np.ndarray] = []


def decoder() -> np.ndarray:
    """Number of the codeword within three bits of every 23-bit word."""
    hold("golay", _golay.clear)
    if not _golay:
        data = np.arange(4096, dtype=np.uint32) << 11
        rest = data.copy()
        for bit in range(22, 10, -1):
            rest = np.where(rest >> bit & 1, rest ^ (_GENERATOR << bit - 11), rest)
        code = data | rest
        one = 1 << np.arange(23, dtype=np.uint32)
        two = (one[:, None] | one)[np.triu_indices(23, 1)]
        three = (two[:, None] | one).ravel()
        three = np.unique(three[np.bitwise_count(three) == 3])
        table = np.empty(1 << 23, np.uint16)
        for errors in (np.zeros(1, np.uint32), one, two, three):
            for e in errors:
                table[code ^ e] = np.arange(4096, dtype=np.uint16)
        _golay.append(table)
    return _golay[0]


def segment_keys(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Codeword numbers around each word, one row a word, and which entries count."""
    flips = np.concatenate(([0], 1 << np.arange(width))).astype(np.uint32)
    keys = np.sort(decoder()[words.astype(np.uint32)[:, None] ^ flips], axis=1)
    new = np.ones(keys.shape, bool)
    new[:, 1:] = keys[:, 1:] != keys[:, :-1]
    # At most six differ: move them to the front.
    order = np.argsort(~new, axis=1, kind="stable")[:, :6]
    return np.take_along_axis(keys, order, 1), np.take_along_axis(new, order, 1)


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) rows of unsigned fingerprints."""
    found = [segment_keys(fps >> np.uint64(s) & np.uint64((1 << w) - 1), w) for s, w in SEGMENTS]
    keys, owners = [], []
    for p, (i, j) in enumerate(_PAIRS):
        (a, in_a), (b, in_b) = found[i], found[j]
        key = (np.int32(p) << 24) | (a.astype(np.int32)[:, :, None] << 12) | b.astype(np.int32)[:, None, :]
        use = in_a[:, :, None] & in_b[:, None, :]
        keys.append(key[use])
        owners.append(np.broadcast_to(fps[:, None, None], use.shape)[use])
    return np.concatenate(keys), np.concatenate(owners)


def forest(fps: np.ndarray, bits: int) -> tuple[list, list]:
    """Links that connect what is linked at all among some fingerprints: a spanning
    forest, never all pairs."""
    left, a, b = np.sort(fps), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= bits
            if near.any():
                hit = left[near]
                a += [at] * len(hit)
                b += hit.tolist()
                queue += list(hit)
                left = left[~near]
    return [int(x) for x in a], b


#: Groups up to this size are compared by shifts, all groups of a buffer at once.
_SHIFTED = 64


def group_links(keys: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside groups of equal adjacent keys."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.concatenate((first, [len(keys)])))
    group = np.repeat(np.arange(len(first)), sizes)
    small = sizes[group] <= _SHIFTED
    at, to = [], []
    for d in range(1, min(_SHIFTED, int(sizes.max(initial=1)))):
        i = np.flatnonzero(small[:-d] & (group[:-d] == group[d:]))
        if not len(i):
            break
        i = i[np.bitwise_count(fps[i] ^ fps[i + d]) <= bits]
        at.append(i)
        to.append(i + d)
    at = np.concatenate(at) if at else np.empty(0, np.int64)
    to = np.concatenate(to) if to else np.empty(0, np.int64)
    # Where links abound, a forest replaces them.
    many = (np.bincount(group[at], minlength=len(first)) > 3) | (sizes > _SHIFTED)
    a, b = [fps[at[~many[group[at]]]]], [fps[to[~many[group[at]]]]]
    for g in np.flatnonzero(many):
        x, y = forest(fps[first[g] : first[g] + sizes[g]], bits)
        a.append(np.array(x, np.uint64))
        b.append(np.array(y, np.uint64))
    a, b = np.concatenate(a), np.concatenate(b)
    pairs = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b))), axis=1)
    return pairs[0], pairs[1]


def near_links(fps: DataFrame, bits: int = BITS, block: int = BLOCK, beyond: bool = False) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column ``fp``, long) that differ in at
    most ``bits`` <= 4 bits: enough of them to connect all that are linked. More bits are
    allowed with ``beyond``: of the pairs over 4 bits apart those are found that share a key.

    A key with more than ``block`` fingerprints is dealt out as pairs of blocks, so a
    task never holds more than two blocks of a key.
    """
    if bits > 4 and not beyond:
        raise ValueError("the keys guarantee links of up to 4 bits only")

    def keyed(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(values), 4_096):
                k, owner = fuzzy_keys(values[at : at + 4_096])
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(owner.view(np.int64))], ["key", "fp"])

    keys = fps.select("fp").mapInArrow(keyed, "key int, fp long")
    heavy = stored(keys.groupBy("key").count().where(F.col("count") > block), "heavy-keys")
    if heavy.isEmpty():
        dealt = keys.select("key", F.lit(0).alias("cell"), "fp")
    else:
        blocks = F.ceil(F.col("count") / block).cast("int")
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        met = F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda j: F.least(j, F.col("own")) * F.col("blocks") + F.greatest(j, F.col("own")),
        )
        dealt = (
            join_checked(keys, heavy.select("key", blocks.alias("blocks")), ["key"], "left")
            .withColumn("own", own)
            .withColumn("cell", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(met)))
            .select("key", "cell", "fp")
        )
    dealt = dealt.repartition("key", "cell").sortWithinPartitions("key", "cell")

    def linked(batches):
        rest_k, rest_f = np.empty(0, np.int64), np.empty(0, np.uint64)

        def out(k, f):
            if len(k):
                u, v = group_links(k, f, bits)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        waiting = []
        size = 0
        for batch in batches:
            k = batch.column(0).to_numpy().astype(np.int64) << 32 | batch.column(1).to_numpy().astype(np.int64)
            waiting.append((k, batch.column(2).to_numpy().view(np.uint64)))
            size += len(k)
            if size < 65_536:
                continue
            rest_k = np.concatenate([rest_k, *[x for x, _ in waiting]])
            rest_f = np.concatenate([rest_f, *[x for _, x in waiting]])
            waiting, size = [], 0
            whole = int(np.searchsorted(rest_k, rest_k[-1]))  # the last group may go on
            yield from out(rest_k[:whole], rest_f[:whole])
            rest_k, rest_f = rest_k[whole:], rest_f[whole:]
        rest_k = np.concatenate([rest_k, *[x for x, _ in waiting]])
        rest_f = np.concatenate([rest_f, *[x for _, x in waiting]])
        yield from out(rest_k, rest_f)
        del rest_k, rest_f, waiting
        trim()

    return dealt.mapInArrow(linked, "u long, v long").distinct()


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """Add the fingerprint as a long with the same bits."""

    @F.pandas_udf("long")
    def hashed(texts):
        import pandas as pd

        return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))

    return df.withColumn(out, hashed(F.col(text)))


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """(key, mark, fp, component, component_id) of every row: ``component_id`` is the
    smallest key of those it reaches, ``component`` names the group, ``mark`` hashes the text.

    Equal fingerprints collapse to one before any comparison, so copies cost nothing
    however many there are. Texts without words have fingerprint 0 and are linked like
    any other. Null keys count only where a group has no other. Repeated rows stay rows.
    """
    rows = df.select(F.col(key).alias(key), F.xxhash64(text).alias("mark"), F.col(text).alias("__t"))
    rows = stored(with_fingerprint(rows, "__t").drop("__t"), "fps")
    nodes = rows.groupBy("fp").agg(F.min(key).alias("least"))
    links = near_links(nodes, bits)
    classes = stored(components(links), "classes")
    nodes = nodes.join(classes, nodes.fp == classes.node, "left")
    nodes = nodes.select("fp", "least", F.coalesce("component", "fp").alias("component"))
    nodes = stored(nodes, "nodes")
    named = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    nodes = nodes.join(named, "component").select("fp", "component", "component_id")
    return rows.join(nodes, "fp").select(key, "mark", "fp", "component", "component_id")


def leaders(df: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest key (nulls
    last), of several with that key the one whose text has the smallest hash."""
    return firsts(df, groups(df, key, text, bits), key, text)


def firsts(df: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """Of each component of ``found`` (key, mark, component) the row that ``leaders`` says."""
    place = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("mark").alias("mark"))
    best = found.groupBy("component").agg(F.min(place).alias("at")).select("at.key", "at.mark")
    best = best.withColumnRenamed("mark", "__best")
    marked = df.withColumn("__mark", F.xxhash64(text))
    same = marked[key].eqNullSafe(best.key) & (marked["__mark"] == best["__best"])
    # Of rows with one key and text, the one whose other columns hash least.
    kept = marked.join(best, same, "left_semi").withColumn("__row", row_mark(df))
    one = kept.groupBy(key, "__mark").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), "__row").alias("__r"))
    return one.select("__r.*")


def hexed(fp: str = "fp"):
    """Fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
