"""Removal of long repeated byte strings with a sparse, range-partitioned suffix array.

Every string of WINDOW bytes names one suffix inside it: the one whose leading GRAM
bytes have the least hash of all in the string, the rightmost of equal ones. Equal
strings name suffixes at equal places, so only named suffixes (about one in 77 bytes)
have to be ordered, and each stands for a run of strings around it, its context.

1. A suffix is a row of tokens: the hash of its leading bytes, then the hash of its
   context. Sampled splitters over the tokens, with the suffix's place as the last
   one, range-partition the rows, so that no token, however frequent, is one bucket.
   A bucket is sorted by multikey quicksort and neighbours are compared, also the last
   of a bucket with the first of the next. Equal contexts: all strings of the run occur
   again. Equal leading tokens only: some may.
2. The latter, at the ends of repeated passages, meet by leading token together with
   one representative of each repeated context, and their strings are compared one
   offset at a time. Leading tokens of very many suffixes are compared string by string
   in a shuffle instead.
3. What is covered goes back to the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.text import stored, trim
from brisa.operators.sizes import join_checked

WINDOW = 200
GRAM = 48
_GRAMS = WINDOW - GRAM + 1
#: Suffixes of a bucket, the most buckets, and the sampled suffixes for each.
BUCKET = 250_000
MAX_BUCKETS = 100_000
_SAMPLED = 40
#: Fewest documents (expected number) that splitters are sampled from, if there are so many.
_SAMPLED_DOCS = 400
#: Suffixes of one leading token that one task compares.
CLASS = 16_384
_BLOCK = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15
_ROW = np.dtype(
    [("kh", "<u8"), ("ch", "<u8"), ("k1", "<i8"), ("k2", "<i4"), ("x", "<u4"), ("alo", "u1"), ("ahi", "u1")]
)

_powers: list[np.ndarray] = []


def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    if not _powers:
        n = _BLOCK + 2 * WINDOW
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            step = np.full(n, base, np.uint64)
            step[0] = 1
            _powers.append(np.cumprod(step, dtype=np.uint64))
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def _least(keys: np.ndarray, window: int) -> np.ndarray:
    size = 1
    while size * 2 <= window:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    rest = window - size
    return np.minimum(keys[:-rest], keys[rest:]) if rest else keys


def named_suffixes(data: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """(leading hash, context hash, place, first, last start of the run) in blocks."""
    power, inverse = powers()
    total = len(data) - WINDOW + 1
    raw = np.frombuffer(data, np.uint8)
    at = 0
    while at < total:
        n = min(_BLOCK, total - at)
        part = raw[at : at + n + WINDOW - 1].astype(np.uint64)
        part += np.uint64(1)
        part *= power[: len(part)]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part, out=sums[1:])
        grams = len(part) - GRAM + 1
        h = mixed((sums[GRAM:] - sums[:grams]) * inverse[:grams])
        least = _least((h & ~_PLACE) | (_PLACE - np.arange(grams, dtype=np.uint64)), _GRAMS)
        change = np.flatnonzero(least[1:] != least[:-1]) + 1
        first = np.concatenate(([0], change))
        last = np.concatenate((change, [n])) - 1
        more = at + n < total
        if more:  # the last run may go on: the next block begins with it
            first, last, cut = first[:-1], last[:-1], int(first[-1])
        x = (_PLACE - (least[first] & _PLACE)).astype(np.int64)
        span = (sums[last + WINDOW] - sums[first]) * inverse[first]
        shape = (x - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)
        yield h[x], mixed(span ^ mixed(shape + np.uint64(1))), x + at, first + at, last + at
        if not more:
            return
        at += cut


def suffix_rows(k1: int, k2: int, data: bytes) -> list[np.ndarray]:
    out = []
    if len(data) < WINDOW:
        return out
    for kh, ch, x, first, last in named_suffixes(data):
        rows = np.empty(len(x), _ROW)
        rows["kh"], rows["ch"], rows["k1"], rows["k2"], rows["x"] = kh, ch, k1, k2, x
        rows["alo"], rows["ahi"] = x - last, x - first
        out.append(rows)
    return out


def _tie(rows: np.ndarray) -> np.ndarray:
    return mixed(rows["k1"].view(np.uint64) ^ rows["x"].astype(np.uint64) * np.uint64(_BASE))


def _order_key(kh: np.ndarray, ch: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """The tokens as one fixed-length string that compares alike."""
    return np.stack((kh, ch, tie), axis=1).astype(">u8").view("S24").ravel()


def bucket_of(rows: np.ndarray, heads: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bucket of each row. ``starts`` are splitters, ``heads`` their leading tokens; the
    later tokens are only looked at where a splitter has the row's leading token."""
    low = np.searchsorted(heads, rows["kh"], side="left")
    high = np.searchsorted(heads, rows["kh"], side="right")
    part = low.copy()
    tied = np.flatnonzero(low != high)
    if len(tied):
        some = rows[tied]
        part[tied] = np.searchsorted(starts, _order_key(some["kh"], some["ch"], _tie(some)), side="right")
    return part


def multikey_quicksort(tokens: list[np.ndarray], small: int = 4_096) -> np.ndarray:
    """Order of rows by their tokens: three-way partition by one token at a time, and
    the next token only among equals; small ranges are sorted directly."""
    order = np.arange(len(tokens[0]))
    todo = [(0, len(order), 0)]
    while todo:
        low, high, depth = todo.pop()
        if high - low < 2 or depth == len(tokens):
            continue
        rows = order[low:high]
        if high - low <= small:
            order[low:high] = rows[np.lexsort([t[rows] for t in reversed(tokens[depth:])])]
            continue
        values = tokens[depth][rows]
        pivot = np.sort(values[[0, len(values) // 2, -1]])[1]
        less, equal = values < pivot, values == pivot
        order[low:high] = np.concatenate((rows[less], rows[equal], rows[~(less | equal)]))
        a, b = low + int(less.sum()), low + int(less.sum() + equal.sum())
        todo += [(low, a, depth), (a, b, depth + 1), (b, high, depth)]
    return order


#: What neighbours say of a suffix: nothing, some strings may occur again, all do.
NONE, SOME, ALL = 0, 1, 2


def compare_neighbours(kh: np.ndarray, ch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Status of sorted suffixes, and which represent a repeated context in a leading
    token that has other contexts (or might have, in a neighbouring bucket)."""
    n = len(kh)
    same = np.zeros(n + 1, bool)
    same[1:n] = kh[1:] == kh[:-1]
    equal = np.zeros(n + 1, bool)
    equal[1:n] = same[1:n] & (ch[1:] == ch[:-1])
    status = np.where(equal[:-1] | equal[1:], ALL, np.where(same[:-1] | same[1:], SOME, NONE))
    token = np.cumsum(~same[:n]) - 1
    contexts = np.bincount(token, weights=~equal[:n])
    open_ = (token == 0) | (token == token[-1])
    return status, (status == ALL) & ~equal[:n] & ((contexts[token] > 1) | open_)


def _keys(df: DataFrame, key: str, text: str) -> DataFrame:
    """Add the row key: 96 bits of the document's id and text."""
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    return df.withColumns({"__k1": F.xxhash64(F.col(key), F.lit(1)), "__k2": F.shiftrightunsigned(mark, 33).cast("int")})


def _shares(share: float, docs: int) -> tuple[float, float]:
    """Share of the documents, and of their suffixes, that give ``share`` of all suffixes."""
    # A few documents give too few leading tokens: take a share of documents, then of theirs.
    wide = 1.0 if share >= 0.1 else min(1.0, max(share * 8, _SAMPLED_DOCS / max(1, docs)))
    return wide, min(1.0, share / wide)


def _splitters(base: DataFrame, buckets: int, suffixes: int, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled splitters; which suffixes are sampled only matters to the balance. Where
    fewer come than buckets need, a larger share is taken, up to all suffixes."""
    share = min(1.0, _SAMPLED * buckets / max(1, suffixes))
    while True:
        found = _sampled(base, *_shares(share, n_docs))  # about _SAMPLED * buckets rows
        if len(found) >= buckets or share >= 1:
            break
        share = min(1.0, share * 8)
    if not found:
        return np.empty(0, np.uint64), np.empty(0, "S24")
    table = np.array(found, np.int64).view(np.uint64)
    key = np.sort(_order_key(table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()))
    starts = np.unique(key[[i * len(key) // buckets for i in range(1, buckets)]])
    wide = np.frombuffer(b"".join(s.ljust(24, b"\0") for s in starts.tolist()), ">u8").reshape(-1, 3)
    return wide[:, 0].astype(np.uint64), starts


def _sampled(base: DataFrame, wide: float, share: float) -> list:
    """Tokens of a share of the suffixes of a share of the documents."""

    def sampled(batches):
        for batch in batches:
            out = [r for b in _batch_rows(batch) for r in b]
            rows = np.concatenate(out) if out else np.empty(0, _ROW)
            tie = _tie(rows)
            chosen = tie <= np.uint64(min(2**64 - 1, int(share * 2**64)))
            columns = [rows["kh"][chosen], rows["ch"][chosen], tie[chosen]]
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], ["kh", "ch", "tie"])

    docs = base.sample(wide, seed=11) if wide < 1 else base
    return docs.mapInArrow(sampled, "kh long, ch long, tie long").collect()


def _batch_rows(batch) -> Iterator[list[np.ndarray]]:
    for k1, k2, value in zip(
        batch.column("__k1").to_pylist(), batch.column("__k2").to_pylist(), batch.column("__t"), strict=True
    ):
        yield suffix_rows(k1, k2, value.as_py() or b"")


_FOUND = "k1 long, k2 int, x long, alo int, ahi int, kh long, ch long, status int, rep boolean, bucket int, side int"


def repeated_suffixes(base: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Suffixes that have an equal leading token elsewhere, with their status."""
    spark = base.sparkSession
    total = base.agg(F.sum(F.octet_length("__t")).alias("b"), F.count("*").alias("n")).first()
    size = total.b or 0
    suffixes = 2 * size // (_GRAMS + 1)
    buckets = min(MAX_BUCKETS, 1 + suffixes // bucket)
    heads, starts = _splitters(base, buckets, suffixes, total.n) if buckets > 1 else _splitters(base.limit(0), 1, 0, 0)

    def dealt(batches):
        for batch in batches:
            out = [r for b in _batch_rows(batch) for r in b]
            if not out:
                continue
            rows = np.concatenate(out)
            part = bucket_of(rows, heads, starts)
            order = np.argsort(part, kind="stable")
            rows, part = rows[order], part[order]
            cuts = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]))
            blobs = [rows[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cuts[:-1]].astype(np.int32)), pa.array(blobs, pa.binary())], ["bucket", "rows"]
            )

    def sorted_(batches):
        blobs, own = [], 0
        for batch in batches:
            blobs += batch.column("rows").to_pylist()
            own = batch.column("bucket")[0].as_py() if len(batch) else own
        rows = np.frombuffer(b"".join(blobs), _ROW)
        del blobs
        if not len(rows):
            return
        order = multikey_quicksort([rows["kh"].copy(), rows["ch"].copy()])
        rows = rows[order]
        status, rep = compare_neighbours(rows["kh"], rows["ch"])
        side = np.zeros(len(rows), np.int32)
        side[0] |= 1
        side[-1] |= 2
        keep = np.flatnonzero((status > NONE) | (side > 0))
        for at in range(0, len(keep), 65_536):
            i = keep[at : at + 65_536]
            r = rows[i]
            columns = [
                pa.array(r["k1"].copy()),
                pa.array(r["k2"].copy()),
                pa.array(r["x"].astype(np.int64)),
                pa.array(r["alo"].astype(np.int32)),
                pa.array(r["ahi"].astype(np.int32)),
                pa.array(r["kh"].copy().view(np.int64)),
                pa.array(r["ch"].copy().view(np.int64)),
                pa.array(status[i].astype(np.int32)),
                pa.array(rep[i]),
                pa.array(np.full(len(i), own, np.int32)),
                pa.array(side[i]),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _FOUND.split(", ")])
        del rows, r, columns
        trim()

    rows = base.select("__k1", "__k2", "__t").mapInArrow(dealt, "bucket int, rows binary")
    found = rows.repartitionById(len(starts) + 1, F.col("bucket")).mapInArrow(sorted_, _FOUND)
    found = stored(found, "suffixes")
    # Compare across boundaries: two rows of every bucket.
    ends = sorted(found.where("side > 0").collect(), key=lambda r: (r.bucket, r.side))
    settled_ = []
    for i, r in enumerate(ends):
        others = [o for o in (ends[i - 1] if i and r.side & 1 else None, ends[i + 1] if i + 1 < len(ends) and r.side & 2 else None) if o]
        status = max([r.status, *[ALL if (o.kh, o.ch) == (r.kh, r.ch) else SOME for o in others if o.kh == r.kh]])
        settled_.append((*r[:7], status, status == ALL, r.bucket, 0))
    inner = found.where("side = 0")
    return inner.unionByName(spark.createDataFrame(settled_, _FOUND)) if settled_ else inner


def _window_hashes(contexts: np.ndarray) -> np.ndarray:
    """Running sums of contexts laid out by their suffix's place (column _GRAMS - 1)."""
    power, _ = powers()
    sums = np.zeros((len(contexts), contexts.shape[1] + 1), np.uint64)
    np.cumsum((contexts.astype(np.uint64) + np.uint64(1)) * power[: contexts.shape[1]], axis=1, out=sums[:, 1:])
    return sums


def _string(sums: np.ndarray, a: int) -> np.ndarray:
    """Hash of the strings that begin ``a`` bytes before the suffixes."""
    _, inverse = powers()
    begin = _GRAMS - 1 - a
    return mixed((sums[:, begin + WINDOW] - sums[:, begin]) * inverse[begin])


def _laid_out(contexts: list[bytes], ahi: np.ndarray) -> np.ndarray:
    out = np.zeros((len(contexts), _GRAMS - 1 + WINDOW), np.uint8)
    for i, c in enumerate(contexts):
        begin = _GRAMS - 1 - int(ahi[i])
        out[i, begin : begin + len(c)] = np.frombuffer(c, np.uint8)
    return out


def repeated_offsets(kh: np.ndarray, alo: np.ndarray, ahi: np.ndarray, contexts: list[bytes]):
    """Least and largest offset of each suffix whose string another suffix with its
    leading token has as well; -1 where there is none."""
    low, high = np.full(len(kh), -1), np.full(len(kh), -1)
    step = 4_096
    hashes = None
    for at in range(0, len(kh), step):  # rows by offsets, 8 bytes each
        sums = _window_hashes(_laid_out(contexts[at : at + step], ahi[at : at + step]))
        part = np.stack([_string(sums, a) for a in range(_GRAMS)])
        hashes = part if hashes is None else np.concatenate((hashes, part), axis=1)
    token = mixed(kh * np.uint64(_BASE))
    for a in range(_GRAMS):
        rows = np.flatnonzero((alo <= a) & (a <= ahi))
        if len(rows) < 2:
            continue
        key = hashes[a, rows] + token[rows]
        order = np.argsort(key, kind="stable")
        equal = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(rows), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        hit = rows[twice]
        low[hit] = np.where(low[hit] < 0, a, low[hit])
        high[hit] = a
    return low, high


_CONTEXT = "kh long, k1 long, k2 int, x long, alo int, ahi int, some boolean, context binary"
_CONTEXT_NAMES = [c.split()[0] for c in _CONTEXT.split(", ")]


def contexts_of(base: DataFrame, found: DataFrame) -> DataFrame:
    """The contexts of suffixes of which some strings may occur again, and of the
    representatives of repeated contexts."""
    wanted = found.where(f"status = {SOME} OR rep").select(
        "k1", "k2", F.struct("kh", "x", "alo", "ahi", (F.col("status") == SOME).alias("some")).alias("s")
    )
    wanted = wanted.groupBy("k1", "k2").agg(F.collect_set("s").alias("__s"))
    both = base.join(wanted, (base["__k1"] == wanted.k1) & (base["__k2"] == wanted.k2)).drop("k1", "k2")

    def cut(batches):
        for batch in batches:
            out = []
            for k1, k2, value, places in zip(
                batch.column("__k1").to_pylist(),
                batch.column("__k2").to_pylist(),
                batch.column("__t"),
                batch.column("__s").to_pylist(),
                strict=True,
            ):
                data = value.as_py()
                for p in places:
                    context = data[p["x"] - p["ahi"] : p["x"] - p["alo"] + WINDOW]
                    out.append((p["kh"], k1, k2, p["x"], p["alo"], p["ahi"], p["some"], context))
                if len(out) > 16_384:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    def _batch(rows):
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, _CONTEXT_NAMES)

    return both.mapInArrow(cut, _CONTEXT)


_SPAN = "k1 long, k2 int, lo long, hi long"


def _compared(contexts: DataFrame) -> DataFrame:
    """Covered spans of the suffixes, whole leading tokens at a time."""

    def spans(batches):
        waiting: list = []
        size = 0

        def settle(table):
            kh = table.column("kh").to_numpy().view(np.uint64)
            alo, ahi = table.column("alo").to_numpy(), table.column("ahi").to_numpy()
            low, high = repeated_offsets(kh, alo, ahi, table.column("context").to_pylist())
            hit = np.flatnonzero((low >= 0) & table.column("some").to_numpy(zero_copy_only=False))
            x = table.column("x").to_numpy()[hit]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(table.column("k1").to_numpy()[hit]),
                    pa.array(table.column("k2").to_numpy()[hit]),
                    pa.array(x - high[hit]),
                    pa.array(x - low[hit] + WINDOW),
                ],
                ["k1", "k2", "lo", "hi"],
            )

        for batch in batches:
            waiting.append(batch)
            size += len(batch)
            if size < 8_192:
                continue
            table = pa.Table.from_batches(waiting).combine_chunks()
            kh = table.column("kh").to_numpy()
            whole = int(np.flatnonzero(kh != kh[-1])[-1]) + 1 if kh[0] != kh[-1] else 0
            if whole:
                yield settle(table.slice(0, whole))
            waiting = table.slice(whole).to_batches()
            size = len(table) - whole
        if size:
            yield settle(pa.Table.from_batches(waiting))
        waiting = []
        trim()

    return contexts.repartition("kh").sortWithinPartitions("kh").mapInArrow(spans, _SPAN)


def _compared_by_string(contexts: DataFrame) -> DataFrame:
    """Covered spans where a leading token has too many suffixes for one task: every
    string is a row, counted and joined by its 128-bit hash."""

    def strings(batches):
        for batch in batches:
            for at in range(0, len(batch), 512):
                some = batch.slice(at, 512)
                alo, ahi = some.column("alo").to_numpy(), some.column("ahi").to_numpy()
                sums = _window_hashes(_laid_out(some.column("context").to_pylist(), ahi))
                for a in range(_GRAMS):
                    rows = np.flatnonzero((alo <= a) & (a <= ahi))
                    if not len(rows):
                        continue
                    begin = _GRAMS - 1 - a
                    raw = (sums[rows, begin + WINDOW] - sums[rows, begin]) * powers()[1][begin]
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [some.column(c).take(take) for c in ("kh", "k1", "k2", "x", "some")]
                        + [pa.array(np.full(len(rows), a, np.int32)), pa.array(mixed(raw).view(np.int64))],
                        ["kh", "k1", "k2", "x", "some", "a", "s"],
                    )

    rows = contexts.mapInArrow(strings, "kh long, k1 long, k2 int, x long, some boolean, a int, s long")
    rows = stored(rows, "strings")
    twice = rows.groupBy("kh", "a", "s").count().where("count > 1").drop("count")
    hit = rows.where("some").join(twice, ["kh", "a", "s"], "left_semi")
    spans = hit.groupBy("k1", "k2", "x").agg(F.min("a").alias("low"), F.max("a").alias("high"))
    return spans.select(
        "k1", "k2", (F.col("x") - F.col("high")).alias("lo"), (F.col("x") - F.col("low") + WINDOW).alias("hi")
    )


def repeated_spans(base: DataFrame, bucket: int = BUCKET, class_: int = CLASS) -> DataFrame:
    """(k1, k2, spans) of the texts that have bytes inside a string of WINDOW bytes that
    also begins elsewhere; the spans may overlap."""
    found = repeated_suffixes(base, bucket)
    contexts = contexts_of(base, found)
    large = found.where(f"status = {SOME} OR rep").groupBy("kh").count().where(F.col("count") > class_)
    large = stored(large, "large-classes")
    if large.isEmpty():
        some = _compared(contexts)
    else:
        flagged = join_checked(contexts, large.select("kh", F.lit(True).alias("large")), ["kh"], "left")
        flagged = stored(flagged, "contexts")
        some = _compared(flagged.where("large IS NULL").select(*_CONTEXT_NAMES))
        some = some.unionByName(_compared_by_string(flagged.where("large").select(*_CONTEXT_NAMES)))
    whole = found.where(f"status = {ALL}").select(
        "k1", "k2", (F.col("x") - F.col("ahi")).alias("lo"), (F.col("x") - F.col("alo") + WINDOW).alias("hi")
    )
    return whole.unionByName(some).groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("__spans"))


def merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or adjacent spans."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def without_repeats(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    bucket: int = BUCKET,
    class_: int = CLASS,
    as_text: bool = False,
) -> DataFrame:
    """Add ``kept`` (the remaining bytes), ``removed_bytes`` and ``removed_spans``. With
    ``as_text``, ``kept`` is a string, without characters that were cut in part.

    Removed is every byte that is covered by a string of WINDOW bytes which also begins
    anywhere else, in the same or another text, judged on the input; matches never
    cross texts. Null texts count as empty; texts under WINDOW bytes lose nothing.
    Rows alike in key and text count as separate texts and lose all such strings.
    Columns with the added names are replaced, all others kept.
    """
    kept = [c for c in df.columns if c not in ("kept", "removed_bytes", "removed_spans")]
    base = _keys(df.select(*kept), key, text)
    base = base.withColumn("__t", F.coalesce(F.col(text), F.lit("")).cast("binary")).drop(text)
    spans = repeated_spans(base, bucket, class_)
    both = base.join(spans, (base["__k1"] == spans.k1) & (base["__k2"] == spans.k2), "left")

    kind = "string" if as_text else "binary"

    @F.arrow_udf(f"struct<kept: {kind}, n: long, spans: long>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for value, found in zip(texts, spans.to_pylist(), strict=True):
            data, runs = value.as_py(), merged(found)
            if runs:
                ends = [0, *[hi for _, hi in runs]]
                data = b"".join(data[a:b] for a, b in zip(ends, [*[lo for lo, _ in runs], len(data)], strict=True))
            if as_text:
                data = data.decode("utf-8", "ignore")
            out.append({"kept": data, "n": sum(b - a for a, b in runs), "spans": len(runs)})
        fields = [("kept", pa.string() if as_text else pa.binary()), ("n", pa.int64()), ("spans", pa.int64())]
        return pa.array(out, pa.struct(fields))

    both = both.withColumn("__c", cut("__t", "__spans"))
    return both.select(
        *[F.col("__t").cast("string").alias(text) if c == text else F.col(c) for c in kept],
        F.col("__c.kept").alias("kept"),
        F.col("__c.n").alias("removed_bytes"),
        F.col("__c.spans").alias("removed_spans"),
    )
