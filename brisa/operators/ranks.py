"""Exact order statistics without sorting everything in one task.

A window with an order but no partition moves all rows to one task, and an exact
percentile aggregate keeps every distinct value of a group in one map. Both are
fine for an input whose size was checked and impossible beyond it. The way for
large inputs:

1. One pass fits *splitters* per column: approximate quantiles of all rows. They
   are literals from then on. An error in them moves work between buckets, it
   never changes a result.
2. Rows are counted per (group, bucket). Running totals of these few rows give
   the exact rank every bucket starts at.
3. Only the buckets that hold a wanted rank are looked into. Their values are
   counted per (group, bucket, value) and ranked by a window partitioned by
   (group, bucket).

A bucket holds about rows/buckets rows of the whole table apart from ties, and
ties share one row after counting. So no (group, bucket) is larger than that,
however skewed the groups are. There are at most ``MAX_BUCKETS`` buckets: up to
2.6e11 rows a bucket keeps to ``ROWS_PER_BUCKET``, beyond that it grows in proportion.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa.operators.sizes import direct_limit, join_null_safe

MIN_BUCKETS, MAX_BUCKETS = 256, 65_536
ROWS_PER_BUCKET = 4_000_000
#: Rows per bucket that the splitters are fitted on.
FITTED_ROWS = 200


def fit_splitters(
    df: DataFrame, columns: list[str], rows: int, buckets: int | None = None, fitted_rows: int = FITTED_ROWS
) -> dict[str, list[float]]:
    """Bucket edges per column for a table of ``rows`` rows, in one pass.

    Approximate quantiles of a random share of the rows: edges only balance the
    buckets, so neither the share nor the approximation touches a result. A value
    that fills more than one quantile gets a bucket of its own, so that every
    other bucket stays small.
    """
    buckets = buckets or max(MIN_BUCKETS, min(MAX_BUCKETS, math.ceil(rows / ROWS_PER_BUCKET)))
    share = fitted_rows * buckets / max(rows, 1)
    fitted = df.select(*columns)
    if share < 1:
        fitted = fitted.sample(share, seed=1)
    probs = [i / buckets for i in range(1, buckets)]
    row = fitted.agg(
        *[
            F.percentile_approx(F.col(c).cast("double"), probs, 4 * buckets).alias(f"e{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    return {c: _edges(row[f"e{i}"] or []) for i, c in enumerate(columns)}


def _edges(quantiles: list[float]) -> list[float]:
    finite = [q for q in quantiles if math.isfinite(q)]
    hot = {a for a, b in zip(finite, finite[1:]) if a == b}
    return sorted({*finite, *(math.nextafter(q, math.inf) for q in hot)})


def long_values(
    df: DataFrame,
    columns: list[str],
    edges: dict[str, list[float]] | None = None,
    keep: list[str] = (),
) -> DataFrame:
    """One row per non-null value: keep..., column, bucket, value."""
    # Adding 0 makes -0.0 the 0.0 that it equals.
    numbers = {f"__v{i}": F.nanvl(F.col(c).cast("double"), F.lit(None)) + F.lit(0.0) for i, c in enumerate(columns)}
    wide = df.select(*keep, *[v.alias(n) for n, v in numbers.items()])
    if edges is None:
        bucket = [F.lit(0) for _ in columns]
    else:
        inf = float("inf")
        wide = Bucketizer(
            splitsArray=[[-inf, *(edges[c] or [0.0]), inf] for c in columns],
            inputCols=list(numbers),
            outputCols=[f"__b{i}" for i in range(len(columns))],
            handleInvalid="keep",
        ).transform(wide)
        bucket = [F.col(f"__b{i}").cast("int") for i in range(len(columns))]
    cells = [
        F.struct(F.lit(c).alias("column"), bucket[i].alias("bucket"), F.col(f"__v{i}").alias("value"))
        for i, c in enumerate(columns)
    ]
    return (
        wide.select(*keep, F.inline(F.array(*cells)))
        .filter(F.col("value").isNotNull())
    )


def bucket_starts(counted: DataFrame, by: list[str], counts: list[str]) -> DataFrame:
    """For rows counted per (by, bucket): count before the bucket, and in total.

    Adds ``<c>_before`` and ``<c>_total``. The window sees at most one row per
    bucket and group.
    """
    group = Window.partitionBy(*by)
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {}
    for c in counts:
        added[f"{c}_before"] = F.sum(c).over(upto) - F.col(c)
        added[f"{c}_total"] = F.sum(c).over(group)
    return counted.withColumns(added)


def exact_quantiles(
    df: DataFrame, columns: list[str] | tuple[str, ...], probs: list[float], by: list[str] = ()
) -> DataFrame:
    """Interpolated exact quantiles: by..., column, q (array in order of probs).

    Nulls and NaN are left out; a group without values has no row.
    """
    columns, by = list(columns), list(by)
    group = [*by, "column"]
    rows = df.count()
    if rows <= direct_limit(df):
        return (
            long_values(df, columns, keep=by)
            .groupBy(*group)
            .agg(F.percentile("value", F.array(*[F.lit(p) for p in probs])).alias("q"))
        )
    values = long_values(df, columns, fit_splitters(df, columns, rows), keep=by)
    counted = values.groupBy(*group, "bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = bucket_starts(counted, group, ["n"])
    wanted = F.lit(False)
    for p in probs:
        for rank in _ranks(p):
            wanted = wanted | _holds(rank, F.col("n_before"), F.col("n"))
    needed = starts.filter(wanted).select(
        *group, "bucket", F.col("n_before").alias("before"), "n_total"
    )
    keys = [*group, "bucket"]
    if by:
        inside = join_null_safe(values, needed, keys)
    else:  # at most two buckets per column and probability
        inside = values.join(F.broadcast(needed), keys)
    counted_values = inside.groupBy(*keys, "before", "n_total", "value").agg(
        F.count(F.lit(1)).alias("m")
    )
    upto = (
        Window.partitionBy(*keys)
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = counted_values.withColumn(
        "first", F.col("before") + F.sum("m").over(upto) - F.col("m")
    )
    picks = []
    for i, p in enumerate(probs):
        for side, rank in zip(("lo", "hi"), _ranks(p)):
            hit = _holds(rank, F.col("first"), F.col("m"))
            picks.append(F.max(F.when(hit, F.col("value"))).alias(f"{side}{i}"))
    found = placed.groupBy(*group).agg(F.max("n_total").alias("n_total"), *picks)
    parts = []
    for i, p in enumerate(probs):
        low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
        at = F.lit(p) * (F.col("n_total") - 1)
        # As the built-in aggregate does it: equal ends, infinite ones too, are the result.
        mean = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
        parts.append(F.when(low == high, low).otherwise(mean))
    return found.select(*group, F.array(*parts).alias("q"))


def _ranks(p: float) -> tuple[Column, Column]:
    """The two 0-based ranks a quantile of ``n_total`` values lies between."""
    at = F.lit(p) * (F.col("n_total") - 1)
    return F.floor(at), F.ceil(at)


def _holds(rank: Column, first: Column, count: Column) -> Column:
    return (rank >= first) & (rank < first + count)


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows in the order of columns without nulls.

    ``order`` must identify a row: a cut inside rows that tie on all of it is an
    error. The cut is found by rank and applied as a literal filter, so the rows
    themselves are neither sorted nor moved.
    """
    return df.filter(rows_before_cut(df, n, order))


def rows_before_cut(
    df: DataFrame, n: int, order: list[str], total: int | None = None
) -> Column:
    """Predicate true for exactly the first ``n`` rows."""
    total = df.count() if total is None else total
    if n <= 0:
        return F.lit(False)
    if n >= total:
        return F.lit(True)
    scope, rows, rank = df, total, n - 1
    before, tied = F.lit(False), F.lit(True)
    for c in order:
        for position, compared, literal in _positions(scope, c):
            value, below, ties = _value_at(scope.select(position.alias("value")), rows, rank)
            before = before | (tied & (compared < literal(value)))
            tied = tied & (compared == literal(value))
            rank, rows = rank - below, ties
            if rank == ties - 1:  # the cut falls behind the last of the tied rows
                return before | tied
            scope = scope.filter(compared == literal(value))
    raise ValueError(f"{order} does not identify rows: {rows} rows tie at the cut")


#: Bytes of a text that one number holds exactly.
_TEXT_STEP = 6


def _positions(scope: DataFrame, c: str):
    """Numbers that order a column: (number, what is compared, literal of a number).

    Time columns are compared as they are, so that the cut reaches the scan. Whole
    numbers are exact up to 2**53. A text is ranked by its UTF-8 bytes, a few at a
    time; the later ones matter only among rows that tie on the earlier.
    """
    kind = dict(scope.dtypes)[c]
    if kind == "string":
        data = F.col(c).cast("binary")
        longest = scope.agg(F.max(F.octet_length(c)).alias("n")).first()["n"] or 0
        for at in range(1, longest + 1, _TEXT_STEP):
            digits = F.rpad(F.hex(F.substring(data, at, _TEXT_STEP)), 2 * _TEXT_STEP, "0")
            number = F.conv(digits, 16, 10).cast("double")
            yield number, number, lambda x: F.lit(float(x))
    elif kind == "timestamp_ntz":  # without a detour over the session's time zone
        yield _micros(F.col(c)), F.col(c), _moment
    elif kind == "timestamp":
        number = F.unix_micros(F.col(c)).cast("double")
        yield number, F.col(c), lambda x: F.timestamp_micros(F.lit(int(x)))
    else:
        number = F.col(c).cast("double")
        yield number, number, lambda x: F.lit(float(x))


def _micros(t: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone."""
    seconds = F.unix_date(t.cast("date")).cast("bigint") * 86_400 + F.hour(t) * 3_600 + F.minute(t) * 60
    second = F.extract(F.lit("SECOND"), t) * 1_000_000
    return (seconds * 1_000_000 + second.cast("bigint")).cast("double")


def _moment(micros: float) -> Column:
    moment = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(micros))
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def _value_at(values: DataFrame, rows: int, rank: int) -> tuple[float, int, int]:
    """Value at a 0-based rank, the rows below it, and the rows equal to it.

    Every round narrows the range by a literal filter and returns at most a few
    hundred rows to the driver, until few enough values are left to rank at once.
    """
    below, limit = 0, direct_limit(values)
    while rows > limit:
        edges = fit_splitters(values, ["value"], rows, buckets=MIN_BUCKETS)
        counted = (
            long_values(values, ["value"], edges)
            .groupBy("bucket")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.min("value").alias("low"),
                F.max("value").alias("high"),
            )
            .orderBy("bucket")
            .collect()
        )
        for b in counted:
            if rank < below + b["n"]:
                break
            below += b["n"]
        if b["low"] == b["high"]:
            return b["low"], below, b["n"]
        if b["n"] == rows:
            break  # a handful of values that no splitter parts
        rows = b["n"]
        values = values.filter(F.col("value").between(b["low"], b["high"]))
    upto = Window.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = (
        values.groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(upto))
        .filter(F.col("upto") > rank - below)
        .orderBy("value")
        .first()
    )
    return hit["value"], below + hit["upto"] - hit["n"], hit["n"]
