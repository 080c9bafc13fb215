"""Drift between two samples: Kolmogorov-Smirnov and chi-square, all columns at once.

Both samples live in one table with two boolean columns, so one scan serves both
and a row may belong to both (comparing a partition with itself).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa import spec as S
from brisa.functions.values import known, to_number
from brisa.operators.partitions import in_range, resolve
from brisa.operators.ranks import fit_splitters, long_values
from brisa.operators.sizes import direct_limit

REF, PROD = "in_ref", "in_prod"
NO_DRIFT, DRIFT, ERROR = "NO_DRIFT", "DRIFT", "ERROR"


def two_samples(df: DataFrame, ref: Column, prod: Column) -> DataFrame:
    """Rows of either sample, marked with the samples they belong to."""
    return df.filter(ref | prod).withColumns({REF: ref, PROD: prod})


def two_partitions(
    df: DataFrame, ref: str, prod: str, spec: S.ReadingSpec = S.READINGS
) -> DataFrame:
    """The rows of two labelled partitions as two samples."""

    def covered(label: str) -> Column:
        out = F.lit(False)
        for r in resolve(label, spec.ranges):
            out = out | in_range(r, spec.time)
        return out

    return two_samples(df, covered(ref), covered(prod))


# --- Kolmogorov-Smirnov --------------------------------------------------------


def ks(
    samples: DataFrame,
    columns: list[str],
    alpha: float = S.ALPHA,
    min_effect: float = S.MIN_EFFECT,
) -> DataFrame:
    """Two-sample KS of every numeric column: column, n_ref, n_prod, statistic, p_value, drift.

    The statistic is exact. The p-value is the asymptotic Kolmogorov series with
    Stephens' correction. Fewer than two values on a side mean no drift.
    """
    columns = list(columns)
    text = {c for c, kind in samples.dtypes if kind == "string"}
    numbers = samples.select(
        REF, PROD, *[to_number(F.col(c)).alias(c) if c in text else F.col(c) for c in columns]
    )
    rows = numbers.count()
    if rows * len(columns) <= direct_limit(numbers):
        counted = long_values(numbers, columns, keep=[REF, PROD]).drop("bucket")
        found = _ks_direct(counted.groupBy("column", "value").agg(*_counts()))
    else:
        found = _ks_bucketed(numbers, columns, rows)
    listed = samples.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
    found = listed.join(found, "column", "left")
    enough = (F.coalesce("n_ref", F.lit(0)) >= 2) & (F.coalesce("n_prod", F.lit(0)) >= 2)
    return (
        found.select(
            "column",
            F.coalesce("n_ref", F.lit(0)).cast("bigint").alias("n_ref"),
            F.coalesce("n_prod", F.lit(0)).cast("bigint").alias("n_prod"),
            F.when(enough, F.col("d")).otherwise(F.lit(0.0)).alias("statistic"),
        )
        .withColumn(
            "p_value",
            F.when(enough, ks_p_value(F.col("statistic"), F.col("n_ref"), F.col("n_prod"))).otherwise(
                F.lit(1.0)
            ),
        )
        .withColumn("drift", (F.col("p_value") < alpha) & (F.col("statistic") >= min_effect))
    )


def _counts() -> list[Column]:
    return [F.count_if(REF).alias("a"), F.count_if(PROD).alias("b")]


def _gap(a: Column, b: Column) -> Column:
    """Distance of the two distribution functions at running counts a and b."""
    return F.abs(
        F.coalesce(F.try_divide(a, F.col("a_total")), F.lit(0.0))
        - F.coalesce(F.try_divide(b, F.col("b_total")), F.lit(0.0))
    )


def _ks_direct(counted: DataFrame) -> DataFrame:
    """One window per column; only for a checked number of counted values."""
    whole = Window.partitionBy("column")
    upto = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counted.select(
        "column",
        F.sum("a").over(upto).alias("a_upto"),
        F.sum("b").over(upto).alias("b_upto"),
        F.sum("a").over(whole).alias("a_total"),
        F.sum("b").over(whole).alias("b_total"),
    )
    return running.groupBy("column").agg(
        F.max("a_total").alias("n_ref"),
        F.max("b_total").alias("n_prod"),
        F.max(_gap(F.col("a_upto"), F.col("b_upto"))).alias("d"),
    )


#: Buckets of a column, rows a bucket's edges are fitted on, values that the last look at
#: open buckets may order, and scans that may narrow them before it.
KS_BUCKETS, KS_FITTED_ROWS = 2_048, 20
KS_OPEN_VALUES = 20_000_000
KS_ROUNDS = 6


@dataclass
class _Curve:
    """Both samples of one column, counted between edges: bucket i holds the values from
    edge i - 1 on, below edge i. ``apart`` counts rows that are in one sample only."""

    edges: np.ndarray
    a: np.ndarray
    b: np.ndarray
    apart: np.ndarray

    def totals(self) -> tuple[int, int]:
        return int(self.a.sum()), int(self.b.sum())

    def best_and_open(self) -> tuple[float, np.ndarray]:
        """The largest gap at an edge, and the buckets inside which a larger one can lie.

        Inside a bucket the gap cannot exceed what one function gains while the other
        stands still. There is nothing inside a bucket of one value, nor where rows are in
        both samples alike and the samples are of one size: the functions move together.
        """
        na, nb = self.totals()
        if not na or not nb:
            return 0.0, np.zeros(len(self.a), bool)
        upto_a, upto_b = np.cumsum(self.a), np.cumsum(self.b)
        a1, b1 = upto_a / na, upto_b / nb
        a0, b0 = (upto_a - self.a) / na, (upto_b - self.b) / nb
        best = float(np.abs(a1 - b1).max())
        bound = np.maximum(np.abs(a1 - b0), np.abs(a0 - b1))
        single = np.zeros(len(self.a), bool)
        single[1:-1] = np.nextafter(self.edges[:-1], np.inf) == self.edges[1:]
        together = (self.apart == 0) & (na == nb)
        return best, (bound > best) & ~single & ~together

    def split(self, edges: list[float], open_: np.ndarray) -> tuple[_Curve, np.ndarray]:
        """The curve with further edges inside its open buckets, whose parts have no counts
        yet, and which buckets those parts are."""
        new = np.setdiff1d(np.array(edges, "float64"), self.edges)
        new = new[open_[np.searchsorted(self.edges, new, side="right")]]
        joined = np.sort(np.concatenate((self.edges, new)))
        low = np.concatenate(([-np.inf], joined))  # where every bucket begins
        old = np.searchsorted(self.edges, low, side="right")
        counts = [np.where(open_[old], 0, x[old]) for x in (self.a, self.b, self.apart)]
        return _Curve(joined, *counts), open_[old]


def _ks_bucketed(numbers: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """Exact KS that orders values only where the maximum can lie.

    The first scan counts both samples between fitted edges, so tasks hand on a row for
    each bucket and no value moves. Counts at the edges bound the gap inside every bucket;
    only buckets that can hold a larger one than the edges show stay open. While those
    hold too many values they are split and counted again. The last scan orders the values
    of what is open, bucket by bucket. The driver has ``KS_BUCKETS`` rows a column and
    round, whatever the input.
    """
    spark = numbers.sparkSession
    edges = fit_splitters(numbers, columns, rows, KS_BUCKETS, KS_FITTED_ROWS)
    start = {c: np.array(edges[c] or [0.0], "float64") for c in columns}
    curves = {c: _Curve(e, *np.zeros((3, len(e) + 1), np.int64)) for c, e in start.items()}
    _count_buckets(numbers, curves, {c: np.ones(len(e) + 1, bool) for c, e in start.items()})

    def still_open() -> dict[str, np.ndarray]:
        looks = {c: x.best_and_open()[1] for c, x in curves.items()}
        return {c: o for c, o in looks.items() if o.any()}

    for _ in range(KS_ROUNDS):
        looks = still_open()
        values = sum(int((curves[c].a + curves[c].b)[o].sum()) for c, o in looks.items())
        if values <= KS_OPEN_VALUES:
            break
        within = _open_values(numbers, {c: curves[c] for c in looks}, looks)
        wide = within.select(*[F.when(F.col("column") == c, F.col("value")).alias(c) for c in looks])
        finer = fit_splitters(wide, list(looks), values, KS_BUCKETS, KS_FITTED_ROWS * len(looks))
        parts = {c: curves[c].split(finer[c], o) for c, o in looks.items()}
        if not any(len(x.edges) > len(curves[c].edges) for c, (x, _) in parts.items()):
            break  # nothing left to split at
        curves |= {c: x for c, (x, _) in parts.items()}
        _count_buckets(numbers, {c: curves[c] for c in parts}, {c: o for c, (_, o) in parts.items()})
    looks = still_open()
    inner = _ks_inside(numbers, curves, looks) if looks else {}
    found = []
    for c, x in curves.items():
        na, nb = x.totals()
        found.append((c, na, nb, max(x.best_and_open()[0], inner.get(c, 0.0))))
    return spark.createDataFrame(found, "column string, n_ref long, n_prod long, d double")


def _open_values(numbers: DataFrame, curves: dict[str, _Curve], looks: dict[str, np.ndarray]) -> DataFrame:
    """(in_ref, in_prod, column, bucket, value) of the values in the buckets to look at."""
    columns = list(curves)
    values = long_values(numbers, columns, {c: x.edges.tolist() for c, x in curves.items()}, keep=[REF, PROD])
    if all(o.all() for o in looks.values()):
        return values
    # As many rows as there are buckets: some thousand a column.
    wanted = [(c, int(i)) for c, o in looks.items() for i in np.flatnonzero(o)]
    wanted = numbers.sparkSession.createDataFrame(wanted, "column string, bucket int")
    return values.join(F.broadcast(wanted), ["column", "bucket"])


def _count_buckets(numbers: DataFrame, curves: dict[str, _Curve], looks: dict[str, np.ndarray]) -> None:
    """Count both samples in the buckets to look at, into the curves. One scan; what a task
    hands on is a row for each column and bucket."""
    values = _open_values(numbers, curves, looks)
    apart = F.count_if(F.col(REF) != F.col(PROD)).alias("apart")
    for r in values.groupBy("column", "bucket").agg(*_counts(), apart).collect():
        x = curves[r.column]
        x.a[r.bucket], x.b[r.bucket], x.apart[r.bucket] = r.a, r.b, r.apart


def _ks_inside(numbers: DataFrame, curves: dict[str, _Curve], looks: dict[str, np.ndarray]) -> dict[str, float]:
    """The largest gap inside the open buckets of every column."""
    starts = []
    for c, o in looks.items():
        x = curves[c]
        na, nb = x.totals()
        a0, b0 = np.cumsum(x.a) - x.a, np.cumsum(x.b) - x.b
        starts += [(c, int(i), int(a0[i]), int(b0[i]), na, nb) for i in np.flatnonzero(o)]
    schema = "column string, bucket int, a_before long, b_before long, a_total long, b_total long"
    starts = numbers.sparkSession.createDataFrame(starts, schema)
    values = _open_values(numbers, {c: curves[c] for c in looks}, looks)
    counted = values.groupBy("column", "bucket", "value").agg(*_counts())
    upto = Window.partitionBy("column", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    running = counted.join(F.broadcast(starts), ["column", "bucket"]).withColumns(
        {"a_upto": F.col("a_before") + F.sum("a").over(upto), "b_upto": F.col("b_before") + F.sum("b").over(upto)}
    )
    gaps = running.groupBy("column").agg(F.max(_gap(F.col("a_upto"), F.col("b_upto"))).alias("d"))
    return {r.column: r.d for r in gaps.collect()}


def ks_p_value(d: Column, n1: Column, n2: Column) -> Column:
    """Kolmogorov's series at Stephens' corrected distance."""
    root = F.sqrt(F.try_divide(n1.cast("double") * n2, n1 + n2))
    lam = (root + 0.12 + F.try_divide(F.lit(0.11), root)) * d

    def term(acc: Column, k: Column) -> Column:
        sign = F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        return acc + 2 * sign * F.exp(-2.0 * k * k * lam * lam)

    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), term)
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), series))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(bounded)  # 1 to 12 digits below 0.2


# --- chi-square ----------------------------------------------------------------


def chi2(
    samples: DataFrame,
    columns: list[str],
    alpha: float = S.ALPHA,
    min_effect: float = S.MIN_EFFECT,
) -> DataFrame:
    """Chi-square of the 2 x k level table of every column, with Cramer's V.

    Levels of one sample only count as 0 in the other. Two levels get Yates'
    correction; fewer mean no drift.
    """
    columns = list(columns)
    cells = [
        F.struct(F.lit(c).alias("column"), known(F.col(c).cast("string")).alias("level")) for c in columns
    ]
    levels = (
        samples.select(REF, PROD, F.inline(F.array(*cells)))
        .groupBy("column", "level")
        .agg(*_counts())
    )
    totals = levels.groupBy("column").agg(
        F.sum("a").alias("n_ref"), F.sum("b").alias("n_prod"), F.count(F.lit(1)).alias("k")
    )
    size = F.col("n_ref") + F.col("n_prod")

    def part(observed: str, total: str) -> Column:
        expected = (F.col("a") + F.col("b")) * F.col(total) / size
        gap = F.abs(F.col(observed) - expected)
        yates = F.when(F.col("k") == 2, F.least(F.lit(0.5), gap)).otherwise(F.lit(0.0))
        return F.try_divide((gap - yates) * (gap - yates), expected)

    # One row per tested column, so the totals are a handful of rows.
    scored = (
        levels.join(F.broadcast(totals), "column")
        .groupBy("column", "n_ref", "n_prod", "k")
        .agg(F.sum(part("a", "n_ref") + part("b", "n_prod")).alias("x"))
    )
    tested = F.col("k") >= 2
    return (
        scored.select(
            "column",
            "n_ref",
            "n_prod",
            (F.col("k") - 1).alias("dof"),
            F.when(tested, F.col("x")).otherwise(F.lit(0.0)).alias("statistic"),
            F.when(tested, F.sqrt(F.col("x") / size)).otherwise(F.lit(0.0)).alias("effect"),
        )
        .withColumn(
            "p_value",
            F.when(F.col("dof") >= 1, _chi2_tail(F.col("statistic"), F.col("dof"))).otherwise(
                F.lit(1.0)
            ),
        )
        .withColumn("drift", (F.col("p_value") < alpha) & (F.col("effect") >= min_effect))
    )


#: Degrees of freedom up to which the tail is summed.
MAX_TERMS = 10_000


def chi2_tail(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution for whole degrees of freedom.

    A finite sum, taken in logarithms: for even dof the Poisson sum below dof/2,
    for odd dof the complementary error function plus half-integer terms. Beyond
    ``MAX_TERMS`` degrees of freedom it is Wilson and Hilferty's normal form, which
    differs by less than 1e-6 there.
    """
    if not x > 0 or dof < 1:
        return 1.0
    if dof > MAX_TERMS:
        cube, spread = (x / dof) ** (1 / 3), 2 / (9 * dof)
        return 0.5 * math.erfc((cube - 1 + spread) / math.sqrt(2 * spread))
    h = x / 2.0
    odd = dof % 2 == 1
    orders = np.arange(0.5 if odd else 0.0, dof / 2.0)
    logs = [s * math.log(h) - h - math.lgamma(s + 1.0) for s in orders]
    tail = float(np.exp(logs).sum()) if logs else 0.0
    if odd:
        tail += math.erfc(math.sqrt(h))
    return min(1.0, tail)


@F.pandas_udf(T.DoubleType())
def _chi2_tail(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_tail(a, int(k)) for a, k in zip(x, dof)], dtype="float64")


# --- verdict -------------------------------------------------------------------


def compare(
    samples: DataFrame,
    numerics: list[str],
    categoricals: list[str],
    alpha: float = S.ALPHA,
    exclude: tuple[str, ...] = (),
) -> DataFrame:
    """One row per column: test, p_value, effect, drift. Absent columns are skipped."""
    numerics = [c for c in numerics if c in samples.columns and c not in exclude]
    categoricals = [c for c in categoricals if c in samples.columns and c not in exclude]
    parts = []
    if numerics:
        parts.append(
            ks(samples, numerics, alpha).select(
                "column",
                F.lit("ks").alias("test"),
                "n_ref",
                "n_prod",
                "p_value",
                F.col("statistic").alias("effect"),
                "drift",
            )
        )
    if categoricals:
        parts.append(
            chi2(samples, categoricals, alpha).select(
                "column", F.lit("chi2").alias("test"), "n_ref", "n_prod", "p_value", "effect", "drift"
            )
        )
    if not parts:
        raise S.MissingColumns("none of the columns to compare is present")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def report(compared: DataFrame) -> DataFrame:
    """Columns by effect, largest first."""
    return compared.orderBy(F.desc("effect"), "column")


def verdict(compared: DataFrame, threshold: float = S.MAX_DRIFT_SHARE) -> DataFrame:
    """One row: columns, drifting columns, their share and names, and the status.

    The share must exceed the threshold; no columns at all count as share 0.
    """
    share = F.coalesce(F.avg(F.col("drift").cast("double")), F.lit(0.0))
    names = F.array_sort(F.collect_list(F.when(F.col("drift"), F.col("column"))))
    return compared.agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.count_if("drift").alias("n_drifting"),
        share.alias("share"),
        F.array_join(names, ",").alias("drifting"),
    ).withColumn(
        "status", F.when(F.col("share") > threshold, F.lit(DRIFT)).otherwise(F.lit(NO_DRIFT))
    )


def sample_sizes(samples: DataFrame) -> tuple[int, int]:
    row = samples.agg(F.count_if(REF).alias("a"), F.count_if(PROD).alias("b")).first()
    return row["a"], row["b"]
