"""Mergeable sketches stored beside data, so that spans are answered without a scan.

Distinct entities by month are HLL sketches: any span of months is a union of a few
small rows. Values of scored batches are KLL sketches: the drift between any two batches
is told from two rows a column, with a bound on the error.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa import spec as S
from brisa.functions.values import to_number

#: Registers of a distinct sketch: 2 ** LG_K.
LG_K = 14
#: Size of a quantile sketch, and its rank error at 99 percent by the sketch's published fit.
KLL_K = 2_048
KLL_RANK_ERROR = 2.446 / KLL_K**0.9433
#: Cut points at which two batches' ranks are compared.
POINTS = 512


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct estimate."""
    return 1.04 / math.sqrt(2**lg_k)


def month_sketches(df: DataFrame, entity: str = S.ENTITY, time: str = S.TIME, lg_k: int = LG_K) -> DataFrame:
    """(month, n_rows, entities): rows and an HLL sketch of the entities of each month.
    One aggregate; a task hands on one sketch a month."""
    return df.groupBy(F.date_format(time, "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(F.col(entity).cast("string"), F.lit(lg_k)).alias("entities")
    )


def write_month_sketches(df: DataFrame, path: str, entity: str = S.ENTITY, time: str = S.TIME) -> DataFrame:
    month_sketches(df, entity, time).coalesce(1).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def distinct_entities(sketches: DataFrame, first: str, last: str) -> DataFrame:
    """One row for the months from ``first`` to ``last`` ("yyyy-MM", both included): n_rows
    (exact), n_entities (estimate), error (three relative standard errors)."""
    span = sketches.where(F.col("month").between(first, last))
    return span.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("entities")), F.lit(0)).alias("n_entities"),
    ).withColumn("error", F.lit(3 * distinct_error()))


def batch_sketches(scored: DataFrame, batch: Column, columns: list[str], k: int = KLL_K) -> DataFrame:
    """(batch_id, column, n, low, high, sketch) of the numeric columns of scored batches;
    nulls and NaN are left out. One aggregate over all columns side by side."""
    kinds = dict(scored.dtypes)
    values = {c: to_number(F.col(c)) if kinds[c] == "string" else F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns}
    grouped = scored.select(batch.alias("batch_id"), *[v.alias(c) for c, v in values.items()]).groupBy("batch_id")
    aggregates = []
    for i, c in enumerate(columns):
        aggregates += [
            F.count(c).alias(f"n{i}"),
            F.min(c).alias(f"low{i}"),
            F.max(c).alias(f"high{i}"),
            F.kll_sketch_agg_double(c, F.lit(k)).alias(f"s{i}"),
        ]
    parts = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n{i}").alias("n"),
            F.col(f"low{i}").alias("low"),
            F.col(f"high{i}").alias("high"),
            F.col(f"s{i}").alias("sketch"),
        )
        for i, c in enumerate(columns)
    ]
    return grouped.agg(*aggregates).select("batch_id", F.inline(F.array(*parts)))


def store_batch_sketches(scored: DataFrame, batch: Column, columns: list[str], path: str) -> None:
    """Keep the sketches of scored batches; a batch stored again replaces its own."""
    rows = batch_sketches(scored, batch, columns)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def load_batch_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("string"))


_TOLD = (("statistic", "double"), ("error", "double"), ("drift", "boolean"))


def sketched_drift(sketches: DataFrame, ref: str, prod: str, min_effect: float = S.MIN_EFFECT) -> DataFrame:
    """Distance of two batches by their sketches: (column, n_ref, n_prod, statistic, error,
    drift). ``statistic`` is the largest gap of the two distribution functions over cut
    points that both sketches give; the exact statistic lies within ``error`` of it (ranks
    of either sketch, and the share between two cut points). ``drift`` is whether the
    effect is large enough; null where the error leaves it open. Reads two rows a column."""
    sides = []
    shares = F.array(*[F.lit(i / POINTS) for i in range(POINTS + 1)])
    for label, side in ((ref, "ref"), (prod, "prod")):
        own = sketches.where((F.col("batch_id") == label) & (F.col("n") > 0)).select(
            "column", F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}")
        )
        sides.append(own.withColumn(f"q_{side}", F.kll_sketch_get_quantile_double(f"s_{side}", shares)))
    both = sides[0].join(sides[1], "column")
    # Ranks are asked for at literals: 2 * (POINTS + 1) numbers a column come to the driver.
    points = {r.column: sorted({*r.q_ref, *r.q_prod}) for r in both.select("column", "q_ref", "q_prod").collect()}
    if not points:
        return both.select("column", "n_ref", "n_prod", *[F.lit(None).cast(t).alias(c) for c, t in _TOLD])
    ranks = {}
    for side in ("ref", "prod"):
        told = F
        for c, values in points.items():
            asked = F.kll_sketch_get_rank_double(f"s_{side}", F.array(*[F.lit(v) for v in values]))
            told = told.when(F.col("column") == c, asked)
        ranks[f"r_{side}"] = told
    both = both.withColumns(ranks)
    gaps = F.zip_with("r_ref", "r_prod", lambda a, b: F.abs(a - b))
    # Either sketch errs at the point and where its cut points fall; small batches are whole.
    err = sum((F.when(F.col(f"n_{s}") > KLL_K, F.lit(3 * KLL_RANK_ERROR)).otherwise(0.0) for s in ("ref", "prod")), F.lit(0.0))
    both = both.select(
        "column", "n_ref", "n_prod", F.array_max(gaps).alias("statistic"), (err + 1.0 / POINTS).alias("error")
    )
    sure = F.abs(F.col("statistic") - min_effect) > F.col("error")
    return both.withColumn("drift", F.when(sure, F.col("statistic") >= min_effect))
