"""Drift check of two labelled partitions, from readings to a status."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa import spec as S
from brisa.operators import drift as D
from brisa.operators.features import build_features


@dataclass(frozen=True)
class DriftCheck:
    status: str
    report: DataFrame | None
    verdict: DataFrame | None
    detail: str = ""


def drift_report(
    readings: DataFrame, ref: str, prod: str, spec: S.ReadingSpec = S.READINGS
) -> DataFrame:
    """Test of every feature that does not drift by construction."""
    samples = D.two_partitions(build_features(readings, spec), ref, prod, spec)
    return D.compare(
        samples,
        list(spec.numeric_features),
        list(spec.categorical_features),
        exclude=S.DRIFTS_BY_CONSTRUCTION,
    )


def drift_check(
    readings: DataFrame,
    ref: str = "train",
    prod: str = "produccion",
    spec: S.ReadingSpec = S.READINGS,
    threshold: float = S.MAX_DRIFT_SHARE,
) -> DriftCheck:
    """Status of the check; unreadable input or an empty side is an error, not drift.

    The tests of all columns come to the driver, a row for each column, and are kept as a
    local table: nothing is computed again for the report or the verdict.
    """
    try:
        samples = D.two_partitions(readings, ref, prod, spec)
        sizes = D.sample_sizes(samples)
    except Exception as error:
        return DriftCheck(D.ERROR, None, None, str(error))
    if 0 in sizes:
        return DriftCheck(D.ERROR, None, None, f"rows: reference {sizes[0]}, production {sizes[1]}")
    compared = drift_report(readings, ref, prod, spec)
    compared = readings.sparkSession.createDataFrame(compared.collect(), compared.schema)
    verdict = D.verdict(compared, threshold)
    return DriftCheck(verdict.first()["status"], D.report(compared), verdict)


def status_row(check: DriftCheck, spark: SparkSession) -> DataFrame:
    """A check as one row: n_columns, n_drifting, share, drifting, status, detail. An error
    has a detail and no figures."""
    detail = F.lit(check.detail or None).cast("string").alias("detail")
    if check.verdict is not None:
        return check.verdict.select("n_columns", "n_drifting", "share", "drifting", "status", detail)
    none = "CAST(NULL AS BIGINT) AS n_columns", "CAST(NULL AS BIGINT) AS n_drifting", "CAST(NULL AS DOUBLE) AS share"
    row = spark.range(1).selectExpr(*none, "CAST(NULL AS STRING) AS drifting")
    return row.select("*", F.lit(check.status).alias("status"), detail)
