"""Cleaning, imputation, sampling, splitting and the composed preparation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa import spec as S
from brisa.functions.values import known, nan_as_null, sample_hash
from brisa.operators.contract import enforce, enforce_by, processed_contract, raw_contract
from brisa.operators.features import build_features
from brisa.operators.partitions import label_rows, resolve, slice_label
from brisa.operators.ranks import exact_quantiles, first_rows, rows_before_cut
from brisa.operators.sizes import join_null_safe
from brisa.session import written


@dataclass(frozen=True)
class Fill:
    """Fitted fill values, one per column: a few literals, not a table."""

    values: dict[str, object]

    def column(self, c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(self.values.get(c)))

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.column(c) for c in self.values if c in df.columns})


def fit_medians(df: DataFrame, columns: list[str] | tuple[str, ...]) -> Fill:
    """Exact median per column, all columns in one job."""
    rows = exact_quantiles(df, columns, [0.5]).collect()
    found = {r["column"]: r["q"][0] for r in rows}
    return Fill({c: found.get(c) for c in columns})


def fit_most_frequent(df: DataFrame, columns: list[str] | tuple[str, ...]) -> Fill:
    """Most frequent value per column; the smallest one on a tie.

    Values are counted first, so no task holds more than one row per level.
    """
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    rows = (
        df.select(F.inline(F.array(*cells)))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column")
        .agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))
        .collect()
    )
    found = {r["column"]: r["value"] for r in rows}
    return Fill({c: found.get(c) for c in columns})


def clean(df: DataFrame, spec: S.ReadingSpec = S.READINGS) -> DataFrame:
    """Drop rows without target, flag and fill missing values.

    Numerics get the median of the rows kept, after ``<c>_era_nulo`` recorded
    which were missing; categoricals get a level of their own. The target is
    never filled. Columns the table lacks are skipped.
    """
    df = nan_as_null(df, (*spec.measures, spec.target))
    kept = df.filter(F.col(spec.target).isNotNull())
    numerics = [c for c in spec.measures if c in df.columns]
    categoricals = [c for c in spec.categoricals if c in df.columns]
    medians = fit_medians(kept, numerics)
    flags = {f"{c}_era_nulo": F.col(c).isNull().cast("tinyint") for c in numerics}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians.values[c])) for c in numerics}
    named = {c: known(F.col(c).cast("string")) for c in categoricals}
    return kept.withColumns(flags).withColumns({**filled, **named})


def clean_by(df: DataFrame, by: str, spec: S.ReadingSpec = S.READINGS) -> DataFrame:
    """``clean`` with medians per group: one job for all groups together."""
    df = nan_as_null(df, (*spec.measures, spec.target))
    kept = df.filter(F.col(spec.target).isNotNull())
    numerics = [c for c in spec.measures if c in df.columns]
    categoricals = [c for c in spec.categoricals if c in df.columns]
    medians = (
        exact_quantiles(kept, numerics, [0.5], [by])
        .groupBy(by)
        .agg(
            *[
                F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(f"__m_{c}")
                for c in numerics
            ]
        )
    )
    joined = join_null_safe(kept, medians, [by], "left")
    flags = {f"{c}_era_nulo": F.col(c).isNull().cast("tinyint") for c in numerics}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"__m_{c}")) for c in numerics}
    named = {c: known(F.col(c).cast("string")) for c in categoricals}
    return (
        joined.withColumns(flags)
        .withColumns({**filled, **named})
        .drop(*[f"__m_{c}" for c in numerics])
    )


def sample_rows(df: DataFrame, n: int, key: str | Sequence[str], seed: int = S.SEED) -> DataFrame:
    """Exactly ``n`` rows, always the same ones for a seed; all when there are fewer.

    These are the rows with the smallest salted hashes of the whole key. The hash
    bound is found by rank, so no task gathers ``n`` rows. A key that does not
    identify the rows at the bound is an error.
    """
    digest = sample_hash([F.col(k) for k in ([key] if isinstance(key, str) else key)], seed)
    hashed = df.withColumns(
        {
            "__h1": F.conv(F.substring(digest, 1, 12), 16, 10).cast("double"),
            "__h2": F.conv(F.substring(digest, 13, 12), 16, 10).cast("double"),
        }
    )
    return first_rows(hashed, n, ["__h1", "__h2"]).drop("__h1", "__h2")


def split_by_time(
    df: DataFrame, order: list[str], fraction: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """The first ``int(rows * fraction)`` rows in time order, and the rest."""
    total = df.count()
    early = rows_before_cut(df, int(total * fraction), order, total)
    return df.filter(early), df.filter(~early)


def prepare_partition(
    df: DataFrame,
    label: str,
    spec: S.ReadingSpec = S.READINGS,
    *,
    rows: int | None = None,
    key: str | Sequence[str] | None = None,
    validate: bool = True,
    as_of: str | None = None,
    once: bool | None = None,
) -> DataFrame:
    """Slice, check raw contract, clean, optionally sample, derive, check again.

    The sample is an option and off by default: Spark needs none to fit memory. Checks and
    medians take several passes: with ``once`` (by default where checks are made) the
    slice is written to the shared folder first, and the source read a single time.
    """
    part = slice_label(df, label, spec.ranges, spec.time)
    if validate if once is None else once:
        part = written(part, "slice")
    if validate:
        enforce(part, raw_contract(spec, as_of=as_of))
    part = clean(part, spec)
    if rows is not None:
        part = sample_rows(part, rows, key or spec.key)
    part = build_features(part, spec)
    if validate:
        enforce(part, processed_contract(spec))
    return part


def prepare_labelled(
    df: DataFrame,
    labels: list[str],
    spec: S.ReadingSpec = S.READINGS,
    *,
    validate: bool = True,
    as_of: str | None = None,
    name: str = "particion",
    once: bool | None = None,
) -> DataFrame:
    """Several partitions prepared together, each row with its label.

    Both contracts, the medians and the features of all partitions take one job
    each, however many partitions there are. Every partition is held to its own
    contract and filled with its own medians. ``once`` as in ``prepare_partition``.
    """
    ranges = tuple(r for label in labels for r in resolve(label, spec.ranges))
    _require_disjoint(ranges)
    rows = label_rows(df, ranges, spec.time, name)
    if validate if once is None else once:
        rows = written(rows, "slices")
    if validate:
        enforce_by(rows, raw_contract(spec, as_of=as_of), name, labels)
    rows = build_features(clean_by(rows, name, spec), spec)
    if validate:
        enforce_by(rows, processed_contract(spec), name, labels)
    return rows


def _require_disjoint(ranges: tuple[S.TimeSpan, ...]) -> None:
    ordered = sorted(ranges, key=lambda r: r.start)
    for a, b in zip(ordered, ordered[1:]):
        if b.start < a.end:
            raise ValueError(f"partitions {a.label} and {b.label} overlap; prepare them one by one")


def prepare_partitions(
    df: DataFrame, labels: list[str], spec: S.ReadingSpec = S.READINGS, **options
) -> DataFrame:
    """Several prepared partitions in one table; order it at the sink if needed.

    A sample size per partition asks for partition-wise work.
    """
    if options.get("rows") is None:
        kept = {k: v for k, v in options.items() if k in ("validate", "as_of", "once")}
        return prepare_labelled(df, labels, spec, **kept).drop("particion")
    parts = [prepare_partition(df, label, spec, **options) for label in labels]
    return reduce(lambda a, b: a.unionByName(b), parts)
