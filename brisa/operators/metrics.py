"""Error of predictions: global, by entity, by subgroup, for any number of models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brisa import spec as S
from brisa.functions import errors as E
from brisa.functions.calendar import hour_band

PREDICTION = "prediction"


class NotBetter(ValueError):
    """A candidate does not beat the baseline."""


def global_metrics(
    df: DataFrame, by: list[str] = (), target: str = S.TARGET, prediction: str = PREDICTION
) -> DataFrame:
    """n, mae, rmse and r2, in one aggregate."""
    y, p = F.col(target), F.col(prediction)
    return df.groupBy(*by).agg(
        F.count(y).alias("n"),
        E.mae(y, p).alias("mae"),
        E.rmse(y, p).alias("rmse"),
        E.r2(y, p).alias("r2"),
    )


def entity_metrics(
    df: DataFrame, spec: S.ReadingSpec = S.READINGS, by: list[str] = (), prediction: str = PREDICTION
) -> DataFrame:
    """MAE and rows per entity."""
    y, p = F.col(spec.target), F.col(prediction)
    return df.groupBy(*by, spec.entity).agg(E.mae(y, p).alias("mae"), F.count(y).alias("n"))


def worst_entity(per_entity: DataFrame, spec: S.ReadingSpec = S.READINGS, by: list[str] = ()) -> DataFrame:
    """Entity with the largest MAE (the first by name on a tie)."""
    order = F.struct(-F.col("mae"), F.col(spec.entity))
    return per_entity.groupBy(*by).agg(
        F.min_by(spec.entity, order).alias(spec.entity), F.max("mae").alias("mae")
    )


#: Most entries of one map: a map is a single value that one task builds.
MAX_MAP = 100_000


def as_maps(long: DataFrame, key: str, value: str, by: list[str] = ()) -> DataFrame:
    """One key-to-value map per group, in key order: by..., values.

    Meant for entities of a known number; a group with more than ``MAX_MAP`` keys is
    an error (keep such rows long).
    """
    entries = F.array_sort(F.collect_list(F.struct(F.col(key), F.col(value))))
    large = F.raise_error(F.lit(f"more than {MAX_MAP} keys in a map"))
    checked = long.groupBy(*by).agg(entries.alias("e"))
    kind = dict(checked.dtypes)["e"]
    sound = F.when(F.size("e") <= MAX_MAP, F.col("e")).otherwise(large.cast(kind))
    return checked.select(*by, F.map_from_entries(sound).alias("values"))


def subgroup_metrics(
    df: DataFrame,
    by: list[str] = (),
    target: str = S.TARGET,
    prediction: str = PREDICTION,
    min_rows: int = S.MIN_GROUP_ROWS,
) -> DataFrame:
    """MAE and rows by season and by hour band: (axis, grp, mae, n).

    Errors are summed per (season, band) first, so only those few rows feed both
    axes. Groups below ``min_rows`` are left out.
    """
    error = E.absolute_error(F.col(target), F.col(prediction))
    cells = df.groupBy(*by, F.col(S.SEASON).alias("s"), hour_band(F.col(S.HOUR)).alias("b")).agg(
        F.sum(error).alias("e"), F.count(error).alias("c")
    )
    axes = F.inline(
        F.array(
            F.struct(F.lit("temporada").alias("axis"), F.col("s").alias("grp")),
            F.struct(F.lit("hora").alias("axis"), F.col("b").alias("grp")),
        )
    )
    return (
        cells.select(*by, "e", "c", axes)
        .groupBy(*by, "axis", "grp")
        .agg((F.sum("e") / F.sum("c")).alias("mae"), F.sum("c").alias("n"))
        .filter(F.col("n") >= min_rows)
    )


def stack_models(df: DataFrame, predictions: dict[str, str], name: str = "model") -> DataFrame:
    """One row per reading and model from prediction columns ``{model: column}``."""
    cells = [F.struct(F.lit(m).alias(name), F.col(c).alias(PREDICTION)) for m, c in predictions.items()]
    rest = [c for c in df.columns if c not in predictions.values()]
    return df.select(*rest, F.inline(F.array(*cells)))


def error_cells(
    df: DataFrame, keys: list, target: str = S.TARGET, prediction: str = PREDICTION
) -> DataFrame:
    """Error sums and target moments per group: all metrics follow from these rows."""
    y, e = F.col(target).cast("double"), F.col(target) - F.col(prediction)
    return df.groupBy(*keys).agg(
        F.count(e).alias("c"),
        F.sum(F.abs(e)).alias("abs"),
        F.sum(e * e).alias("sq"),
        F.avg(y).alias("m"),
        F.var_pop(y).alias("v"),
        F.min(y).alias("lo"),
        F.max(y).alias("hi"),
    )


def combine_cells(cells: DataFrame, group: list[str]) -> DataFrame:
    """n, mae, rmse and r2 of cells that carry the mean of their group in ``mean``.

    Squared deviations are combined around that mean, which large targets need.
    """
    gap = F.col("m") - F.col("mean")
    sst = F.sum(F.col("c") * (F.col("v") + gap * gap))
    constant = F.when(F.sum("sq") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return cells.groupBy(*group).agg(
        F.sum("c").alias("n"),
        (F.sum("abs") / F.sum("c")).alias("mae"),
        F.sqrt(F.sum("sq") / F.sum("c")).alias("rmse"),
        F.when(F.min("lo") == F.max("hi"), constant)
        .otherwise(1 - F.try_divide(F.sum("sq"), sst))
        .alias("r2"),
    )


def measure(
    df: DataFrame,
    by: list[str] = (),
    target: str = S.TARGET,
    prediction: str = PREDICTION,
    min_rows: int = S.MIN_GROUP_ROWS,
) -> DataFrame:
    """Global and subgroup metrics together: by..., axis, grp, n, mae, rmse, r2.

    One pass over the predictions; both axes and the total share its (season, band)
    cells. Subgroups below ``min_rows`` are left out, the row (global, all) never.
    """
    keys = [*by, F.col(S.SEASON).alias("s"), hour_band(F.col(S.HOUR)).alias("b")]
    axes = F.inline(
        F.array(
            F.struct(F.lit("global").alias("axis"), F.lit("all").alias("grp")),
            F.struct(F.lit("temporada").alias("axis"), F.col("s").alias("grp")),
            F.struct(F.lit("hora").alias("axis"), F.col("b").alias("grp")),
        )
    )
    group = [*by, "axis", "grp"]
    whole = Window.partitionBy(*group)  # at most one row per season and band
    cells = error_cells(df, keys, target, prediction).select("*", axes)
    mean = F.sum(F.col("c") * F.col("m")).over(whole) / F.sum("c").over(whole)
    return combine_cells(cells.withColumn("mean", mean), group).filter(
        (F.col("n") >= min_rows) | (F.col("axis") == "global")
    )


def measure_entities(
    df: DataFrame, split: str, spec: S.ReadingSpec = S.READINGS, prediction: str = PREDICTION
) -> tuple[DataFrame, DataFrame]:
    """Metrics per split with the worst entity's MAE, and MAE per split and entity.

    One pass over the predictions. Its per-entity rows are kept, not the
    predictions; the few splits are the small side of the join.
    """
    cells = error_cells(df, [split, spec.entity], spec.target, prediction).persist()
    means = cells.groupBy(split).agg(
        (F.sum(F.col("c") * F.col("m")) / F.sum("c")).alias("mean"),
        F.max(F.col("abs") / F.col("c")).alias("worst_entity_mae"),
    )
    total = combine_cells(cells.join(F.broadcast(means), split), [split, "worst_entity_mae"])
    per_entity = cells.select(
        split, spec.entity, (F.col("abs") / F.col("c")).alias("mae"), F.col("c").alias("n")
    )
    return total, per_entity


def split_measures(measured: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Global rows and subgroup rows of ``measure``."""
    total = measured.filter(F.col("axis") == "global").drop("axis", "grp")
    groups = measured.filter(F.col("axis") != "global").drop("rmse", "r2")
    return total, groups


def evaluate(df: DataFrame, spec: S.ReadingSpec = S.READINGS, by: list[str] = ()) -> DataFrame:
    """Global and subgroup metrics in long rows: by..., axis, grp, metric, value."""
    measured = measure(df, by, spec.target)
    whole = F.col("axis") == "global"
    cells = [
        F.struct(F.lit(m).alias("metric"), F.when(shown, F.col(m).cast("double")).alias("value"))
        for m, shown in (("mae", F.lit(True)), ("rmse", whole), ("r2", whole), ("n", ~whole))
    ]
    long = measured.select(*by, "axis", "grp", F.inline(F.array(*cells)))
    return long.filter(F.col("value").isNotNull())


def _metric_cells(names: list[str]):
    return F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names]
    )


def metrics_long(metrics: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Wide metrics as (keys..., metric, value)."""
    return metrics.select(*keys, F.inline(_metric_cells(names)))


def gain_over_baseline(
    metrics: DataFrame, baseline: str, candidate: str, metric: str = "mae", name: str = "model"
) -> DataFrame:
    """One row: both errors, whether the candidate beats the baseline, its gain."""

    def of(model: str):
        return F.max(F.when(F.col(name) == model, F.col(metric)))

    return metrics.agg(of(baseline).alias("baseline"), of(candidate).alias("candidate")).select(
        "baseline",
        "candidate",
        (F.col("candidate") < F.col("baseline")).alias("beats"),
        F.try_divide(F.col("baseline") - F.col("candidate"), F.col("baseline")).alias("gain"),
    )


def require_gain(metrics: DataFrame, baseline: str, candidate: str, metric: str = "mae") -> float:
    """Relative gain of the candidate, or an error when it has none."""
    row = gain_over_baseline(metrics, baseline, candidate, metric).first()
    if row["baseline"] is None or row["candidate"] is None:
        raise KeyError(f"metric {metric!r} of {baseline!r} or {candidate!r} is missing")
    if not row["beats"]:
        raise NotBetter(
            f"{candidate} ({metric}={row['candidate']:.3f}) does not beat "
            f"{baseline} ({metric}={row['baseline']:.3f})"
        )
    return row["gain"]
