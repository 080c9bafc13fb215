"""Profiling: missing values, counts, cycles, distributions, correlations."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa import spec as S
from brisa.functions import calendar as C
from brisa.functions.errors import relative_change
from brisa.functions.values import nan_as_null
from brisa.operators.partitions import MONTH_FOLDER, slice_spans
from brisa.operators.ranks import exact_quantiles
from brisa.operators.sizes import join_null_safe


def summary(df: DataFrame, spec: S.ReadingSpec = S.READINGS) -> DataFrame:
    """Rows, columns, time span and number of entities."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.min(spec.time).alias("first_time"),
        F.max(spec.time).alias("last_time"),
        F.count_distinct(F.col(spec.entity)).alias("n_entities"),
    )


def _cells(columns: list[str], **values) -> Column:
    """Array of (column, ...) structs; ``values`` map a name to a function of c."""
    return F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[f(c).alias(n) for n, f in values.items()])
            for c in columns
        ]
    )


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null (or NaN) count and percentage of the columns that have any, most first."""
    columns = columns or df.columns
    df = nan_as_null(df, columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    place = {c: f"n{i}" for i, c in enumerate(columns)}
    cells = _cells(
        columns,
        nulls=lambda c: F.col(place[c]),
        pct=lambda c: F.round(F.col(place[c]) * 100.0 / F.col("rows"), 2),
    )
    return (
        counted.select(F.inline(cells))
        .filter(F.col("nulls") > 0)
        .orderBy(F.desc("nulls"), "column")
    )


def null_share(df: DataFrame, by: Column, name: str, columns: list[str]) -> DataFrame:
    """Null (or NaN) percentage of every column per group, one row per group and column."""
    df = nan_as_null(df, columns)
    grouped = df.groupBy(by.alias(name)).agg(
        *[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(f"p{i}") for i, c in enumerate(columns)]
    )
    place = {c: f"p{i}" for i, c in enumerate(columns)}
    return grouped.select(name, F.inline(_cells(columns, null_pct=lambda c: F.col(place[c]))))


def rows_by(df: DataFrame, by: Column, name: str) -> DataFrame:
    return df.groupBy(by.alias(name)).agg(F.count(F.lit(1)).alias("n_rows"))


def mean_by(df: DataFrame, by: Column, name: str, value: str) -> DataFrame:
    """Mean of the non-null values per group."""
    kept = df.filter(F.col(value).isNotNull())
    return kept.groupBy(by.alias(name)).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def value_checks(df: DataFrame, columns: list[str], sentinel: float | None = None) -> DataFrame:
    """Values at or below zero, and values equal to a sentinel, per column."""
    aggregates = []
    for i, c in enumerate(columns):
        aggregates.append(F.count_if(F.col(c) <= 0).alias(f"z{i}"))
        aggregates.append(F.count_if(F.col(c) == F.lit(sentinel)).alias(f"s{i}"))
    place = {c: i for i, c in enumerate(columns)}
    cells = _cells(
        columns,
        n_not_positive=lambda c: F.col(f"z{place[c]}"),
        n_sentinel=lambda c: F.col(f"s{place[c]}"),
    )
    return df.agg(*aggregates).select(F.inline(cells))


def physical_check(df: DataFrame) -> DataFrame:
    """Rows with temperature and dew point, and how many break their order."""
    both = F.col("TEMP").isNotNull() & F.col("DEWP").isNotNull()
    return df.agg(
        F.count_if(both).alias("n_complete"),
        F.count_if(both & (F.col("TEMP") < F.col("DEWP"))).alias("n_broken"),
    )


# --- distributions -----------------------------------------------------------


def _bin_values(df: DataFrame, columns: list[str], log: bool) -> tuple[DataFrame, dict]:
    """Values on the binning scale and their fitted range, one pass for all."""

    def scale(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.when(v > 0, F.log10(v)) if log else v

    scaled = {c: scale(c) for c in columns}
    spans = df.agg(
        *[f(scaled[c]).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    return scaled, {c: (spans[f"lo{i}"], spans[f"hi{i}"]) for i, c in enumerate(columns)}


def _bin(value: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin number from 0; the last bin includes the maximum."""
    if low == high:
        return F.when(value.isNotNull(), F.lit(0))
    position = F.floor((value - F.lit(low)) * bins / F.lit(high - low))
    # least() skips nulls, so missing values are kept out by hand.
    return F.when(value.isNotNull(), F.least(position, F.lit(bins - 1))).cast("int")


def histogram(
    df: DataFrame,
    columns: list[str],
    bins: int,
    log: bool = False,
    by: str | None = None,
) -> DataFrame:
    """Counts per equal-width bin of every column, empty bins included.

    ``log`` bins log10 of the positive values. With ``by`` all groups share the
    bins and every group has all of them. Rows: [by,] column, bin, low, high, n;
    the edges are on the binning scale.
    """
    scaled, spans = _bin_values(df, columns, log)
    live = [c for c in columns if spans[c][0] is not None]
    if not live:
        raise ValueError(f"no values to bin in {columns}")
    keep = [by] if by else []
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(float(spans[c][0])).alias("first"),
            F.lit(float(spans[c][1])).alias("last"),
            _bin(scaled[c], *spans[c], bins).alias("bin"),
        )
        for c in live
    ]
    group = [*keep, "column", "first", "last"]
    # Rows without a value count as bin null, so their group still shows up. A
    # group's map holds at most one entry per bin.
    found = F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "n")))
    counted = (
        df.select(*keep, F.inline(F.array(*cells)))
        .groupBy(*group, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*group)
        .agg(F.map_from_entries(found).alias("found"))
    )
    listed = counted.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("last") - F.col("first")) / bins
    return listed.select(
        *keep,
        "column",
        "bin",
        (F.col("first") + F.col("bin") * width).alias("low"),
        (F.col("first") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce(F.col("found")[F.col("bin")], F.lit(0).cast("bigint")).alias("n"),
    )


def density(df: DataFrame, column: str, by: str, bins: int = 60) -> DataFrame:
    """Log-scale density per group, each group's area normalized to 1."""
    counted = histogram(df, [column], bins, log=True, by=by)
    total = F.sum("n").over(Window.partitionBy(by))
    width = F.col("high") - F.col("low")
    return counted.select(
        by, "bin", "low", "high", "n", F.try_divide(F.col("n"), total * width).alias("density")
    )


#: Width of the fine bins of a density curve, in decades.
CURVE_BIN = 1 / 256


def density_curve(df: DataFrame, column: str, by: str, points: int = 200, cut: float = 3.0) -> DataFrame:
    """Smooth density of the log10 of a column's positive values per group, on a grid.

    A Gaussian kernel of Scott's bandwidth (n**(-1/5) standard deviations of the group)
    over fine bins, each at the mean of its values; ``points`` grid points from ``cut``
    bandwidths below the group's smallest value to as many above its largest. Every
    group's area is 1. Rows: by, point, x, density. Groups of fewer than two different
    values have no curve.

    One scan that hands on a row for each group and bin; a group holds at most some
    150,000 bins, for that is all there are between the smallest and largest double.
    """
    v = F.log10(F.col(column).cast("double"))
    binned = (
        df.where((F.col(column) > 0) & (F.col(column).cast("double") < F.lit(float("inf"))))
        .select(by, v.alias("v"))
        .groupBy(by, F.floor(F.col("v") / CURVE_BIN).alias("bin"))
        .agg(
            F.count("v").alias("n"),
            F.avg("v").alias("m"),
            F.var_pop("v").alias("var"),
            F.min("v").alias("low"),
            F.max("v").alias("high"),
        )
    )
    total, mean = F.sum("n"), F.sum(F.col("n") * F.col("m")) / F.sum("n")
    squares = F.sum(F.col("n") * (F.col("var") + F.col("m") * F.col("m")))
    groups = binned.groupBy(by).agg(
        total.alias("n"),
        F.sqrt(F.greatest(F.lit(0.0), F.try_divide(squares - total * mean * mean, total - 1))).alias("sd"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.collect_list(F.struct("n", "m")).alias("bins"),
    )
    groups = groups.where("low < high").withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    first, last = F.col("low") - cut * F.col("bw"), F.col("high") + cut * F.col("bw")
    listed = groups.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    listed = listed.withColumn("x", first + F.col("point") * (last - first) / (points - 1))

    def kernel(acc: Column, b: Column) -> Column:
        z = (F.col("x") - b["m"]) / F.col("bw")
        return acc + b["n"] * F.exp(-0.5 * z * z)

    area = F.col("n") * F.col("bw") * math.sqrt(2 * math.pi)
    return listed.select(by, "point", "x", (F.aggregate("bins", F.lit(0.0), kernel) / area).alias("density"))


def level_series(levels: tuple[str, ...], spark) -> DataFrame:
    """A fixed order of levels as (pos, level)."""
    return spark.range(1).select(F.posexplode(F.array(*[F.lit(x) for x in levels])).alias("pos", "level"))


def by_level(
    df: DataFrame, column: str, levels: tuple[str, ...], value: str | None = None
) -> DataFrame:
    """Counts (or means of ``value``) in a fixed order of levels; missing ones are null."""
    measure = F.count(F.lit(1)) if value is None else F.avg(value)
    found = df.groupBy(F.col(column).alias("level")).agg(measure.alias("result"))
    listed = level_series(levels, df.sparkSession)
    return listed.join(found, "level", "left").select("pos", "level", "result").orderBy("pos")


def mean_by_level(df: DataFrame, column: str, levels: tuple[str, ...], value: str) -> DataFrame:
    """Mean per level in a fixed order, beside the mean of all rows, in one scan.

    Unlisted levels are folded into one before grouping, so the groups are never
    more than the listed levels and one.
    """
    listed_only = F.when(F.col(column).isin(*levels), F.col(column))
    found = df.groupBy(listed_only.alias("level")).agg(
        F.sum(value).alias("s"), F.count(value).alias("c")
    )
    whole = Window.partitionBy(F.lit(0))
    joined = level_series(levels, df.sparkSession).join(found, "level", "full_outer")
    overall = F.try_divide(F.sum("s").over(whole), F.sum("c").over(whole))
    return (
        joined.withColumn("global_mean", overall)
        .filter(F.col("pos").isNotNull())
        .select("pos", "level", F.try_divide("s", "c").alias("mean"), "global_mean")
        .orderBy("pos")
    )


# --- correlation -------------------------------------------------------------


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson matrix over pairwise complete rows, as (a, b, r) for every pair: one row of
    aggregates for each task. A column without two different values has no r."""
    columns = list(columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    computed = numbers.agg(
        *[F.when(F.min(c) < F.max(c), F.lit(1.0)).alias(f"own{i}") for i, c in enumerate(columns)],
        *[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)],
    )

    def cell(a: str, b: str, r: str) -> Column:
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(r).alias("r"))

    cells = [cell(c, c, f"own{i}") for i, c in enumerate(columns)]
    for i, (a, b) in enumerate(pairs):
        cells += [cell(a, b, f"r{i}"), cell(b, a, f"r{i}")]
    return computed.select(F.inline(F.array(*cells)))


def correlations_with(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """Correlation of every column with the target, highest first."""
    others = [c for c in columns if c != target]
    computed = df.agg(*[F.corr(c, target).alias(f"r{i}") for i, c in enumerate(others)])
    place = {c: f"r{i}" for i, c in enumerate(others)}
    cells = _cells(others, r=lambda c: F.col(place[c]))
    return computed.select(F.inline(cells)).orderBy(F.desc_nulls_last("r"), "column")


# --- describe ----------------------------------------------------------------

QUARTILES = [0.25, 0.5, 0.75]


def describe(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """count, mean, std (n-1), min, quartiles and max per column (and group)."""
    by, columns = list(by), list(columns)
    moments = df.groupBy(*by).agg(
        *[
            f(F.col(c).cast("double")).alias(f"{n}{i}")
            for i, c in enumerate(columns)
            for n, f in (("c", F.count), ("a", F.avg), ("s", F.stddev_samp), ("lo", F.min), ("hi", F.max))
        ]
    )
    place = {c: i for i, c in enumerate(columns)}
    cells = _cells(
        columns,
        count=lambda c: F.col(f"c{place[c]}"),
        mean=lambda c: F.col(f"a{place[c]}"),
        std=lambda c: F.col(f"s{place[c]}"),
        min=lambda c: F.col(f"lo{place[c]}"),
        max=lambda c: F.col(f"hi{place[c]}"),
    )
    long = moments.select(*by, F.inline(cells))
    quartiles = exact_quantiles(df, columns, QUARTILES, by)
    joined = join_null_safe(long, quartiles, [*by, "column"], "left")
    return joined.select(
        *by,
        "column",
        "count",
        "mean",
        "std",
        "min",
        F.col("q")[0].alias("q25"),
        F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"),
        "max",
    )


def quantiles(df: DataFrame, column: str, probs: list[float]) -> DataFrame:
    """One row per probability."""
    found = exact_quantiles(df, [column], probs)
    listed = F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("p"), F.col("q").alias("value"))
    return found.select(F.inline(listed))


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles, whiskers (extreme points within 1.5 IQR) and outliers per group."""
    kept = df.filter(F.col(value).isNotNull()).select(by, F.col(value).cast("double").alias("value"))
    quartiles = exact_quantiles(kept, ["value"], QUARTILES, [by]).select(
        by,
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("med"),
        F.col("q")[2].alias("q3"),
    )
    fenced = join_null_safe(kept, quartiles, [by])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return fenced.groupBy(by).agg(
        F.first("q1").alias("q1"),
        F.first("med").alias("med"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


# --- cycles ------------------------------------------------------------------


def cycles(df: DataFrame, spec: S.ReadingSpec = S.READINGS) -> DataFrame:
    """Mean target by hour and by weekday, as (cycle, slot, mean, n), in one scan."""
    t = F.col(spec.time)
    # Hours and weekdays are counted together first; only 24 * 7 rows fan out.
    counted = (
        df.filter(F.col(spec.target).isNotNull())
        .groupBy(C.hour(t).alias("h"), C.weekday(t).alias("d"))
        .agg(F.sum(spec.target).alias("s"), F.count(F.lit(1)).alias("c"))
    )
    slots = F.inline(
        F.array(
            F.struct(F.lit("hora").alias("cycle"), F.col("h").cast("int").alias("slot")),
            F.struct(F.lit("dia_semana").alias("cycle"), F.col("d").cast("int").alias("slot")),
        )
    )
    return (
        counted.select("s", "c", slots)
        .groupBy("cycle", "slot")
        .agg((F.sum("s") / F.sum("c")).alias("mean"), F.sum("c").alias("n"))
    )


def hour_pivot(df: DataFrame, spec: S.ReadingSpec = S.READINGS) -> DataFrame:
    """Entity by hour: mean target, one column per hour."""
    kept = df.filter(F.col(spec.target).isNotNull())
    names = [f"h{h:02d}" for h in range(24)]
    slot = F.concat(F.lit("h"), F.lpad(F.hour(spec.time).cast("string"), 2, "0"))
    return (
        kept.withColumn("slot", slot)
        .groupBy(spec.entity)
        .pivot("slot", names)
        .agg(F.avg(spec.target))
    )


def same_month_by_year(
    df: DataFrame, month: int, columns: list[str], time: str = S.TIME, years: tuple[int, int] | None = None
) -> DataFrame:
    """Mean of a calendar month per year, and its change against the first year.

    The months of all years from the first to the last are named as literal ranges, so the
    scan skips other files, and in a loaded snapshot other months' folders. ``years`` are
    looked up where they are not given: in a snapshot by its folders' names.
    """
    if years is None:
        year = F.substring(F.col(MONTH_FOLDER).cast("string"), 1, 4) if MONTH_FOLDER in df.columns else F.year(time)
        found = df.agg(F.min(year.cast("int")).alias("first"), F.max(year.cast("int")).alias("last")).first()
        years = (found["first"], found["last"]) if found["first"] is not None else (1, 0)
    spans = []
    for y in range(years[0], years[1] + 1):
        after = dt.datetime(y + month // 12, month % 12 + 1, 1)
        spans.append(S.TimeSpan(str(y), dt.datetime(y, month, 1), after))
    yearly = (
        slice_spans(df, tuple(spans), time)
        .groupBy(F.year(time).alias("year"))
        .agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)])
    )
    place = {c: f"m{i}" for i, c in enumerate(columns)}
    long = yearly.select("year", F.inline(_cells(columns, mean=lambda c: F.col(place[c]))))
    base = F.first("mean").over(Window.partitionBy("column").orderBy("year"))
    return long.withColumn("pct_change", relative_change(F.col("mean"), base) * 100)


def prediction_summary(df: DataFrame, prediction: str = "prediccion_pm25") -> DataFrame:
    """Rows, mean and 95th percentile of a prediction column, to 3 digits."""
    p95 = quantiles(df, prediction, [0.95]).select(F.round("value", 3).alias("p95"))
    means = df.agg(F.count(prediction).alias("n_rows"), F.round(F.avg(prediction), 3).alias("mean"))
    return means.withColumn("p95", p95.scalar())


def two_sample_summary(
    df: DataFrame, columns: list[str], sample: str
) -> DataFrame:
    """Describe and null share of every column, per sample."""
    described = describe(df, columns, [sample])
    nulls = null_share(df, F.col(sample), sample, columns)
    return join_null_safe(described, nulls, [sample, "column"], "left")
