"""Queries over profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa import spec as S
from brisa.functions import calendar as C
from brisa.operators import profile as O
from brisa.operators.metrics import PREDICTION
from brisa.operators.partitions import label_rows
from brisa.queries import models as M
from brisa.queries import tables as Q
from brisa.queries.registry import query
from brisa.session import scratch_path
from brisa.sources.readings import ensure_snapshot

ALL = (*S.POLLUTANTS, *S.WEATHER)
_WR = f"WITH {Q.R}"
_WL = f"WITH {Q.L}"


def _round(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _unpivot(columns, template: str, source: str, glue: str = " UNION ALL ") -> str:
    return glue.join(template.format(c=c, i=i, source=source) for i, c in enumerate(columns))


@query(
    "dataset_summary",
    f"{_WR} SELECT count(*) AS n_rows, CAST(15 AS BIGINT) AS n_columns, min(datetime) AS first_time, "
    "max(datetime) AS last_time, count(DISTINCT station) AS n_entities FROM r",
)
def dataset_summary(spark, sf_dir):
    return O.summary(Q.readings(spark, sf_dir), Q.EVENTS)


_NULLABLE = [*ALL, "wd", "station", "datetime"]


@query(
    "null_profile",
    f"WITH {Q.B}, t AS ("
    + _unpivot(
        _NULLABLE,
        "SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls, "
        "round(count(*) FILTER ({c} IS NULL) * 100.0e0 / count(*), 2) AS pct FROM b",
        "b",
    )
    + ") SELECT * FROM t WHERE nulls > 0 ORDER BY nulls DESC, \"column\"",
)
def null_profile(spark, sf_dir):
    return O.null_profile(Q.broken_readings(spark, sf_dir), _NULLABLE)


_NULL_COLUMNS = [*ALL, "wd"]


def _null_share_sql(key: str, name: str, columns) -> str:
    return _unpivot(
        columns,
        f"SELECT {key} AS {name}, '{{c}}' AS \"column\", "
        "round(avg(CASE WHEN {c} IS NULL THEN 1.0e0 ELSE 0.0e0 END) * 100, 6) AS null_pct FROM {source} GROUP BY 1",
        "r",
    )


@query("null_by_entity", f"{_WR} " + _null_share_sql("station", "station", _NULL_COLUMNS))
def null_by_entity(spark, sf_dir):
    rows = O.null_share(Q.readings(spark, sf_dir), F.col("station"), "station", _NULL_COLUMNS)
    return _round(rows, "null_pct")


@query(
    "null_by_month",
    f"{_WL} SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, 'l_quantity' AS \"column\", "
    "round(avg(CASE WHEN l_quantity IS NULL THEN 1.0e0 ELSE 0.0e0 END) * 100, 6) AS null_pct FROM l GROUP BY 1 "
    "UNION ALL SELECT CAST(date_trunc('month', l_shipdate) AS DATE), 'l_tax', "
    "round(avg(CASE WHEN l_tax IS NULL THEN 1.0e0 ELSE 0.0e0 END) * 100, 6) FROM l GROUP BY 1",
)
def null_by_month(spark, sf_dir):
    month = C.month_start(F.col("l_shipdate"))
    rows = O.null_share(Q.lines(spark, sf_dir), month, "month", ["l_quantity", "l_tax"])
    return _round(rows, "null_pct")


@query(
    "rows_by_month",
    f"{_WL} SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS n_rows FROM l GROUP BY 1",
)
def rows_by_month(spark, sf_dir):
    rows = O.rows_by(Q.lines(spark, sf_dir), C.month_start(F.col("l_shipdate")), "month")
    return rows.orderBy("month")


@query("rows_by_entity", f"{_WR} SELECT station, count(*) AS n_rows FROM r GROUP BY station")
def rows_by_entity(spark, sf_dir):
    return O.rows_by(Q.readings(spark, sf_dir), F.col("station"), "station").orderBy("station")


@query(
    "value_checks",
    f"WITH {Q.B}, t AS ("
    + _unpivot(
        ALL,
        "SELECT '{c}' AS \"column\", count(*) FILTER ({c} <= 0) AS n_not_positive, "
        "count(*) FILTER ({c} = 80) AS n_sentinel FROM b",
        "b",
    )
    + " UNION ALL SELECT 'TEMP,DEWP', count(*) FILTER (TEMP < DEWP), "
    "count(*) FILTER (TEMP IS NOT NULL AND DEWP IS NOT NULL) FROM b) SELECT * FROM t",
)
def value_checks(spark, sf_dir):
    b = Q.broken_readings(spark, sf_dir)
    physical = O.physical_check(b).select(
        F.lit("TEMP,DEWP").alias("column"),
        F.col("n_broken").alias("n_not_positive"),
        F.col("n_complete").alias("n_sentinel"),
    )
    return O.value_checks(b, list(ALL), 80.0).unionByName(physical)


def _histogram_sql(source: str, column: str, bins: int, value: str, where: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", CAST(i AS INT) AS bin, round(lo + i * ((hi - lo) / {bins}), 6) AS low, "
        f"round(lo + (i + 1) * ((hi - lo) / {bins}), 6) AS high, coalesce(n, 0) AS n FROM "
        f"(SELECT min({value}) AS lo, max({value}) AS hi FROM {source} WHERE {where}) CROSS JOIN range({bins}) s(i) "
        f"LEFT JOIN (SELECT least(floor(({value} - lo) * {bins} / (hi - lo)), {bins - 1}) AS bin, count(*) AS n "
        f"FROM {source}, (SELECT min({value}) AS lo, max({value}) AS hi FROM {source} WHERE {where}) "
        f"WHERE {where} GROUP BY 1) h ON h.bin = s.i"
    )


@query(
    "histogram",
    f"{_WR} "
    + " UNION ALL ".join(_histogram_sql("r", c, 60, c, f"{c} IS NOT NULL") for c in S.WEATHER)
    + " UNION ALL "
    + _histogram_sql("r", "pm25", 60, "pm25", "pm25 IS NOT NULL"),
)
def histogram(spark, sf_dir):
    return _round(O.histogram(Q.readings(spark, sf_dir), [*S.WEATHER, "pm25"], 60), "low", "high")


@query("histogram_target", f"{_WR} " + _histogram_sql("r", "pm25", 80, "pm25", "pm25 IS NOT NULL"))
def histogram_target(spark, sf_dir):
    return _round(O.histogram(Q.readings(spark, sf_dir), ["pm25"], 80), "low", "high")


@query(
    "histogram_log",
    f"{_WR} "
    + " UNION ALL ".join(_histogram_sql("r", c, 60, f"log10({c})", f"{c} > 0") for c in S.POLLUTANTS),
)
def histogram_log(spark, sf_dir):
    rows = O.histogram(Q.readings(spark, sf_dir), list(S.POLLUTANTS), 60, log=True)
    return _round(rows, "low", "high")


_ORDER = "d AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{s}')" for i, s in enumerate(S.SECTORS)) + ") t(pos, level))"


@query(
    "sector_counts",
    f"{_WR}, {_ORDER} SELECT CAST(pos AS INT) AS pos, level, n AS result FROM d LEFT JOIN "
    "(SELECT wd, count(*) AS n FROM r WHERE wd <> 'ENE' GROUP BY wd) c ON c.wd = d.level ORDER BY pos",
)
def sector_counts(spark, sf_dir):
    """Counts in angular order; one sector is made to be missing and keeps its place."""
    some = Q.readings(spark, sf_dir).withColumn("wd", F.nullif("wd", F.lit("ENE")))
    return O.by_level(some, "wd", S.SECTORS)


@query(
    "target_by_sector",
    f"{_WR}, {_ORDER} SELECT CAST(pos AS INT) AS pos, level, round(m, 6) AS mean, "
    "round((SELECT avg(pm25) FROM r), 6) AS global_mean FROM d LEFT JOIN "
    "(SELECT wd, avg(pm25) AS m FROM r GROUP BY wd) c ON c.wd = d.level ORDER BY pos",
)
def target_by_sector(spark, sf_dir):
    rows = O.mean_by_level(Q.readings(spark, sf_dir), "wd", S.SECTORS, "pm25")
    return _round(rows, "mean", "global_mean")


_PAIRS = [(a, b) for i, a in enumerate(ALL) for b in ALL[i + 1 :]]


@query(
    "corr_matrix",
    f"{_WR}, c AS (SELECT "
    + ", ".join(f"corr({a}, {b}) AS r{i}" for i, (a, b) in enumerate(_PAIRS))
    + " FROM r) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(r{i}, 6) + 0.0e0 AS r FROM c UNION ALL SELECT '{b}', '{a}', round(r{i}, 6) + 0.0e0 FROM c"
        for i, (a, b) in enumerate(_PAIRS)
    )
    + " UNION ALL "
    + " UNION ALL ".join(f"SELECT '{c}', '{c}', 1.0e0" for c in ALL),
)
def corr_matrix(spark, sf_dir):
    rows = O.correlations(Q.readings(spark, sf_dir), list(ALL))
    return rows.withColumn("r", F.round("r", 6) + 0.0)


_OTHERS = [c for c in ALL if c != "pm25"]


@query(
    "corr_with_target",
    f"{_WR}, c AS (SELECT "
    + ", ".join(f"corr({c}, pm25) AS r{i}" for i, c in enumerate(_OTHERS))
    + " FROM r), u AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", r{i} AS r FROM c" for i, c in enumerate(_OTHERS))
    + ') SELECT "column", round(r, 6) + 0.0e0 AS r FROM u ORDER BY u.r DESC, "column"',
)
def corr_with_target(spark, sf_dir):
    rows = O.correlations_with(Q.readings(spark, sf_dir), "pm25", list(ALL))
    return rows.withColumn("r", F.round("r", 6) + 0.0)


def _describe_sql(source: str, columns, by: str | None = None) -> str:
    keep, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return " UNION ALL ".join(
        f"SELECT {keep}'{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS std, min({c}) AS \"min\", round(quantile_cont({c}, 0.25), 6) AS q25, "
        f"round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, "
        f'max({c}) AS "max" FROM {source}{group}'
        for c in columns
    )


_DESCRIBED = ("mean", "std", "q25", "q50", "q75")


@query("describe_target", f"{_WR} " + _describe_sql("r", ["pm25", "PM10", "CO"]))
def describe_target(spark, sf_dir):
    return _round(O.describe(Q.readings(spark, sf_dir), ["pm25", "PM10", "CO"]), *_DESCRIBED)


_LABELLED = f"q AS (SELECT *, {Q.label_sql()} AS particion FROM r WHERE datetime < TIMESTAMP '2024-02-01 00:00:00')"
_LABELLED_L = f"q AS (SELECT *, {Q.label_sql(Q.LINE_SPEC.ranges, 'l_shipdate')} AS particion FROM l)"


@query("describe_by_partition", f"{_WL}, {_LABELLED_L} " + _describe_sql("q", ["price"], "particion"))
def describe_by_partition(spark, sf_dir):
    rows = label_rows(Q.lines(spark, sf_dir), Q.LINE_SPEC.ranges, "l_shipdate")
    return _round(O.describe(rows, ["price"], ["particion"]), *_DESCRIBED)


_PROBS = [0.5, 0.9, 0.99, 0.999, 1.0]


@query(
    "target_quantiles",
    f"{_WL} "
    + " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(l_extendedprice, {p}), 6) AS value FROM l" for p in _PROBS
    ),
)
def target_quantiles(spark, sf_dir):
    return _round(O.quantiles(Q.lines(spark, sf_dir), "l_extendedprice", _PROBS), "value")


@query(
    "target_by_month",
    f"{_WL} SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, round(avg(l_quantity), 6) AS mean, "
    "count(l_quantity) AS n FROM l WHERE l_quantity IS NOT NULL GROUP BY 1",
)
def target_by_month(spark, sf_dir):
    month = C.month_start(F.col("l_shipdate"))
    return _round(O.mean_by(Q.lines(spark, sf_dir), month, "month", "l_quantity"), "mean")


@query(
    "target_cycles",
    f"{_WR} SELECT 'hora' AS cycle, CAST(hour(datetime) AS INT) AS slot, round(avg(pm25), 6) AS mean, count(pm25) AS n "
    "FROM r WHERE pm25 IS NOT NULL GROUP BY 1, 2 UNION ALL SELECT 'dia_semana', CAST(isodow(datetime) - 1 AS INT), "
    "round(avg(pm25), 6), count(pm25) FROM r WHERE pm25 IS NOT NULL GROUP BY 1, 2",
)
def target_cycles(spark, sf_dir):
    return _round(O.cycles(Q.readings(spark, sf_dir), Q.EVENTS), "mean")


@query(
    "box_by_entity",
    f"{_WR}, k AS (SELECT station, quantile_cont(pm25, 0.25) AS q1, quantile_cont(pm25, 0.5) AS med, "
    "quantile_cont(pm25, 0.75) AS q3 FROM r WHERE pm25 IS NOT NULL GROUP BY station), j AS (SELECT r.station, pm25, q1, med, q3, "
    "pm25 >= q1 - (q3 - q1) * 1.5 AND pm25 <= q3 + (q3 - q1) * 1.5 AS inside FROM r JOIN k ON r.station = k.station "
    "WHERE pm25 IS NOT NULL) SELECT station, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS med, "
    "round(any_value(q3), 6) AS q3, min(pm25) FILTER (inside) AS whisker_low, max(pm25) FILTER (inside) AS whisker_high, "
    "count(*) FILTER (NOT inside) AS n_outliers FROM j GROUP BY station",
)
def box_by_entity(spark, sf_dir):
    return _round(O.box_stats(Q.readings(spark, sf_dir), "pm25", "station"), "q1", "med", "q3")


@query(
    "entity_hour_pivot",
    f"{_WR} SELECT station, "
    + ", ".join(f"round(avg(pm25) FILTER (hour(datetime) = {h}), 6) AS h{h:02d}" for h in range(24))
    + " FROM r WHERE pm25 IS NOT NULL GROUP BY station",
)
def entity_hour_pivot(spark, sf_dir):
    rows = O.hour_pivot(Q.readings(spark, sf_dir), Q.EVENTS)
    return _round(rows, *[f"h{h:02d}" for h in range(24)])


@query(
    "cycle_by_partition",
    f"{_WR}, {_LABELLED} SELECT particion, CAST(hour(datetime) AS INT) AS hora, round(avg(pm25), 6) AS mean, count(pm25) AS n "
    "FROM q WHERE pm25 IS NOT NULL AND particion IN ('train', 'produccion') GROUP BY 1, 2",
)
def cycle_by_partition(spark, sf_dir):
    two = tuple(r for r in Q.RANGES if r.label in ("train", "produccion"))
    rows = label_rows(Q.readings(spark, sf_dir), two).filter(F.col("pm25").isNotNull())
    grouped = rows.groupBy("particion", F.hour("datetime").alias("hora"))
    return grouped.agg(F.round(F.avg("pm25"), 6).alias("mean"), F.count("pm25").alias("n"))


_D = "x AS (SELECT particion, log10(price) AS v FROM q WHERE price > 0), g AS (SELECT min(v) AS lo, max(v) AS hi FROM x)"


@query(
    "density_by_partition",
    f"{_WL}, {_LABELLED_L}, {_D}, h AS (SELECT particion, least(floor((v - lo) * 60 / (hi - lo)), 59) AS bin, count(*) AS n FROM x, g GROUP BY 1, 2), "
    "s AS (SELECT DISTINCT particion FROM q), t AS (SELECT particion, count(*) AS total FROM x GROUP BY 1) "
    "SELECT s.particion, CAST(i AS INT) AS bin, round(lo + i * ((hi - lo) / 60), 6) AS low, round(lo + (i + 1) * ((hi - lo) / 60), 6) AS high, "
    "coalesce(h.n, 0) AS n, round(coalesce(h.n, 0) / (t.total * ((lo + (i + 1) * ((hi - lo) / 60)) - (lo + i * ((hi - lo) / 60)))), 6) AS density "
    "FROM s CROSS JOIN range(60) b(i) CROSS JOIN g LEFT JOIN h ON h.particion = s.particion AND h.bin = b.i JOIN t ON t.particion = s.particion",
)
def density_by_partition(spark, sf_dir):
    rows = label_rows(Q.lines(spark, sf_dir), Q.LINE_SPEC.ranges, "l_shipdate")
    return _round(O.density(rows, "price", "particion"), "low", "high", "density")


_CURVE = (
    "x AS (SELECT particion, log10(price) AS v FROM q WHERE price > 0 AND particion IS NOT NULL), "
    "b AS (SELECT particion, floor(v * 256) AS bin, count(*) AS n, avg(v) AS m FROM x GROUP BY 1, 2), "
    "g AS (SELECT particion, count(*) AS n, min(v) AS low, max(v) AS high, stddev_samp(v) * power(count(*), -0.2e0) AS bw FROM x GROUP BY 1), "
    "p AS (SELECT particion, n, bw, i, low - 3 * bw + i * (high - low + 6 * bw) / 199 AS x FROM g CROSS JOIN range(200) s(i) WHERE low < high)"
)


@query(
    "density_curve",
    f"{_WL}, {_LABELLED_L}, {_CURVE} SELECT p.particion, CAST(i AS INT) AS point, round(x, 6) AS x, "
    "round(sum(b.n * exp(-0.5e0 * power((x - m) / bw, 2))) / (any_value(p.n) * any_value(bw) * sqrt(2 * pi())), 6) AS density "
    "FROM p JOIN b ON b.particion = p.particion GROUP BY p.particion, i, x",
)
def density_curve(spark, sf_dir):
    """The curve of prices on a log scale, each partition's area 1."""
    rows = label_rows(Q.lines(spark, sf_dir), Q.LINE_SPEC.ranges, "l_shipdate")
    return _round(O.density_curve(rows, "price", "particion"), "x", "density")


@query(
    "yoy_same_month",
    f"{_WL}, y AS (SELECT year(l_shipdate) AS year, avg(l_quantity) AS l_quantity, avg(price) AS price FROM l "
    "WHERE month(l_shipdate) = 1 GROUP BY 1), u AS (SELECT year, 'l_quantity' AS \"column\", l_quantity AS mean FROM y UNION ALL "
    "SELECT year, 'price', price FROM y) SELECT CAST(year AS INT) AS year, \"column\", round(mean, 6) AS mean, "
    "round((mean - first_value(mean) OVER w) / first_value(mean) OVER w * 100, 6) + 0.0e0 AS pct_change FROM u "
    'WINDOW w AS (PARTITION BY "column" ORDER BY year)',
)
def yoy_same_month(spark, sf_dir):
    """Every January, from the folders of a snapshot that hold one."""
    path = scratch_path(spark, "snapshot")
    lines = ensure_snapshot(spark, path, lambda: Q.lines(spark, sf_dir), "l_shipdate")
    rows = O.same_month_by_year(lines, 1, ["l_quantity", "price"], "l_shipdate")
    return rows.select(
        "year", "column", F.round("mean", 6).alias("mean"), (F.round("pct_change", 6) + 0.0).alias("pct_change")
    )


@query(
    "prediction_summary",
    f"WITH {Q.models_sql('produccion')} SELECT count(*) AS n_rows, round(avg(candidate), 3) AS mean, "
    "round(quantile_cont(candidate, 0.95), 3) AS p95 FROM s",
)
def prediction_summary(spark, sf_dir):
    rows = M.scored(spark, sf_dir, "produccion").withColumnRenamed("candidate", PREDICTION)
    return O.prediction_summary(rows, PREDICTION)


_TWO = ["price", "l_quantity", "l_tax"]


@query(
    "column_summary_two_sample",
    f"{_WL}, {_LABELLED_L}, d AS ({_describe_sql('q', _TWO, 'particion')}), n AS ("
    + " UNION ALL ".join(
        f"SELECT particion, '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0e0 ELSE 0.0e0 END) * 100, 6) AS null_pct FROM q GROUP BY 1"
        for c in _TWO
    )
    + ") SELECT d.*, n.null_pct FROM d JOIN n ON d.particion = n.particion AND d.\"column\" = n.\"column\" "
    "WHERE d.particion IN ('train', 'produccion')",
)
def column_summary_two_sample(spark, sf_dir):
    two = tuple(r for r in Q.LINE_SPEC.ranges if r.label in ("train", "produccion"))
    rows = label_rows(Q.lines(spark, sf_dir), two, "l_shipdate")
    return _round(O.two_sample_summary(rows, _TWO, "particion"), *_DESCRIBED, "null_pct")
