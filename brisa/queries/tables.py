"""How the given tables serve as readings, and the SQL that says the same.

Measures the tables lack are derived from columns they have, and nulls are
injected by row number, with expressions both engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brisa import spec as S

RANGES = (
    S.days("train", "2024-01-01", "2024-01-15"),
    S.days("valid", "2024-01-16", "2024-01-20"),
    S.days("test", "2024-01-21", "2024-01-25"),
    S.days("produccion", "2024-01-26", "2024-01-31"),
)
AS_OF = "2024-02-01 00:00:00"
EVENTS = S.ReadingSpec(ranges=RANGES)

_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE)"
_SECTOR = "CASE event_id % 16 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(S.SECTORS)) + " END"


def _gap(every: int, value: str) -> str:
    return f"CASE WHEN event_id % {every} = 0 THEN NULL ELSE {value} END"


#: events as sound readings.
SOUND = {
    "event_id": "event_id",
    "datetime": "ts",
    "station": "concat('S', CAST(user_id % 12 AS STRING))",
    "wd": _gap(97, _SECTOR),
    "pm25": _gap(50, "value"),
    "PM10": _gap(20, f"{_K} * 10"),
    "SO2": _gap(33, "value / 2"),
    "NO2": _gap(29, f"{_K} * 4"),
    "CO": _gap(13, "100 + value * 15"),
    "O3": _gap(31, "CAST(user_id % 150 * 8 AS DOUBLE)"),
    "TEMP": _gap(101, "CAST(event_id % 60 - 20 AS DOUBLE)"),
    "PRES": _gap(103, "CAST(950 + event_id % 120 AS DOUBLE)"),
    "DEWP": _gap(107, "CAST(event_id % 60 - 22 - user_id % 8 AS DOUBLE)"),
    "RAIN": _gap(109, f"CASE WHEN {_K} < 90 THEN 0.0E0 ELSE {_K} - 89 END"),
    "WSPM": _gap(113, "event_id % 7 * 1.5E0"),
}

#: the same with one defect per contract rule.
BROKEN = {
    **SOUND,
    "datetime": "CASE WHEN event_id % 301 = 0 THEN NULL ELSE date_trunc('hour', ts) END",
    "station": "CASE WHEN event_id % 211 = 0 THEN NULL ELSE concat('S', CAST(user_id % 12 AS STRING)) END",
    "wd": f"CASE WHEN event_id % 53 = 0 THEN 'XX' ELSE {SOUND['wd']} END",
    "pm25": _gap(50, "value * 3"),
    "NO2": _gap(29, f"{_K} * 4 + 20"),
    "O3": "CASE WHEN event_id % 5 < 2 THEN NULL ELSE CAST(user_id % 150 * 8 AS DOUBLE) END",
    "DEWP": "CASE WHEN event_id % 41 = 0 THEN 45.0E0 ELSE CAST(event_id % 60 - 22 AS DOUBLE) END",
}
BROKEN_AS_OF = "2024-01-29 12:00:00"

#: lineitem as multi-year readings; later rows drift in price and flag.
LINES = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_suppkey": "l_suppkey",
    "l_shipdate": "l_shipdate",
    "l_quantity": "CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE l_quantity END",
    "l_discount": "l_discount",
    "l_tax": "CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE l_tax END",
    "price": "CASE WHEN l_shipdate >= TIMESTAMP '2001-01-01 00:00:00' THEN l_extendedprice * 1.5E0 ELSE l_extendedprice END",
    "l_extendedprice": "l_extendedprice",
    "flag": "CASE WHEN l_shipdate >= TIMESTAMP '2001-01-01 00:00:00' AND l_linenumber < 3 THEN 'X' "
    "WHEN l_orderkey % 41 = 0 THEN NULL ELSE l_returnflag END",
    "l_linestatus": "l_linestatus",
}
LINE_SPEC = S.ReadingSpec(
    time="l_shipdate",
    entity="l_suppkey",
    target="l_extendedprice",
    key=("l_orderkey", "l_linenumber"),
    categoricals=("flag", "l_linestatus"),
    measures=("l_quantity", "l_discount", "l_tax", "price"),
    ranges=(
        S.days("train", "1995-01-01", "1998-12-31"),
        S.days("valid", "1999-01-01", "1999-12-31"),
        S.days("test", "2000-01-01", "2000-12-31"),
        S.days("produccion", "2001-01-01", "2001-12-31"),
    ),
    limits={},
    levels={"flag": ("A", "N", "R", "X")},
    ordered=(),
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_read(spark, sf_dir, "events"), SOUND)


def broken_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_read(spark, sf_dir, "events"), BROKEN)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_read(spark, sf_dir, "lineitem"), LINES)


# --- the same as SQL -----------------------------------------------------------


def _cte(name: str, table: str, columns: dict[str, str]) -> str:
    cells = ", ".join(f'{e} AS "{c}"' for c, e in columns.items())
    return f"{name} AS (SELECT {cells} FROM {table})"


R = _cte("r", "events", SOUND)
B = _cte("b", "events", BROKEN)
L = _cte("l", "lineitem", LINES)


def cell_sql(text: str) -> str:
    """A value of a row hash: its length, a colon, itself; null is a mark of its own."""
    return f"coalesce(concat(CAST(length({text}) AS VARCHAR), ':', {text}), '~')"


def fingerprint_sql(*texts: str) -> str:
    """Row count and sum of row hashes as one text."""
    row = "concat(" + ", ".join(cell_sql(t) for t in texts) + ")"
    return (
        "concat_ws('-', CAST(count(*) AS VARCHAR), CAST(coalesce(sum(CAST("
        f"concat('0x', substr(md5({row}), 1, 15)) AS BIGINT)), 0) AS VARCHAR))"
    )


def range_sql(r: S.TimeSpan, time: str = "datetime") -> str:
    return (
        f"{time} >= TIMESTAMP '{r.start}' AND {time} < TIMESTAMP '{r.end}'"
    )


def slice_sql(label: str, ranges=RANGES, time: str = "datetime") -> str:
    return " OR ".join(f"({range_sql(r, time)})" for r in ranges if r.label == label)


def label_sql(ranges=RANGES, time: str = "datetime") -> str:
    arms = " ".join(f"WHEN {range_sql(r, time)} THEN '{r.label}'" for r in ranges)
    return f"CASE {arms} END"


def season_sql(t: str) -> str:
    return (
        f"CASE WHEN month({t}) IN (12, 1, 2) THEN 'invierno' WHEN month({t}) IN (3, 4, 5) THEN "
        f"'primavera' WHEN month({t}) IN (6, 7, 8) THEN 'verano' WHEN {t} IS NOT NULL THEN 'otonio' END"
    )


def calendar_sql(t: str) -> str:
    return (
        f"{season_sql(t)} AS temporada, CAST(hour({t}) AS SMALLINT) AS hora, "
        f"CAST(isodow({t}) - 1 AS SMALLINT) AS dia_semana, CAST(month({t}) AS SMALLINT) AS mes"
    )


def band_sql(h: str) -> str:
    return (
        f"CASE WHEN {h} BETWEEN 0 AND 5 THEN 'madrugada' WHEN {h} BETWEEN 6 AND 11 THEN 'manana' "
        f"WHEN {h} BETWEEN 12 AND 17 THEN 'tarde' WHEN {h} BETWEEN 18 AND 23 THEN 'noche' "
        "ELSE 'desconocida' END"
    )


def clean_sql(name: str, source: str, where: str = "TRUE") -> str:
    """CTEs ``<name>`` (cleaned, with features) of a readings CTE."""
    m = ", ".join(f'median("{c}") AS "m_{c}"' for c in S.MEASURES)
    flags = ", ".join(f'CAST("{c}" IS NULL AS TINYINT) AS "{c}_era_nulo"' for c in S.MEASURES)
    filled = ", ".join(f'coalesce("{c}", "m_{c}") AS "{c}"' for c in S.MEASURES)
    kept = f"pm25 IS NOT NULL AND ({where})"
    return (
        f"{name}_m AS (SELECT {m} FROM {source} WHERE {kept}), "
        f"{name} AS (SELECT event_id, datetime, coalesce(station, 'desconocido') AS station, "
        f"coalesce(wd, 'desconocido') AS wd, pm25, {flags}, {filled}, {calendar_sql('datetime')} "
        f"FROM {source}, {name}_m WHERE {kept})"
    )


def prepared_sql(label: str) -> str:
    """CTE ``p_<label>``: a prepared partition of the sound readings."""
    return clean_sql(f"p_{label}", "r", slice_sql(label))


def models_sql(label: str) -> str:
    """CTE ``s``: a prepared partition scored by the train mean and entity means.

    Champion is the mean of the prepared train rows, candidate the mean of their
    entity.
    """
    return (
        f"{R}, {prepared_sql('train')}, {prepared_sql(label)}, "
        "g AS (SELECT avg(pm25) AS champion FROM p_train), "
        "e AS (SELECT station, avg(pm25) AS candidate FROM p_train GROUP BY station), "
        f"s AS (SELECT p.*, g.champion, coalesce(e.candidate, g.champion) AS candidate "
        f"FROM p_{label} p LEFT JOIN e ON p.station = e.station CROSS JOIN g)"
    )


STACKED = (
    "m AS (SELECT 'champion' AS model, champion AS prediction, * FROM s "
    "UNION ALL SELECT 'candidate' AS model, candidate AS prediction, * FROM s)"
)
