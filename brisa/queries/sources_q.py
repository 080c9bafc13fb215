"""Queries over sources, sinks and cell-level operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from brisa import spec as S
from brisa.functions import calendar as C
from brisa.functions import values as V
from brisa.operators.features import build_features, select_features
from brisa.operators.partitions import label_rows, slice_label
from brisa.operators.metrics import PREDICTION, global_metrics, measure_entities, metrics_long
from brisa.operators.forest import Baseline
from brisa.queries import models as M
from brisa.queries import tables as Q
from brisa.queries.registry import query
from brisa.session import scratch_path
from brisa.sources import ledger as J
from brisa.sources import readings as A
from brisa.sources import sinks as K
from brisa.sources import sketches as H
from brisa.sources.versions import Versions, merged_print
from brisa.sources.incoming import check_incoming, store_incoming

MOMENT = dt.datetime(2024, 2, 1, 12, 0, 0)
RAW_ROWS = (
    "No, datetime, station, wd, pm25, PM10, SO2, NO2, CO, O3, TEMP, PRES, DEWP, RAIN, WSPM"
)


@query(
    "scan_csv_union",
    f"WITH {Q.R} SELECT CAST(event_id AS INT) AS No, date_trunc('hour', datetime) AS datetime, "
    "station, wd, pm25, PM10, SO2, NO2, CO, O3, TEMP, PRES, DEWP, RAIN, WSPM FROM r",
)
def scan_csv_union(spark, sf_dir):
    folder = scratch_path(spark, "csv")
    r = Q.readings(spark, sf_dir)
    t = F.col("datetime")
    raw = r.select(
        F.col("event_id").cast("int").alias("No"),
        F.year(t).alias("year"),
        F.month(t).alias("month"),
        F.dayofmonth(t).alias("day"),
        F.hour(t).alias("hour"),
        F.col("pm25").alias("PM2.5"),
        *["PM10", "SO2", "NO2", "CO", "O3", "TEMP", "PRES", "DEWP", "RAIN", "wd", "WSPM", "station"],
        F.col("station").alias("folder"),
    )
    # A missing value is NA in some files and NaN in others, whose columns come in another order.
    names = [c for c in raw.columns if c != "folder"]
    turned = F.substring("folder", 2, 2).cast("int") % 2 == 1
    options = {"header": True, "nullValue": "NA"}
    raw.filter(~turned).write.partitionBy("folder").options(**options).csv(f"{folder}/a")
    other = raw.filter(turned).withColumns({c: F.coalesce(c, F.lit(float("nan"))) for c in S.MEASURES})
    other = other.withColumn("PM2.5", F.coalesce("`PM2.5`", F.lit(float("nan"))))
    other.select(*[F.col(f"`{c}`") for c in reversed(names)], "folder").write.partitionBy("folder").options(**options).csv(f"{folder}/b")
    found = A.readings_from_raw(A.scan_csv(spark, folder, glob="part-*.csv"))
    return found.select(*RAW_ROWS.split(", "))


#: What is wrong with a raw line, by event.
_DEFECT = (
    "CASE WHEN event_id % 40 = 1 THEN 'short' WHEN event_id % 40 = 2 THEN 'long' WHEN event_id % 40 = 3 THEN 'value:CO' "
    "WHEN event_id % 40 = 4 THEN 'value:year,RAIN' END"
)
_LINE = {
    "No": "CAST(event_id AS INT)", "year": "CASE WHEN event_id % 40 = 4 THEN '20x4' ELSE CAST(year(datetime) AS STRING) END",
    "month": "month(datetime)", "day": "day(datetime)", "hour": "hour(datetime)", "PM2.5": "pm25", "PM10": "PM10",
    "SO2": "SO2", "NO2": "NO2", "CO": "CASE WHEN event_id % 40 = 3 THEN 'bad' ELSE CAST(CO AS STRING) END", "O3": "O3",
    "TEMP": "TEMP", "PRES": "PRES", "DEWP": "DEWP",
    "RAIN": "CASE WHEN event_id % 40 = 4 THEN '1,5' ELSE CAST(RAIN AS STRING) END", "wd": "wd", "WSPM": "WSPM", "station": "station",
}


def _raw_lines(spark, sf_dir):
    """Raw files with rows that are cut short, too long, or hold cells that are no numbers;
    a quoted comma does not make a row long. Every second station's columns are turned."""
    r = Q.readings(spark, sf_dir)
    folder = scratch_path(spark, "lines")
    for turned in (False, True):
        names = list(reversed(_LINE)) if turned else list(_LINE)
        cells = [F.coalesce(F.expr(_LINE[c]).cast("string"), F.lit("NA")) for c in names]
        cells = [F.when(x.contains(","), F.concat(F.lit('"'), x, F.lit('"'))).otherwise(x) for x in cells]
        text = F.concat_ws(",", *cells)
        text = F.when(F.col("event_id") % 40 == 1, F.concat_ws(",", *cells[:-1])).otherwise(text)
        text = F.when(F.col("event_id") % 40 == 2, F.concat(text, F.lit(",more"))).otherwise(text)
        own = r.where((F.substring("station", 2, 2).cast("int") % 2 == 1) == turned)
        lines = own.select(text.alias(",".join(names)))
        lines.write.options(header=True, sep="\u0001", quote="").csv(f"{folder}/{turned}")
    return A.ingest_csv(spark, folder, scratch_path(spark, "ingested"), glob="part-*.csv")


@query(
    "scan_csv_rejects",
    f"WITH {Q.R}, t AS (SELECT event_id, {_DEFECT} AS reason, substr(station, 2)::INT % 2 = 1 AS turned FROM r) "
    "SELECT CASE WHEN turned AND reason = 'short' THEN NULL ELSE CAST(event_id AS INT) END AS no, turned, reason FROM t "
    "WHERE reason IS NOT NULL",
)
def scan_csv_rejects(spark, sf_dir):
    """Rows that do not fit, with their reasons. A turned line that is short lacks its number."""
    _, rejected = _raw_lines(spark, sf_dir)
    turned = F.col("line").like("S%")
    place = F.when(turned, 17).otherwise(0)
    # A quoted comma shifts the cells after it.
    bare = F.regexp_replace("line", '"[^"]*"', "q")
    no = F.get(F.split(bare, ","), place).try_cast("int")
    return rejected.select(no.alias("no"), turned.alias("turned"), "reason")


@query(
    "scan_csv_sound",
    f"WITH {Q.R} SELECT CAST(event_id AS INT) AS No, date_trunc('hour', datetime) AS datetime, "
    f"station, wd, pm25, PM10, SO2, NO2, CO, O3, TEMP, PRES, DEWP, RAIN, WSPM FROM r WHERE {_DEFECT} IS NULL",
)
def scan_csv_sound(spark, sf_dir):
    """The rows beside them keep all their cells."""
    sound, _ = _raw_lines(spark, sf_dir)
    return A.readings_from_raw(sound).select(*RAW_ROWS.split(", "))


@query(
    "snapshot_roundtrip",
    f"WITH {Q.L} SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, flag FROM l",
)
def snapshot_roundtrip(spark, sf_dir):
    """Written once, one folder a month, and read back whole."""
    found = _snapshot(spark, sf_dir)
    return found.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "flag")


@query(
    "snapshot_slice",
    f"WITH {Q.L} SELECT l_orderkey, l_linenumber, l_shipdate, price FROM l WHERE {Q.slice_sql('test', Q.LINE_SPEC.ranges, 'l_shipdate')}",
)
def snapshot_slice(spark, sf_dir):
    """A slice of the snapshot opens the folders of its months only."""
    part = slice_label(_snapshot(spark, sf_dir), "test", Q.LINE_SPEC.ranges, "l_shipdate")
    return part.select("l_orderkey", "l_linenumber", "l_shipdate", "price")


def _snapshot(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    return A.ensure_snapshot(spark, path, lambda: Q.lines(spark, sf_dir), "l_shipdate")


@query(
    "snapshot_versions",
    f"WITH {Q.L} SELECT l_orderkey, l_linenumber, l_shipdate, price, '2' AS version FROM l WHERE l_linenumber <= 2",
)
def snapshot_versions(spark, sf_dir):
    """Written twice; a third write fails in the middle. Readers are left with version 2."""
    lines = Q.lines(spark, sf_dir)
    versions = _versions(spark)
    for most in (1, 2):
        versions.publish(lines.where(F.col("l_linenumber") <= most), "l_shipdate")
    broken = F.when(F.col("l_linenumber") == 3, F.raise_error(F.lit("a broken row"))).otherwise(F.col("price"))
    try:
        versions.publish(lines.withColumn("price", broken.cast("double")), "l_shipdate")
    except Exception as error:
        if "a broken row" not in str(error):
            raise
    else:
        raise AssertionError("the third write was to fail")
    found = versions.read().select("l_orderkey", "l_linenumber", "l_shipdate", "price")
    return found.withColumn("version", F.lit(versions.version()))


def _versions(spark):
    path = scratch_path(spark, "versions")
    return Versions(spark, f"{path}/data", J.Ledger(spark, f"{path}/ledger"), "lines")


_MONTH = "strftime(l_shipdate, '%Y-%m')"


@query(
    "snapshot_changed_months",
    f"WITH {Q.L}, b AS (SELECT {_MONTH} AS month, count(*) AS n_before FROM l WHERE year(l_shipdate) < 2001 GROUP BY 1), "
    f"a AS (SELECT {_MONTH} AS month, count(*) AS n_after, bool_or(l_orderkey % 50 = 0 AND month(l_shipdate) = 3) AS other "
    "FROM l WHERE year(l_shipdate) > 1995 AND (month(l_shipdate) <> 7 OR l_orderkey % 9 > 0) GROUP BY 1), "
    "s AS (SELECT month, CASE WHEN n_before IS NULL THEN 'added' WHEN n_after IS NULL THEN 'removed' "
    "WHEN n_before <> n_after OR other THEN 'changed' END AS status, n_before, n_after FROM b FULL JOIN a USING (month)) "
    "SELECT * FROM s WHERE status IS NOT NULL",
)
def snapshot_changed_months(spark, sf_dir):
    """Months in which two versions differ, told by what the ledger keeps of each."""
    lines = Q.lines(spark, sf_dir)
    versions, t = _versions(spark), F.col("l_shipdate")
    first = versions.publish(lines.where(F.year(t) < 2001), "l_shipdate")
    other = (F.col("l_orderkey") % 50 == 0) & (F.month(t) == 3)
    turned = lines.withColumn("price", F.when(other, F.col("price") + 1).otherwise(F.col("price")))
    gone = (F.month(t) == 7) & (F.col("l_orderkey") % 9 == 0)
    second = versions.publish(turned.where((F.year(t) > 1995) & ~gone), "l_shipdate")
    return versions.changed(first, second)


@query(
    "fingerprint_by_month",
    f"WITH {Q.L}, m AS (SELECT {_MONTH} AS month, count(*) AS n, sum(CAST(concat('0x', substr(md5(concat("
    + ", ".join(
        Q.cell_sql(c)
        for c in ("CAST(l_orderkey AS VARCHAR)", "CAST(l_linenumber AS VARCHAR)", "l_linestatus", "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')")
    )
    + ")), 1, 15)) AS BIGINT)) AS h FROM l GROUP BY 1) "
    "SELECT month, n AS n_rows, CAST(h AS VARCHAR) AS h FROM m UNION ALL "
    "SELECT 'all', CAST(sum(n) AS BIGINT), concat(CAST(sum(n) AS VARCHAR), '-', CAST(sum(h) AS VARCHAR)) FROM m",
)
def fingerprint_by_month(spark, sf_dir):
    """What the ledger keeps of a version's months, and the whole fingerprint that they add up to."""
    names = ("l_orderkey", "l_linenumber", "l_linestatus", "l_shipdate")
    versions = _versions(spark)
    prints = versions.prints(versions.publish(Q.lines(spark, sf_dir).select(*names), "l_shipdate"))
    whole = merged_print(prints).select(F.lit("all").alias("month"), "n_rows", F.col("fingerprint").alias("h"))
    return prints.withColumn("h", F.col("h").cast("string")).unionByName(whole)


_SPANS = {"first": ("1995-01", "1995-06"), "year": ("1996-01", "1996-12"), "most": ("1995-01", "2000-12"), "none": ("1990-01", "1990-12")}


@query(
    "distinct_by_span",
    f"WITH {Q.L}, m AS (SELECT l_suppkey, {_MONTH} AS month FROM l), s(span, low, high) AS (VALUES "
    + ", ".join(f"('{k}', '{a}', '{b}')" for k, (a, b) in _SPANS.items())
    + ") SELECT span, count(month) AS n_rows, count(DISTINCT l_suppkey) AS n_exact, TRUE AS within_error "
    "FROM s LEFT JOIN m ON month BETWEEN low AND high GROUP BY span",
)
def distinct_by_span(spark, sf_dir):
    """Distinct entities of spans of months from stored sketches, beside the exact counts."""
    lines = Q.lines(spark, sf_dir)
    sketches = H.write_month_sketches(lines, scratch_path(spark, "sketches"), "l_suppkey", "l_shipdate")
    out = None
    month = F.date_format("l_shipdate", "yyyy-MM")
    exact = lines.agg(*[F.count_distinct(F.when(month.between(a, b), F.col("l_suppkey"))).alias(k) for k, (a, b) in _SPANS.items()])
    exact = exact.select(F.inline(F.array(*[F.struct(F.lit(k).alias("span"), F.col(k).alias("n_exact")) for k in _SPANS])))
    for k, (a, b) in _SPANS.items():
        found = H.distinct_entities(sketches, a, b).withColumn("span", F.lit(k))
        out = found if out is None else out.unionByName(found)
    near = F.abs(F.col("n_entities") - F.col("n_exact")) <= F.col("error") * F.col("n_exact")
    return out.join(exact, "span").select("span", "n_rows", "n_exact", near.alias("within_error"))


_PRINT = ["event_id", "micros", "user_id", "event_type", "value", "props"]


@query(
    "dataset_fingerprint",
    "SELECT count(*) AS n_rows, "
    + Q.fingerprint_sql(
        "CAST(event_id AS VARCHAR)", "CAST(epoch_us(ts) AS VARCHAR)", "CAST(user_id AS VARCHAR)",
        "event_type", "CAST(value AS VARCHAR)", "props",
    )
    + " AS fingerprint FROM events",
)
def dataset_fingerprint(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    micros = F.expr("CAST((unix_date(CAST(ts AS DATE)) * 86400L + hour(ts) * 3600 + minute(ts) * 60) * 1000000 + "
                    "extract(SECOND FROM ts) * 1000000 AS BIGINT)")  # fmt: skip
    return A.fingerprint(events.withColumn("micros", micros), _PRINT)


_LEDGER_EVENTS = (
    "SELECT concat('S', CAST(user_id % 12 AS STRING)) AS subject, event_type AS version, "
    "'state' AS kind, CAST(event_id % 3 AS STRING) AS key, props AS value, "
    "date_trunc('hour', ts) AS ts, event_id AS seq FROM events"
)


def _ledger_events(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.selectExpr(
        "concat('S', CAST(user_id % 12 AS STRING)) AS subject",
        "event_type AS version",
        "'state' AS kind",
        "CAST(event_id % 3 AS STRING) AS key",
        "props AS value",
        "date_trunc('hour', ts) AS ts",
        "event_id AS seq",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


_LATEST = (
    "SELECT subject, kind, key, version, value, ts FROM (SELECT *, row_number() OVER "
    "(PARTITION BY subject, kind, key ORDER BY ts DESC, seq DESC) AS rn FROM v) WHERE rn = 1"
)


@query("snapshot_ledger_latest", f"WITH v AS ({_LEDGER_EVENTS}) {_LATEST}")
def snapshot_ledger_latest(spark, sf_dir):
    ledger = J.Ledger(spark, scratch_path(spark, "ledger"))
    ledger.append_table(_ledger_events(spark, sf_dir))
    return J.current_state(ledger.events(), "state")


_ALIAS_EVENTS = (
    "SELECT concat('model-', CAST(l_suppkey AS STRING)) AS subject, "
    "CAST(l_orderkey AS STRING) AS version, CASE WHEN l_linestatus = 'O' THEN 'alias' ELSE 'tag' END AS kind, "
    "l_returnflag AS key, CAST(l_partkey AS STRING) AS value, l_shipdate AS ts, "
    "l_orderkey * 1000000 + l_partkey AS seq FROM lineitem"
)


@query("ledger_current_state", f"WITH v AS ({_ALIAS_EVENTS}) {_LATEST}")
def ledger_current_state(spark, sf_dir):
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").createOrReplaceTempView("__ledger_lines")
    events = spark.sql(_ALIAS_EVENTS.replace("FROM lineitem", "FROM __ledger_lines"))
    return J.current_state(events)


_AUDIT = (
    "SELECT '{b}' AS batch_id, '2024-02-01T12:00:00' AS prediction_timestamp, '{l}' AS particion, "
    "'pm25' AS model_name, '7' AS model_version, 'champion' AS model_alias, 'models/pm25/7' AS model_uri, "
    "round({p}, 6) AS prediccion_pm25, station, wd, CAST(hora AS INT) AS hora, "
    "CAST(dia_semana AS INT) AS dia_semana, CAST(mes AS INT) AS mes, temporada FROM s"
)


def _audit(spark, sf_dir, label, batch):
    scored = M.scored(spark, sf_dir, label).withColumnRenamed("candidate", PREDICTION)
    return K.audit_rows(scored, K.Trace(batch, label, "pm25", "7", "champion", "models/pm25/7", MOMENT))


def _rounded(rows):
    return rows.withColumn("prediccion_pm25", F.round("prediccion_pm25", 6))


@query(
    "audit_rows",
    f"WITH {Q.models_sql('test')} " + _AUDIT.format(b="test-1", l="test", p="candidate"),
)
def audit_rows(spark, sf_dir):
    return _rounded(_audit(spark, sf_dir, "test", "test-1"))


@query(
    "prediction_sink",
    f"WITH {Q.models_sql('test')} "
    + _AUDIT.format(b="test-1", l="test", p="candidate")
    + " UNION ALL "
    + _AUDIT.format(b="test-2", l="test", p="candidate"),
)
def prediction_sink(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    for batch in ("test-1", "test-2", "test-1"):  # the repeat replaces its own rows
        K.write_predictions(_audit(spark, sf_dir, "test", batch), path)
    return _rounded(K.read_predictions(spark, path))


@query(
    "metrics_long",
    f"WITH {Q.models_sql('test')}, {Q.STACKED}, w AS (SELECT model, avg(abs(pm25 - prediction)) AS mae, "
    "sqrt(avg((pm25 - prediction) * (pm25 - prediction))) AS rmse, 1 - sum((pm25 - prediction) * "
    "(pm25 - prediction)) / (var_pop(pm25) * count(*)) AS r2 FROM m GROUP BY model), "
    "u AS (SELECT model, 'mae' AS metric, mae AS value FROM w UNION ALL SELECT model, 'rmse', rmse FROM w "
    "UNION ALL SELECT model, 'r2', r2 FROM w) SELECT 'run-1' AS run_id, 'run-0' AS parent_run_id, model, "
    "'test' AS split, metric, round(value, 6) AS value FROM u",
)
def metrics_long_q(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    rows = M.stacked(spark, sf_dir)
    wide = global_metrics(rows, ["model"]).withColumn("split", F.lit("test"))
    K.append_metrics(metrics_long(wide, ["model", "split"], ["mae", "rmse", "r2"]), path, "run-1", "run-0")
    return spark.read.parquet(path).withColumn("value", F.round("value", 6))


@query(
    "run_records",
    f"WITH {Q.models_sql('test')}, z AS (SELECT station, avg(abs(pm25 - candidate)) AS mae, count(*) AS n FROM s GROUP BY station) "
    "SELECT 'run-1' AS run_id, 'entity' AS kind, station AS name, round(mae, 6) AS value, n FROM z UNION ALL "
    "SELECT 'run-1', 'param', 'worst', round(max(mae), 6), NULL FROM z",
)
def run_records(spark, sf_dir):
    """What a run leaves behind, read back: the error of every entity, and a parameter."""
    path = scratch_path(spark, "runs")
    scored = M.scored(spark, sf_dir, "test").withColumnRenamed("candidate", PREDICTION).withColumn("split", F.lit("test"))
    total, entities = measure_entities(scored, "split", Q.EVENTS)
    K.append_entities(entities.withColumn("model", F.lit("candidate")), f"{path}/entities", "run-1", Q.EVENTS)
    K.append_params(spark, f"{path}/params", "run-1", {"worst": total.first()["worst_entity_mae"]})
    kept = spark.read.parquet(f"{path}/entities").select(
        "run_id", F.lit("entity").alias("kind"), F.col("entity").alias("name"), F.col("mae").alias("value"), "n"
    )
    params = spark.read.parquet(f"{path}/params").select(
        "run_id", F.lit("param").alias("kind"), F.col("param").alias("name"), F.col("value").cast("double").alias("value")
    )
    return kept.unionByName(params, allowMissingColumns=True).withColumn("value", F.round("value", 6))


# --- projections and predicates -----------------------------------------------

_PARTS = {
    "event_id": "event_id",
    "y": "CAST(2013 + event_id % 5 AS INT)",
    "m": "CAST(1 + event_id % 13 AS INT)",
    "d": "CAST(1 + user_id % 31 AS INT)",
    "h": "CAST(event_id % 24 AS INT)",
}


@query(
    "compose_timestamp",
    "WITH p AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _PARTS.items()) + " FROM events) "
    "SELECT event_id, y, m, d, h, CAST(TRY_CAST(concat(y, '-', lpad(CAST(m AS VARCHAR), 2, '0'), '-', "
    "lpad(CAST(d AS VARCHAR), 2, '0')) AS DATE) AS TIMESTAMP) + h * INTERVAL 1 HOUR AS datetime FROM p",
)
def compose_timestamp(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    parts = events.selectExpr(*[f"{e} AS {c}" for c, e in _PARTS.items()])
    return parts.withColumn("datetime", C.event_time("y", "m", "d", "h"))


@query(
    "partition_slice",
    f"WITH {Q.R} SELECT event_id, datetime, pm25 FROM r WHERE {Q.slice_sql('valid')}",
)
def partition_slice(spark, sf_dir):
    part = slice_label(Q.readings(spark, sf_dir), "valid", Q.RANGES)
    return part.select("event_id", "datetime", "pm25")


@query(
    "partition_label",
    f"WITH {Q.L}, p AS (SELECT l_orderkey, l_linenumber, l_shipdate, "
    f"{Q.label_sql(Q.LINE_SPEC.ranges, 'l_shipdate')} AS particion FROM l) "
    "SELECT * FROM p WHERE particion IS NOT NULL",
)
def partition_label(spark, sf_dir):
    lines = Q.lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_shipdate")
    return label_rows(lines, Q.LINE_SPEC.ranges, "l_shipdate")


_TEXT = "CASE WHEN event_id % 10 = 0 THEN concat('n/a', props) WHEN event_id % 17 = 0 THEN NULL ELSE CAST(value AS STRING) END"


@query(
    "coerce_numeric",
    f"WITH t AS (SELECT event_id, user_id % 12 AS entity, {_TEXT} AS txt FROM events) SELECT entity, "
    "count(*) AS n_rows, count(TRY_CAST(txt AS DOUBLE)) AS n_numbers, "
    "count(*) FILTER (txt IS NOT NULL AND TRY_CAST(txt AS DOUBLE) IS NULL) AS n_lost, "
    "round(avg(TRY_CAST(txt AS DOUBLE)), 6) AS mean FROM t GROUP BY entity",
)
def coerce_numeric(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    texts = events.selectExpr("event_id", "user_id % 12 AS entity", f"{_TEXT} AS txt")
    coerced = V.coerce_numeric(texts.withColumn("num", F.col("txt")), ["num"])
    return coerced.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("num").alias("n_numbers"),
        F.count_if(V.lost_in_cast(F.col("txt"))).alias("n_lost"),
        F.round(F.avg("num"), 6).alias("mean"),
    )


@query(
    "feature_record",
    f"WITH {Q.R}, {Q.prepared_sql('valid')} SELECT event_id, station, wd, temporada, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in S.MEASURES)
    + ", CAST(hora AS VARCHAR) AS hora, CAST(dia_semana AS VARCHAR) AS dia_semana, CAST(mes AS VARCHAR) AS mes, "
    "CAST(16 AS INT) AS n_fields FROM p_valid",
)
def feature_record(spark, sf_dir):
    rows = M.prepared(spark, sf_dir, "valid")
    records = rows.select("event_id", V.feature_record(Q.EVENTS).alias("record"))
    field = lambda c: F.get_json_object("record", f"$.{c}")
    return records.select(
        "event_id",
        *[field(c).alias(c) for c in ("station", "wd", "temporada")],
        *[F.round(field(c).cast("double"), 6).alias(c) for c in S.MEASURES],
        *[field(c).alias(c) for c in ("hora", "dia_semana", "mes")],
        F.size(F.json_object_keys("record")).alias("n_fields"),
    )


_MESSY = "CASE WHEN event_id % 3 = 0 THEN lower(' ' || wd || ' ') WHEN event_id % 7 = 0 THEN 'zz' ELSE wd END"


@query(
    "normalize_sector",
    f"WITH {Q.R}, t AS (SELECT event_id, {_MESSY} AS messy FROM r) SELECT event_id, messy, "
    "CASE WHEN upper(trim(messy)) IN (" + ", ".join(f"'{s}'" for s in S.SECTORS) + ") "
    "THEN upper(trim(messy)) END AS wd FROM t",
)
def normalize_sector(spark, sf_dir):
    messy = Q.readings(spark, sf_dir).selectExpr("event_id", f"{_MESSY} AS messy")
    return messy.withColumn("wd", V.normalize_sector(F.col("messy")))


@query(
    "feature_select",
    f"WITH {Q.R}, {Q.prepared_sql('test')} SELECT temporada, station, wd, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in S.MEASURES)
    + ", hora, dia_semana, mes, pm25 FROM p_test",
)
def feature_select(spark, sf_dir):
    rows = select_features(M.prepared(spark, sf_dir, "test"), Q.EVENTS)
    return rows.withColumns({c: F.round(c, 6) for c in S.MEASURES})


@query(
    "calendar_features",
    f"WITH {Q.L} SELECT l_orderkey, l_linenumber, l_shipdate, coalesce(flag, 'desconocido') AS flag, "
    f"l_linestatus, {Q.calendar_sql('l_shipdate')} FROM l",
)
def calendar_features(spark, sf_dir):
    built = build_features(Q.lines(spark, sf_dir), Q.LINE_SPEC)
    return built.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "flag", "l_linestatus",
        "temporada", "hora", "dia_semana", "mes",
    )


@query(
    "hour_band",
    f"WITH {Q.R} SELECT event_id, CAST(hour(datetime) AS SMALLINT) AS hora, {Q.band_sql('hour(datetime)')} AS band FROM r",
)
def hour_band(spark, sf_dir):
    rows = Q.readings(spark, sf_dir).select("event_id", C.hour(F.col("datetime")).alias("hora"))
    return rows.withColumn("band", C.hour_band(F.col("hora")))


# --- incoming JSON -------------------------------------------------------------

def json_records(df):
    """Sound readings as JSON text, some with an unknown field, some cut short.

    Missing measures are left out of the record, as a sender would.
    """
    values = {
        "datetime": F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss"),
        "station": F.col("station"),
        "wd": F.when(F.col("event_id") % 4 == 0, F.lower("wd")).otherwise(F.col("wd")),
        **{c: F.col(c) for c in S.MEASURES},
    }
    values["PM10"] = F.when(F.col("event_id") % 19 == 0, F.lit(1001.0)).otherwise(F.col("PM10"))
    fields = [v.alias(c) for c, v in values.items()]
    extra = F.when(F.col("event_id") % 23 == 0, F.lit("x")).alias("color")
    text = F.to_json(F.struct(*fields, extra))
    cut = F.when(F.col("event_id") % 91 == 0, F.lit("{\"station\": ")).otherwise(text)
    return df.select("event_id", "datetime", cut.alias("record"))


VERDICT_SQL = (
    "CASE WHEN event_id % 91 = 0 THEN 'malformed' WHEN event_id % 23 = 0 THEN 'unknown:color' "
    "WHEN wd IS NULL THEN 'bad:wd' WHEN event_id % 19 <> 0 AND PM10 IS NULL THEN 'bad:PM10' "
    + " ".join(f"WHEN {c} IS NULL THEN 'bad:{c}'" for c in S.MEASURES if c != "PM10")
    + " WHEN event_id % 19 = 0 THEN 'range:PM10' END"
)


@query(
    "quarantine_split",
    f"WITH {Q.R}, t AS (SELECT *, {VERDICT_SQL} AS first_reason FROM r) SELECT event_id, first_reason IS NULL AS valid, "
    "CASE WHEN first_reason IS NULL THEN wd END AS wd, CASE WHEN first_reason IS NULL THEN CO END AS co, first_reason FROM t",
)
def quarantine_split(spark, sf_dir):
    records = json_records(Q.readings(spark, sf_dir)).select("event_id", "record")
    checked = check_incoming(records, "record", Q.EVENTS)
    valid, quarantined = store_incoming(checked, scratch_path(spark, "incoming"))
    good = valid.select(
        "event_id", F.lit(True).alias("valid"), "wd", F.col("CO").alias("co"), F.lit(None).cast("string").alias("first_reason")
    )
    bad = quarantined.select(
        "event_id",
        F.lit(False).alias("valid"),
        F.lit(None).cast("string").alias("wd"),
        F.lit(None).cast("double").alias("co"),
        F.col("reasons")[0].alias("first_reason"),
    )
    return good.unionByName(bad)


@query(
    "baseline_predict",
    f"WITH {Q.R}, {Q.prepared_sql('train')}, {Q.prepared_sql('test')} SELECT event_id, pm25, "
    "round((SELECT avg(pm25) FROM p_train), 6) AS prediction FROM p_test",
)
def baseline_predict(spark, sf_dir):
    model = Baseline.fit(M.prepared(spark, sf_dir, "train"))
    rows = model.transform(M.prepared(spark, sf_dir, "test"))
    return rows.select("event_id", "pm25", F.round(PREDICTION, 6).alias("prediction"))
