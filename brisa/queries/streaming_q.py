"""Queries over the streaming jobs, each run to the end of the given table."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.operators.forest import Baseline
from brisa.operators.metrics import PREDICTION
from brisa.plans.serving import serve_champion
from brisa.queries import models as M
from brisa.queries import tables as Q
from brisa.queries.registry import query
from brisa.queries.sources_q import VERDICT_SQL, json_records
from brisa.session import scratch_path
from brisa.sources.incoming import check_incoming
from brisa.sources.ledger import Ledger
from brisa.streaming import jobs as T


def _events_stream(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _readings_stream(spark, sf_dir):
    return Q._select(_events_stream(spark, sf_dir), Q.SOUND)


@query(
    "stream_score",
    f"WITH {Q.R}, {Q.prepared_sql('train')}, t AS (SELECT *, {VERDICT_SQL} AS reason FROM r) "
    "SELECT event_id, station, upper(wd) AS wd, CAST(hour(datetime) AS SMALLINT) AS hora, "
    "round((SELECT avg(pm25) FROM p_train), 6) AS prediction, 'ok' AS outcome FROM t WHERE reason IS NULL UNION ALL "
    "SELECT event_id, NULL, NULL, NULL, NULL, 'rechazada' FROM t WHERE reason IS NOT NULL",
)
def stream_score(spark, sf_dir):
    model = Baseline.fit(M.prepared(spark, sf_dir, "train"))
    out = scratch_path(spark, "scored")
    records = json_records(_readings_stream(spark, sf_dir)).select("event_id", "record")
    T.run_to_end(T.score_stream(records, "record", model, "1", out, Q.EVENTS, keep=["event_id"]))
    scored = spark.read.parquet(f"{out}/scored").select(
        "event_id", "station", "wd", "hora", F.round(PREDICTION, 6).alias("prediction"), F.lit(T.OK).alias("outcome")
    )
    rejected = spark.read.parquet(f"{out}/quarantine").select("event_id", F.lit(T.REJECTED).alias("outcome"))
    return scored.unionByName(rejected, allowMissingColumns=True)


@query(
    "stream_dedup",
    "SELECT DISTINCT user_id AS entity, date_trunc('hour', ts) AS t FROM events",
)
def stream_dedup(spark, sf_dir):
    stream = _events_stream(spark, sf_dir).select(
        F.col("user_id").alias("entity"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("t")
    )
    out = scratch_path(spark, "unique")
    unique = T.unique_readings(stream, ["entity", "t"], "t")
    T.run_to_end(T.append_stream(unique, out))
    return spark.read.parquet(f"{out}/data").withColumn("t", F.col("t").cast("timestamp_ntz"))


@query(
    "stream_outcome_counts",
    f"WITH {Q.R}, t AS (SELECT datetime, CASE WHEN {VERDICT_SQL} IS NULL THEN 'ok' ELSE 'rechazada' END AS outcome FROM r) "
    "SELECT date_trunc('day', datetime) AS day, outcome, count(*) AS n FROM t GROUP BY 1, 2",
)
def stream_outcome_counts(spark, sf_dir):
    records = json_records(_readings_stream(spark, sf_dir)).withColumn(
        "arrived", F.col("datetime").cast("timestamp")
    )
    checked = check_incoming(records.drop("datetime"), "record", Q.EVENTS)
    outcome = F.when(F.size("reasons") == 0, F.lit(T.OK)).otherwise(F.lit(T.REJECTED))
    out = scratch_path(spark, "counts")
    T.run_to_end(T.update_stream(T.outcome_counts(checked, outcome, "arrived"), out))
    latest = T.latest_counts(spark.read.parquet(f"{out}/counts"))
    return latest.withColumn("day", F.col("day").cast("timestamp_ntz"))


_HOUR = "date_trunc('hour', ts)"
_THIRD = "CASE WHEN day(ts) <= 10 THEN 1 WHEN day(ts) <= 20 THEN 2 ELSE 3 END"
#: Repeats come one file later, of the last hours before it; late rows come at the end.
_REPEATED = "day(ts) = 10 AND hour(ts) >= 22"
_LATE = "day(ts) <= 5 AND event_id % 7 = 0"


@query(
    "stream_late",
    f"WITH k AS (SELECT user_id, {_HOUR} AS t, count(*) + count(*) FILTER ({_REPEATED}) AS n FROM events GROUP BY 1, 2) "
    "SELECT 'kept' AS outcome, count(*) AS n FROM k UNION ALL SELECT 'repeated', CAST(sum(n) - count(*) AS BIGINT) FROM k "
    f"UNION ALL SELECT 'late', count(*) FILTER ({_LATE}) FROM events",
)
def stream_late(spark, sf_dir):
    """Readings in four files, a micro-batch each: in order, then with some of the first file's
    last hours again, in order, and at last some of the first days, which are late by then."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = events.select(
        "event_id", F.col("user_id").alias("entity"), F.col("ts").cast("timestamp").alias("ts"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("t"),
    )
    folder, out = scratch_path(spark, "arriving"), scratch_path(spark, "unique")
    third = F.expr(_THIRD)
    files = [rows.where(third == 1), rows.where(third == 2).unionByName(rows.where(_REPEATED)), rows.where(third == 3)]
    for i, part in enumerate([*files, rows.where(_LATE)]):
        part.coalesce(1).write.parquet(f"{folder}/{i}")
    told = T.Arrivals()
    spark.streams.addListener(told)
    try:
        stream = T.files_stream(spark, folder, rows.schema)
        running = T.append_stream(T.unique_readings(stream, ["entity", "t"], "t"), out)
        T.run_to_end(running)
        _, late, repeated = told.totals(running)
    finally:
        spark.streams.removeListener(told)
    kept = spark.read.parquet(f"{out}/data").agg(F.count("*").alias("n")).select(F.lit("kept").alias("outcome"), "n")
    dropped = spark.createDataFrame([("repeated", repeated), ("late", late)], "outcome string, n long")
    return kept.unionByName(dropped)


_SECOND = "day(datetime) > 15"


@query(
    "stream_champion_change",
    f"WITH {Q.R}, {Q.prepared_sql('train')}, e AS (SELECT station, avg(pm25) AS m FROM p_train GROUP BY station), "
    f"t AS (SELECT *, {VERDICT_SQL} AS reason FROM r) SELECT event_id, CASE WHEN {_SECOND} THEN '2' ELSE '1' END AS model_version, "
    f"round(CASE WHEN {_SECOND} THEN e.m ELSE (SELECT avg(pm25) FROM p_train) END, 6) AS prediction "
    "FROM t JOIN e USING (station) WHERE reason IS NULL",
)
def stream_champion_change(spark, sf_dir):
    """The champion changes while the stream runs, between one file and the next."""
    models, ledger = M.fitted(spark, sf_dir), Ledger(spark, scratch_path(spark, "registry"))
    for version, name in (("1", "champion"), ("2", "candidate")):
        ledger.register("pm25", version, name)
    ledger.set_alias("pm25", "champion", "1")
    folder, out = scratch_path(spark, "arriving"), scratch_path(spark, "scored")
    rows = json_records(Q.readings(spark, sf_dir)).withColumn("later", F.expr(_SECOND))
    parts = [rows.where("NOT later"), rows.where("later")]
    records = [p.select("event_id", "record") for p in parts]
    records[0].coalesce(1).write.parquet(f"{folder}/0")
    stream = T.files_stream(spark, folder, records[0].schema)
    running = serve_champion(
        stream, "record", ledger, "pm25", out, Q.EVENTS, load=models.get, keep=["event_id"], trigger={"processingTime": "0 seconds"}
    )
    try:
        running.processAllAvailable()
        ledger.set_alias("pm25", "champion", "2")
        records[1].coalesce(1).write.parquet(f"{folder}/1")
        running.processAllAvailable()
    finally:
        running.stop()
    scored = spark.read.parquet(f"{out}/scored")
    return scored.select("event_id", "model_version", F.round(PREDICTION, 6).alias("prediction"))
