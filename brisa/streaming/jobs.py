"""Structured Streaming: score arriving readings, drop repeats, count outcomes."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from brisa import spec as S
from brisa.operators.features import build_features
from brisa.operators.metrics import PREDICTION
from brisa.sources.incoming import check_incoming, split_incoming

OK, REJECTED = "ok", "rechazada"


class NoModel(RuntimeError):
    """No champion is set; readings are not scored with anything else."""


def score_stream(
    records: DataFrame,
    text: str,
    model,
    version: str,
    out: str,
    spec: S.ReadingSpec = S.READINGS,
    keep: list[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """``score_stream_with`` one model and version for as long as the query runs."""
    if model is None:
        raise NoModel("no champion is set")
    return score_stream_with(records, text, lambda: (version, model), out, spec, keep, trigger)


def score_stream_with(
    records: DataFrame,
    text: str,
    resolve: Callable[[], tuple[str, object]],
    out: str,
    spec: S.ReadingSpec = S.READINGS,
    keep: list[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Check, score and store JSON readings as they arrive.

    Valid rows go to ``out/scored`` with the model version, others to
    ``out/quarantine`` with their reasons. ``resolve`` is asked for (version, model) once
    for each micro-batch, so all of its rows have the same one. Every micro-batch owns one
    folder per sink and replaces it when it is retried, so a restart repeats nothing.
    """
    checked = check_incoming(records, text, spec)

    def store(batch: DataFrame, epoch: int) -> None:
        own = f"query={query_id(batch.sparkSession, out)}/epoch={epoch}"
        version, model = resolve()
        batch = batch.persist()
        try:
            valid, quarantined = split_incoming(batch)
            scored = model.transform(build_features(valid, spec)).withColumn(
                "model_version", F.lit(version)
            )
            kept = [*keep, *spec.features, PREDICTION, "model_version"]
            scored.select(*kept).write.mode("overwrite").parquet(f"{out}/scored/{own}")
            quarantined.select(*keep, text, "reasons").write.mode("overwrite").parquet(
                f"{out}/quarantine/{own}"
            )
        finally:
            batch.unpersist()

    writer = checked.writeStream.foreachBatch(store).option("checkpointLocation", f"{out}/checkpoint")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def query_id(spark, out: str) -> str:
    """Id of the query whose checkpoint lies in ``out``: a new checkpoint, whose batches
    are numbered from 0 again, has another one and replaces nothing that is stored."""
    line = spark.read.text(f"{out}/checkpoint/metadata").first()[0]
    return json.loads(line)["id"]


def unique_readings(
    stream: DataFrame, key: list[str], time: str = S.TIME, delay: str = "2 hours"
) -> DataFrame:
    """First arrival of every key; state is kept for ``delay`` of event time only."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([*key])


def append_stream(
    stream: DataFrame, out: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append-only Parquet sink with exactly-once file commits."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{out}/data")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def outcome_counts(
    stream: DataFrame, outcome: Column, time: str, width: str = "1 day", delay: str = "2 days"
) -> DataFrame:
    """Rows per tumbling window and outcome; closed windows leave the state."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(F.col(time), width).alias("w"), outcome.alias("outcome"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("day"), "outcome", "n")
    )


def update_stream(
    counts: DataFrame, out: str, trigger: dict | None = None
) -> StreamingQuery:
    """Store the counts every micro-batch changed, one folder per query and batch."""

    def store(batch: DataFrame, epoch: int) -> None:
        own = f"query={query_id(batch.sparkSession, out)}/epoch={epoch}"
        batch.write.mode("overwrite").parquet(f"{out}/counts/{own}")

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_counts(stored: DataFrame) -> DataFrame:
    """The newest count of every window and outcome, added up over queries: one that starts
    with a new checkpoint counts what it reads from 0 on."""
    newest = stored.groupBy("query", "day", "outcome").agg(F.max_by("n", "epoch").alias("n"))
    return newest.groupBy("day", "outcome").agg(F.sum("n").alias("n"))


def files_stream(spark, folder: str, schema, per_batch: int = 1) -> DataFrame:
    """Parquet files below a folder as they come, the oldest first, so many a micro-batch."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    return reader.option("maxFilesPerTrigger", per_batch).parquet(folder)


class Arrivals(StreamingQueryListener):
    """Rows by what became of them in a query's stateful operators, batch by batch: read,
    dropped as late by the watermark, dropped as repeats."""

    def __init__(self):
        self.batches: dict[str, dict[int, tuple[int, int, int]]] = {}
        self._ended: dict[str, threading.Event] = {}

    def _end(self, query: str) -> threading.Event:
        return self._ended.setdefault(query, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.id))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        repeats = sum(int(o.customMetrics.get("numDroppedDuplicateRows", 0)) for o in p.stateOperators)
        seen = self.batches.setdefault(str(p.id), {})
        # A batch may be told of again, with nothing new to say.
        if p.numInputRows or late or repeats or p.batchId not in seen:
            seen[p.batchId] = (p.numInputRows, late, repeats)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.id)).set()

    def totals(self, query: StreamingQuery, wait: float = 60.0) -> tuple[int, int, int]:
        """(read, late, repeated) rows of a query that has ended; waits for its last report."""
        if not self._end(str(query.id)).wait(wait):
            raise TimeoutError(f"no last report of query {query.id}")
        return tuple(sum(x) for x in zip(*self.batches.get(str(query.id), {0: (0, 0, 0)}).values(), strict=True))


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
