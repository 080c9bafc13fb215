"""Streams of several micro-batches: late rows, counts by query, a new champion."""

import datetime as dt
import json

from pyspark.sql import functions as F

from brisa.plans.serving import serve_champion
from brisa.sources.ledger import Ledger, RegistryUnavailable
from brisa.streaming import jobs as T
from tests.test_io import GOOD


class Constant:
    def __init__(self, value):
        self.value = value

    def transform(self, df):
        return df.withColumn("prediction", F.lit(self.value))


def put(spark, folder, name, hours):
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for k, h in hours]
    spark.createDataFrame(rows, "k string, t timestamp").coalesce(1).write.parquet(f"{folder}/{name}")


def test_late_and_repeated_rows_are_counted(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, folder, 0, [("a", 0), ("a", 0), ("b", 5), ("a", 5)])
    put(spark, folder, 1, [("a", 5), ("a", 4), ("b", 30)])  # one repeat of the file before, one in time
    put(spark, folder, 2, [("a", 1), ("b", 27), ("b", 30), ("c", 31)])  # late is what lies before the watermark of the batch before: one, and one repeat
    told = T.Arrivals()
    spark.streams.addListener(told)
    try:
        stream = T.files_stream(spark, folder, "k string, t timestamp")
        query = T.append_stream(T.unique_readings(stream, ["k", "t"], "t"), out)
        T.run_to_end(query)
        assert told.totals(query) == (11, 1, 3)
        batches = told.batches[str(query.id)]
        assert [batches[i] for i in range(3)] == [(4, 0, 1), (3, 0, 1), (4, 1, 1)]
    finally:
        spark.streams.removeListener(told)
    kept = {(r.k, (r.t.day - 1) * 24 + r.t.hour) for r in spark.read.parquet(f"{out}/data").collect()}
    assert kept == {("a", 0), ("b", 5), ("a", 5), ("a", 4), ("b", 27), ("b", 30), ("c", 31)}


def counted(spark, folder, out):
    stream = spark.readStream.schema("k string, t timestamp").option("recursiveFileLookup", True).parquet(folder)
    T.run_to_end(T.update_stream(T.outcome_counts(stream, F.col("k"), "t"), out))


def test_counts_of_a_new_checkpoint_replace_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    put(spark, str(tmp_path / "one"), 0, [("a", 1), ("a", 2)])
    counted(spark, str(tmp_path / "one"), out)
    (tmp_path / "out" / "checkpoint").rename(tmp_path / "old")
    put(spark, str(tmp_path / "two"), 0, [("a", 3), ("b", 3)])
    counted(spark, str(tmp_path / "two"), out)
    got = T.latest_counts(spark.read.parquet(f"{out}/counts")).collect()
    assert sorted((r.outcome, r.n) for r in got) == [("a", 3), ("b", 1)]


class Flaky(Ledger):
    lost = False

    def version_of(self, model, alias):
        if self.lost:
            raise RegistryUnavailable("gone")
        return super().version_of(model, alias)


def test_a_new_champion_scores_from_the_next_batch_on(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    ledger = Flaky(spark, str(tmp_path / "ledger"))
    for version in ("1", "2"):
        ledger.register("m", version, version)
    ledger.set_alias("m", "champion", "1")
    loads = []

    def load(uri):
        loads.append(uri)
        return Constant(float(uri))

    def send(name):
        (source / name).write_text(json.dumps({"record": json.dumps(GOOD)}))
        running.processAllAvailable()

    stream = spark.readStream.schema("record string").option("maxFilesPerTrigger", 1).json(str(source))
    running = serve_champion(stream, "record", ledger, "m", out, load=load, trigger={"processingTime": "0 seconds"})
    try:
        send("a.json")
        send("b.json")
        ledger.set_alias("m", "champion", "2")
        send("c.json")
        ledger.lost = True  # the last champion goes on
        send("d.json")
    finally:
        running.stop()
    rows = spark.read.parquet(f"{out}/scored").collect()
    assert sorted((r.model_version, r.prediction) for r in rows) == [("1", 1.0)] * 2 + [("2", 2.0)] * 2
    assert loads == ["1", "2"]
