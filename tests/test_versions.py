"""Raw files with unsound rows, versions, month prints, buckets, sketches."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa import spec as S
from brisa.operators import contract as K
from brisa.sources import bucketed as B
from brisa.sources import readings as A
from brisa.sources import sketches as H
from brisa.sources import versions as V
from brisa.sources.ledger import Ledger

SCHEMA = T.StructType(
    [T.StructField("No", T.IntegerType()), T.StructField("PM2.5", T.DoubleType()), T.StructField("PM10", T.DoubleType())]
    + [T.StructField("station", T.StringType())]
)


def put(folder, name, text, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    (folder / name).write_text(text, encoding=encoding)


@pytest.fixture
def raw(tmp_path):
    put(tmp_path / "x", "a.csv", 'No,PM2.5,PM10,station\n1,1.5,NA,s\n2,bad,3,s\n3,4\n4,12,5,3,s\n5,"1,5",bad,s\n\n6,,7,"a,b"\n')
    put(tmp_path / "y", "b.csv", '﻿"station","PM10","No","PM2.5"\nt,8,7.5,9\nt,1,8,NA\nt,2,9,1,0\n')
    return tmp_path


def test_unsound_rows_are_set_apart(spark, raw):
    sound = A.scan_csv(spark, str(raw), SCHEMA, "*.csv").collect()
    assert sorted(map(tuple, sound), key=str) == [
        (1, 1.5, None, "s"), (6, None, 7.0, "a,b"), (8, None, 1.0, "t"),
    ]
    rejected = A.scan_csv_rejects(spark, str(raw), SCHEMA, "*.csv").collect()
    assert sorted((r.file.rsplit("/")[-1], r.line, r.reason) for r in rejected) == [
        ("a.csv", "2,bad,3,s", "value:PM2.5"),
        ("a.csv", "3,4", "short"),
        ("a.csv", "4,12,5,3,s", "long"),
        ("a.csv", '5,"1,5",bad,s', "value:PM2.5,PM10"),
        ("b.csv", "t,2,9,1,0", "long"),
        ("b.csv", "t,8,7.5,9", "value:No"),
    ]


def test_one_column_of_the_sound_rows(spark, raw):
    """Reading fewer columns does not make unsound rows sound."""
    table = A.scan_csv(spark, str(raw), SCHEMA, "*.csv")
    assert sorted(r.No for r in table.select("No").collect()) == [1, 6, 8]
    assert table.count() == 3


def test_ingest_reads_once(spark, raw, tmp_path):
    sound, rejected = A.ingest_csv(spark, str(raw), str(tmp_path / "out"), SCHEMA, "*.csv")
    assert sound.columns == SCHEMA.names and sound.count() == 3 and rejected.count() == 6


@pytest.mark.parametrize("header", ["No,PM2.5,station", "No,PM2.5,PM10,station,more", "No,PM2.5,PM10,other", " "])
def test_every_header_is_checked(spark, raw, header):
    put(raw / "z", "c.csv", header + "\n1,2,3\n")
    put(raw / "z", "empty.csv", "")
    with pytest.raises(S.MissingColumns, match="c.csv"):
        A.scan_csv(spark, str(raw), SCHEMA, "*.csv")


def test_compressed_files_and_no_files(spark, raw):
    import gzip

    (raw / "x" / "d.csv.gz").write_bytes(gzip.compress(b"No,PM2.5,PM10,station\n20,1,2,z\n"))
    assert {r.No for r in A.scan_csv(spark, str(raw), SCHEMA, "*.csv*").collect()} == {1, 6, 8, 20}
    with pytest.raises(FileNotFoundError):
        A.scan_csv(spark, str(raw), SCHEMA, "*.tsv")


def rows(spark, months, price=1.0, n=4):
    data = [(i, m, f"e{i % 3}", price) for m in months for i in range(n)]
    df = spark.createDataFrame(data, "id int, m string, station string, price double")
    return df.select("id", "station", "price", F.to_timestamp_ntz(F.concat("m", F.lit("-05 00:00:00"))).alias("datetime"))


@pytest.fixture
def versions(spark, tmp_path):
    return V.Versions(spark, str(tmp_path / "data"), Ledger(spark, str(tmp_path / "ledger")), "air")


def test_failed_write_leaves_the_last_version(spark, versions):
    assert versions.read() is None and versions.version() is None
    assert versions.publish(rows(spark, ["2024-01"])) == "1"
    assert versions.publish(rows(spark, ["2024-01", "2024-02"]), facts={"license": "open"}) == "2"
    broken = rows(spark, ["2024-01"]).withColumn("price", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        versions.publish(broken)
    assert versions.version() == "2" and versions.read().count() == 8
    told = versions.provenance("2")
    assert told["license"] == "open" and told["fingerprint"].startswith("8-")
    own = versions.read().drop("part_month")
    assert A.fingerprint(own).first().fingerprint == told["fingerprint"]
    assert V.merged_print(versions.prints("2")).first().fingerprint == told["fingerprint"]


def test_readers_keep_their_version_and_roll_back(spark, versions):
    versions.publish(rows(spark, ["2024-01"]))
    held = versions.read()
    versions.publish(rows(spark, ["2024-03"], n=9))
    assert held.count() == 4 and versions.read().count() == 9
    versions.roll_back("1")
    assert versions.version() == "1" and versions.read().count() == 4
    assert versions.publish(rows(spark, ["2024-04"])) == "3"
    with pytest.raises(KeyError):
        versions.roll_back("17")


def test_changed_months(spark, versions):
    a = versions.publish(rows(spark, ["2024-01", "2024-02", "2024-03"]))
    new = rows(spark, ["2024-01", "2024-04"]).unionByName(rows(spark, ["2024-03"], price=2.0))
    b = versions.publish(new)
    found = {(r.month, r.status, r.n_before, r.n_after) for r in versions.changed(a, b).collect()}
    assert found == {("2024-02", "removed", 4, None), ("2024-03", "changed", 4, 4), ("2024-04", "added", None, 4)}
    assert versions.changed(a, a).count() == 0


def test_only_months_written_again_are_read(spark, tmp_path):
    path = str(tmp_path / "snap")
    A.write_snapshot(rows(spark, ["2024-01", "2024-02", "2024-03"]), path)
    first, read = V.refreshed_prints(spark, path, None)
    assert read == ["2024-01", "2024-02", "2024-03"]
    kept = spark.createDataFrame(first.collect(), first.schema)
    again, read = V.refreshed_prints(spark, path, kept)
    assert read == [] and sorted(again.collect()) == sorted(kept.collect())
    time.sleep(0.01)
    month = rows(spark, ["2024-02"], price=5.0).withColumn("part_month", F.lit("2024-02"))
    month.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part_month").parquet(path)
    now, read = V.refreshed_prints(spark, path, kept)
    assert read == ["2024-02"]
    assert [(r.month, r.status) for r in V.changed_months(kept, now).collect()] == [("2024-02", "changed")]
    whole = V.merged_print(now.select("month", "n_rows", "h")).first().fingerprint
    assert whole == A.fingerprint(spark.read.parquet(path).drop("part_month")).first().fingerprint


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


@pytest.mark.parametrize("by", [["station"], ["station", "m"]])
def test_work_per_key_of_a_bucketed_snapshot_exchanges_nothing(spark, tmp_path, by):
    df = rows(spark, ["2024-01", "2024-02"], n=60).withColumn("m", F.date_format("datetime", "yyyy-MM"))
    path = str(tmp_path / "b")
    for table in (B.write_bucketed(df, path, by, [*by, "datetime"], 4), B.open_bucketed(spark, path)):
        assert table.count() == 120
        key = K.unique_key(("station", "datetime") if len(by) == 1 else ("station", "m", "datetime"))
        report = K.report(table, [key])
        assert exchanges(report)[0] == 0
        assert report.first().violations == 120 - 6
        assert exchanges(K.report(df, [key]))[0] > 0
        per_key = table.groupBy(*by).agg(F.avg("price"))
        assert exchanges(per_key)[0] == 0
        both = per_key.join(table.groupBy(*by).agg(F.max("id")), by)
        assert exchanges(both.hint("merge"))[0] == 0


def test_distinct_sketches_merge(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 7_000).cast("string").alias("station"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, CAST(id % 6 AS INT))").alias("datetime"),
    )
    sketches = H.month_sketches(df)
    one = H.distinct_entities(sketches, "2024-01", "2024-06").first()
    assert one.n_rows == 20_000 and abs(one.n_entities - 7_000) <= one.error * 7_000
    part = H.distinct_entities(sketches, "2024-02", "2024-03").first()
    exact = df.where(F.month("datetime").isin(2, 3)).select("station").distinct().count()
    assert abs(part.n_entities - exact) <= part.error * exact
    none = H.distinct_entities(sketches, "1999-01", "1999-12").first()
    assert (none.n_rows, none.n_entities) == (0, 0)
