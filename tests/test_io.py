"""Files, sinks, incoming records, streams."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from brisa import spec as S
from brisa.operators.features import build_features
from brisa.operators.partitions import slice_range
from brisa.sources import readings as A
from brisa.sources import sinks as K
from brisa.plans.serving import serve_champion
from brisa.sources.incoming import check_incoming, split_incoming, store_incoming
from brisa.sources.ledger import Ledger
from brisa.streaming import jobs as T
from tests.conftest import frame, raw_rows

HEADER = "No,year,month,day,hour,PM2.5,PM10,SO2,NO2,CO,O3,TEMP,PRES,DEWP,RAIN,wd,WSPM,station"


def test_csv_files_are_united(spark, tmp_path):
    for i, name in enumerate(("A", "B")):
        folder = tmp_path / f"d{i}"
        folder.mkdir()
        (folder / f"PRSA_Data_{name}.csv").write_text(
            f"{HEADER}\n1,2013,3,1,{i},4,4,4,7,300,77,-0.7,1023,-18.8,0,NNW,4.4,{name}\n"
            f"2,2013,2,30,0,NA,4,4,7,300,77,-0.7,1023,-18.8,0,NA,4.4,{name}\n"
        )
        (folder / "other.csv").write_text("x\n")
    raw = A.scan_csv(spark, str(tmp_path))
    rows = A.readings_from_raw(raw).orderBy("station", "No").collect()
    assert len(rows) == 4
    assert rows[0]["datetime"] == dt.datetime(2013, 3, 1, 0) and rows[0]["pm25"] == 4.0
    assert rows[1]["datetime"] is None and rows[1]["pm25"] is None and rows[1]["wd"] is None
    assert A.impossible_times(raw).first()["n_impossible"] == 2
    with pytest.raises(FileNotFoundError):
        A.scan_csv(spark, str(tmp_path), glob="none_*.csv")


def test_snapshot_is_built_once_and_pruned(spark, tmp_path):
    path, built = str(tmp_path / "snap"), []

    def build():
        built.append(1)
        return frame(spark, raw_rows(n=1000))

    assert A.load_snapshot(spark, path) is None
    assert A.ensure_snapshot(spark, path, build).count() == 1000
    assert A.ensure_snapshot(spark, path, build).count() == 1000
    assert len(built) == 1
    months = [r[0] for r in spark.read.parquet(path).select("part_month").distinct().orderBy("part_month").collect()]
    assert [str(m) for m in months] == ["2016-01", "2016-02"]
    part = slice_range(A.load_snapshot(spark, path), S.days("x", "2016-02-01", "2016-02-03"))
    assert part.count() == 72 and "part_month" not in part.columns
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_month" in plan


def test_columns_are_found_by_header(spark, tmp_path):
    names = HEADER.split(",")
    row = dict(zip(names, "1,2013,3,1,0,4,5,6,7,300,77,-0.7,1023,-18.8,NaN,NNW,4.4,A".split(",")))
    for i, order in enumerate((names, names[::-1])):
        text = ",".join(order) + "\n" + ",".join(row[c] for c in order) + "\n"
        (tmp_path / f"PRSA_Data_{i}.csv").write_text(text)
    rows = A.readings_from_raw(A.scan_csv(spark, str(tmp_path))).collect()
    assert {(r["pm25"], r["PM10"], r["RAIN"], r["station"]) for r in rows} == {(4.0, 5.0, None, "A")}


def test_later_events_of_one_moment_win(spark, tmp_path):
    ledger, moment = Ledger(spark, str(tmp_path / "l")), dt.datetime(2024, 1, 1)
    for version in ("1", "2"):
        ledger.set_alias("m", "champion", version, moment)
    assert ledger.version_of("m", "champion") == "2"


def test_rows_are_not_written_alike(spark):
    def mark(*rows):
        return A.fingerprint(spark.createDataFrame(list(rows), "a string, b string")).first()["fingerprint"]

    assert mark(("a|b", "c")) != mark(("a", "b|c")) and mark((None, "c")) != mark(("~", "c"))
    assert mark(("1", "2:x")) != mark(("1:2", "x"))


def test_another_table_is_checked_and_audited(spark):
    from brisa.queries import tables as Q

    record = {"l_shipdate": "2000-01-01", "l_suppkey": "7", "flag": " r ", "l_linestatus": "O",
              "l_quantity": 1, "l_discount": 0.1, "l_tax": 0.2, "price": 3}
    df = spark.createDataFrame([(json.dumps(record),), (json.dumps({**record, "flag": "Q"}),)], "j string")
    rows = check_incoming(df, "j", Q.LINE_SPEC).select("flag", "reasons").collect()
    assert [(r["flag"], r["reasons"]) for r in rows] == [("R", []), (None, ["bad:flag"])]
    built = build_features(Q.lines(spark, "/root/testdata/sf0.001"), Q.LINE_SPEC).withColumn("prediction", F.lit(1.0))
    trace = K.Trace("b", "test", "m", "1", "champion", "u", dt.datetime(2024, 1, 1))
    stored = K.audit_rows(built, trace, Q.LINE_SPEC)
    assert tuple(stored.columns) == K.stored_columns(Q.LINE_SPEC) and "prediccion_l_extendedprice" in stored.columns


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = frame(spark, raw_rows())
    a = A.fingerprint(df).first()["fingerprint"]
    assert a == A.fingerprint(df.repartition(7).orderBy(F.desc("datetime"))).first()["fingerprint"]
    rows = raw_rows()
    rows[5]["CO"] += 1
    assert a != A.fingerprint(frame(spark, rows)).first()["fingerprint"]


def audit(df, **changes):
    options = dict(
        batch_id="b-1", label="test", model="m", version="1", alias="champion", uri="u",
        moment=dt.datetime(2024, 1, 1, 2, 3, 4, 5),
    )
    return K.audit_rows(df, K.Trace(**{**options, **changes}), prediction="pm25")


def test_predictions_are_replaced_not_repeated(spark, tmp_path, holdout):
    path = str(tmp_path / "p")
    for batch in ("b-1", "b-2", "b-1"):
        assert K.write_predictions(audit(holdout, batch_id=batch), path) == 120
    stored = K.read_predictions(spark, path)
    assert tuple(stored.columns) == K.stored_columns()
    counts = {r["batch_id"]: r["count"] for r in stored.groupBy("batch_id").count().collect()}
    assert counts == {"b-1": 120, "b-2": 120}
    assert stored.first()["prediction_timestamp"] == "2024-01-01T02:03:04"


def test_null_prediction_is_refused(holdout):
    bad = holdout.withColumn("pm25", F.when(F.col("i") != 3, F.col("pm25")))
    with pytest.raises(Exception, match="null in prediccion_pm25"):
        audit(bad).collect()


GOOD = {
    "datetime": "2016-07-01T08:00:00", "station": " Aotizhongxin ", "wd": "n", "PM10": 40, "SO2": 10, "NO2": 30,
    "CO": "800", "O3": 50, "TEMP": 15, "PRES": 1010, "DEWP": 8, "RAIN": 0, "WSPM": 2,
}


def reasons(spark, **changes):
    record = {k: v for k, v in {**GOOD, **changes}.items() if v != "drop"}
    df = spark.createDataFrame([(json.dumps(record),)], "j string")
    return check_incoming(df, "j").first()["reasons"]


def test_incoming_records(spark):
    df = spark.createDataFrame([(1, json.dumps(GOOD)), (2, "{nope")], "id int, j string")
    valid, bad = split_incoming(check_incoming(df, "j"))
    row = valid.first()
    assert (row["wd"], row["CO"], row["station"]) == ("N", 800.0, "Aotizhongxin")
    assert bad.first()["reasons"] == ["malformed"] and valid.count() == 1
    assert reasons(spark, PM10=1001) == ["range:PM10"]
    assert reasons(spark, wd="XX") == ["bad:wd"]
    assert reasons(spark, CO="drop") == ["bad:CO"]
    assert reasons(spark, color="red") == ["unknown:color"]
    assert reasons(spark, station="x" * 81) == ["bad:station"]
    assert reasons(spark, station="") == ["bad:station"]
    assert reasons(spark, datetime="soon") == ["bad:datetime"]


class Mean:
    def transform(self, df):
        return df.withColumn("prediction", F.lit(3.0))


def test_stream_scores_and_restarts(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()

    def put(name, records):
        (source / name).write_text("\n".join(json.dumps({"record": json.dumps(r)}) for r in records))

    def run():
        stream = spark.readStream.schema("record string").json(str(source))
        T.run_to_end(T.score_stream(stream, "record", Mean(), "7", out))

    put("a.json", [GOOD, {**GOOD, "PM10": 9999}])
    run()
    put("b.json", [GOOD])
    run()
    run()  # nothing new
    scored = spark.read.parquet(f"{out}/scored")
    assert scored.count() == 2 and scored.first()["model_version"] == "7"
    assert spark.read.parquet(f"{out}/quarantine").first()["reasons"] == ["range:PM10"]
    with pytest.raises(T.NoModel):
        T.score_stream(spark.readStream.schema("record string").json(str(source)), "record", None, "", out)


def test_only_a_champion_serves(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.json").write_text(json.dumps({"record": json.dumps(GOOD)}))
    stream = spark.readStream.schema("record string").json(str(source))
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    ledger.register("m", "1", "mean")
    ledger.set_alias("m", "candidate", "1")
    with pytest.raises(T.NoModel):
        serve_champion(stream, "record", ledger, "m", out, load={"mean": Mean()}.get)
    ledger.set_alias("m", "champion", "1")
    T.run_to_end(serve_champion(stream, "record", ledger, "m", out, load={"mean": Mean()}.get))
    assert spark.read.parquet(f"{out}/scored").first()["model_version"] == "1"


def test_incoming_is_stored_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, json.dumps(GOOD)), (2, "{nope")], "id int, j string")
    valid, bad = store_incoming(check_incoming(df, "j"), str(tmp_path / "s"))
    assert [r["id"] for r in valid.collect()] == [1]
    assert [(r["id"], r["reasons"]) for r in bad.collect()] == [(2, ["malformed"])]


def test_stream_drops_repeats(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(dt.datetime(2024, 1, 1, i % 5), "a") for i in range(20)]
    df = spark.createDataFrame(rows, "t timestamp, k string")
    df.write.parquet(path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    T.run_to_end(T.append_stream(T.unique_readings(stream, ["k", "t"], "t"), out))
    assert spark.read.parquet(f"{out}/data").count() == 5


def test_stream_counts_over_batches(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "t timestamp, ok boolean"
    for day in (1, 1, 2):
        rows = [(dt.datetime(2024, 1, day, 3), i % 4 != 0) for i in range(8)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        T.run_to_end(T.update_stream(T.outcome_counts(stream, F.col("ok").cast("string"), "t"), out))
    got = T.latest_counts(spark.read.parquet(f"{out}/counts")).collect()
    assert sorted((r["day"].day, r["outcome"], r["n"]) for r in got) == [
        (1, "false", 4), (1, "true", 12), (2, "false", 2), (2, "true", 6),
    ]


def test_time_column_names_stay_plain():
    assert S.TARGET == "pm25" and "." not in "".join(S.READINGS.features)
