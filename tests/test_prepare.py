import datetime as dt

import pytest
from pyspark.sql import functions as F

from brisa import spec as S
from brisa.functions import calendar as C
from brisa.functions import values as V
from brisa.operators import partitions as P
from brisa.operators import prepare as R
from brisa.operators.features import build_features, select_features
from tests.conftest import frame, raw_rows

SMALL = S.READINGS.with_(measures=("PM10", "TEMP"), categoricals=("wd",))


@pytest.fixture
def three(spark):
    d = dt.datetime
    return spark.createDataFrame(
        [
            (d(2023, 1, 1), None, 20.0, "N", 1.0),
            (d(2023, 1, 2), 10.0, None, "S", 2.0),
            (d(2023, 1, 3), 30.0, 40.0, None, 3.0),
        ],
        "datetime timestamp_ntz, pm25 double, PM10 double, wd string, TEMP double",
    )


def test_clean_drops_flags_and_fills(three):
    rows = R.clean(three, SMALL).orderBy("datetime").collect()
    assert [r["pm25"] for r in rows] == [10.0, 30.0]
    assert [r["PM10"] for r in rows] == [40.0, 40.0]  # median after the drop
    assert [r["PM10_era_nulo"] for r in rows] == [1, 0]
    assert [r["wd"] for r in rows] == ["S", "desconocido"]


def test_split_by_time(three):
    train, later = R.split_by_time(three, ["datetime"], 0.67)
    assert (train.count(), later.count()) == (2, 1)
    assert train.agg(F.max("datetime")).first()[0] < later.agg(F.min("datetime")).first()[0]


def test_slice_includes_the_whole_last_day(spark):
    d = dt.datetime
    df = spark.createDataFrame(
        [(d(2015, 6, 30), 1), (d(2015, 6, 30, 23), 2), (d(2015, 7, 1), 3)], "datetime timestamp_ntz, valor int"
    )
    part = P.slice_range(df, S.days("x", "2015-06-30", "2015-06-30"))
    assert sorted(r["valor"] for r in part.collect()) == [1, 2]


def test_slice_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, raw_rows()).write.parquet(path)
    plan = P.slice_label(spark.read.parquet(path), "test")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(datetime), GreaterThanOrEqual(datetime" in plan


def test_labels(spark):
    assert [r.label for r in P.resolve("train")] == ["train"]
    with pytest.raises(KeyError, match="produccion"):
        P.resolve("nope")


def test_features_of_one_row(spark):
    row = raw_rows(n=1)
    row[0]["datetime"] = dt.datetime(2023, 1, 1, 8)
    done = build_features(frame(spark, row)).first()
    assert (done["temporada"], done["hora"], done["dia_semana"], done["mes"]) == ("invierno", 8, 6, 1)
    row[0]["datetime"] = dt.datetime(2023, 7, 1, 12)
    assert build_features(frame(spark, row)).first()["temporada"] == "verano"


def test_features_are_idempotent_and_checked(spark, raw):
    once = build_features(raw)
    assert build_features(once).collect() == once.collect()
    with pytest.raises(KeyError, match="TEMP"):
        build_features(raw.drop("TEMP"))
    assert select_features(once).columns == [*S.READINGS.features, "pm25"]


def test_all_seasons_and_bands(spark):
    months = spark.range(1, 13).select(
        F.col("id"), F.expr("make_timestamp_ntz(2023, id, 1, 0, 0, 0)").alias("t")
    )
    seasons = [r[0] for r in months.orderBy("id").select(C.season(F.col("t"))).collect()]
    assert seasons == ["invierno"] * 2 + ["primavera"] * 3 + ["verano"] * 3 + ["otonio"] * 3 + ["invierno"]
    hours = spark.range(0, 25).select("id", C.hour_band(F.col("id")).alias("b"))
    bands = [r["b"] for r in hours.orderBy("id").collect()]
    assert bands == ["madrugada"] * 6 + ["manana"] * 6 + ["tarde"] * 6 + ["noche"] * 6 + ["desconocida"]


def test_impossible_time_is_null(spark):
    df = spark.createDataFrame([(2023, 2, 30, 1), (2023, 2, 28, 1)], "y int, m int, d int, h int")
    got = [r[0] for r in df.orderBy("d").select(C.event_time("y", "m", "d", "h")).collect()]
    assert got == [dt.datetime(2023, 2, 28, 1), None]


def test_numbers_and_sectors(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), (" 2 ",), ("NaN",)], "t string")
    got = df.select(V.to_number(F.col("t")).alias("v"), V.lost_in_cast(F.col("t")).alias("lost")).collect()
    assert [r["v"] for r in got] == [1.5, None, None, 2.0, None]
    assert [r["lost"] for r in got] == [False, True, False, False, True]
    wd = spark.createDataFrame([(" n ",), ("nne",), ("zz",)], "w string")
    assert [r[0] for r in wd.select(V.normalize_sector(F.col("w"))).collect()] == ["N", "NNE", None]


def test_most_frequent_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "x string")
    assert R.fit_most_frequent(df, ["x"]).values == {"x": "a"}


def test_sample_is_exact_and_stable(distributed):
    df = distributed.range(5000).repartition(7)
    a = {r["id"] for r in R.sample_rows(df, 321, "id").collect()}
    b = {r["id"] for r in R.sample_rows(df.repartition(3), 321, "id").collect()}
    other = {r["id"] for r in R.sample_rows(df, 321, "id", seed=7).collect()}
    assert len(a) == 321 and a == b and a != other
    assert R.sample_rows(df, 9999, "id").count() == 5000
    pairs = df.selectExpr("id % 50 AS a", "concat('s', CAST(id AS STRING)) AS b")
    assert R.sample_rows(pairs, 1000, ["a", "b"]).count() == 1000
    with pytest.raises(ValueError, match="does not identify"):
        R.sample_rows(pairs, 1001, "a")


def test_prepare_partition_rejects_and_accepts(spark):
    from brisa.operators.contract import ContractViolation

    rows = raw_rows()
    done = R.prepare_partition(frame(spark, rows), "test", as_of="2020-01-01")
    assert done.count() == 120
    rows[0]["pm25"] = 5000.0
    with pytest.raises(ContractViolation):
        R.prepare_partition(frame(spark, rows), "test", as_of="2020-01-01")
    assert R.prepare_partition(frame(spark, rows), "test", rows=50, validate=False).count() == 50


@pytest.mark.parametrize("forced", [True, False])
def test_partitions_prepared_together_equal_those_prepared_alone(spark, forced):
    from brisa.operators.contract import ContractViolation
    from brisa.queries import tables as Q

    for key in ("brisa.directRows", "brisa.broadcastRows"):
        spark.conf.set(key, "0" if forced else "100000")
    try:
        readings = Q.readings(spark, "/root/testdata/sf0.001")
        options = {"as_of": Q.AS_OF}
        together = R.prepare_partitions(readings, ["valid", "test"], Q.EVENTS, **options)
        alone = [R.prepare_partition(readings, p, Q.EVENTS, **options) for p in ("valid", "test")]
        columns = sorted(together.columns)
        want = sorted(map(repr, alone[0].unionByName(alone[1]).select(columns).collect()))
        assert sorted(map(repr, together.select(columns).collect())) == want
        late = Q.EVENTS.with_(ranges=(*Q.RANGES, S.days("later", "2030-01-01", "2030-01-02")))
        with pytest.raises(ContractViolation, match="min_volume"):
            R.prepare_labelled(readings, ["valid", "later"], late, **options)
        both = Q.EVENTS.with_(ranges=(*Q.RANGES, S.days("again", "2024-01-16", "2024-01-17")))
        with pytest.raises(ValueError, match="overlap"):
            R.prepare_labelled(readings, ["valid", "again"], both, **options)
    finally:
        for key in ("brisa.directRows", "brisa.broadcastRows"):
            spark.conf.unset(key)


def scans(spark, df):
    """The table with a counter of its rows as they are read, again in every scan."""
    from pyspark.sql.functions import udf

    seen = spark.sparkContext.accumulator(0)

    def count(_):
        seen.add(1)
        return True

    rows = df.count()
    counted = df.filter(udf(count, "boolean").asNondeterministic()(F.lit(1)))
    return counted, lambda: seen.value / rows


def test_the_source_is_read_once(spark, distributed):
    """Checks, medians by bucket, the sample and the result itself: one scan of the source."""
    from brisa.queries import tables as Q

    source, done = scans(spark, Q.readings(spark, "/root/testdata/sf0.001"))
    R.prepare_partition(source, "train", Q.EVENTS, as_of=Q.AS_OF, rows=100, key="event_id").collect()
    assert done() == 1
    source, done = scans(spark, Q.readings(spark, "/root/testdata/sf0.001"))
    R.prepare_partitions(source, ["train", "test"], Q.EVENTS, as_of=Q.AS_OF).collect()
    assert done() == 1
    source, done = scans(spark, Q.readings(spark, "/root/testdata/sf0.001"))
    R.prepare_partition(source, "test", Q.EVENTS, validate=False, once=False).collect()
    assert done() > 1


def test_batches_and_training_read_the_source_at_most_thrice(spark, tmp_path):
    from brisa.operators.forest import Baseline
    from brisa.plans.scoring import batch_score
    from brisa.plans.training import training_flow
    from brisa.queries import tables as Q
    from brisa.sources.ledger import Ledger

    readings = Q.readings(spark, "/root/testdata/sf0.001")
    readings = readings.withColumn("pm25", F.coalesce(F.col("PM10") / 20 + 1, F.col("NO2") / 8 + 1, F.lit(1.0)))
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    source, done = scans(spark, readings)
    training_flow(source, ledger, str(tmp_path / "s"), "m", Q.EVENTS, as_of=Q.AS_OF, numTrees=5, maxDepth=4)
    assert done() == 2  # the fingerprint and the slices
    ledger.register("mean", "1", "u")
    ledger.set_alias("mean", "champion", "1")
    source, done = scans(spark, readings)
    batch_score(source, "test", ledger, "mean", str(tmp_path / "p"), Q.EVENTS, as_of=Q.AS_OF, load=lambda _: Baseline(1.0))
    assert done() == 1
