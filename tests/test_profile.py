import datetime as dt

import pytest
from pyspark.sql import functions as F

from brisa.operators import profile as O


def test_histogram_keeps_empty_bins_and_maximum(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "x double")
    n = [r["n"] for r in O.histogram(df, ["x"], 5).orderBy("bin").collect()]
    assert n == [2, 0, 0, 0, 1]
    constant = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r["n"] for r in O.histogram(constant, ["x"], 3).orderBy("bin").collect()] == [2, 0, 0]


def test_log_histogram_leaves_out_what_has_no_log(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (1.0,), (100.0,)], "x double")
    assert sum(r["n"] for r in O.histogram(df, ["x"], 4, log=True).collect()) == 2


def test_density_integrates_to_one(spark):
    df = spark.range(1, 500).select((F.col("id") % 37 + 1).alias("x"), (F.col("id") % 2).alias("p"))
    rows = O.density(df, "x", "p", 20).collect()
    for p in (0, 1):
        assert sum(r["density"] * (r["high"] - r["low"]) for r in rows if r["p"] == p) == pytest.approx(1)


def test_levels_keep_their_order_and_gaps(spark):
    df = spark.createDataFrame([("b", 1.0), ("b", 3.0), ("z", 9.0), (None, 7.0)], "l string, v double")
    got = [(r["level"], r["result"]) for r in O.by_level(df, "l", ("a", "b")).collect()]
    assert got == [("a", None), ("b", 2)]
    means = O.mean_by_level(df, "l", ("a", "b"), "v").collect()
    assert [(r["mean"], r["global_mean"]) for r in means] == [(None, 5.0), (2.0, 5.0)]


def test_correlation_is_pairwise_complete(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, None, 0.0), (4.0, 8.0, 5.0), (5.0, 1.0, 5.0)],
        "a double, b double, c double",
    )
    got = {(r["a"], r["b"]): r["r"] for r in O.correlations(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got[("a", "a")] == 1.0
    pdf = df.toPandas().corr()
    for a in "abc":
        for b in "abc":
            assert got[(a, b)] == pytest.approx(pdf.loc[a, b])


def test_box_whiskers_and_outliers(spark, distributed):
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 5, 100]] + [("b", 7.0)]
    got = {r["g"]: r for r in O.box_stats(spark.createDataFrame(rows, "g string, v double"), "v", "g").collect()}
    a = got["a"]
    assert (a["q1"], a["med"], a["q3"]) == (2.25, 3.5, 4.75)
    assert (a["whisker_low"], a["whisker_high"], a["n_outliers"]) == (1.0, 5.0, 1)
    assert got["b"]["n_outliers"] == 0


def test_year_over_year(spark):
    d = dt.datetime
    df = spark.createDataFrame(
        [(d(2014, 1, 5), 50.0), (d(2015, 1, 5), 25.0), (d(2015, 2, 5), 9.0)], "datetime timestamp_ntz, x double"
    )
    got = O.same_month_by_year(df, 1, ["x"]).orderBy("year").collect()
    assert [(r["year"], r["mean"], r["pct_change"]) for r in got] == [(2014, 50.0, 0.0), (2015, 25.0, -50.0)]


def test_prediction_summary(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("prediccion_pm25"))
    assert tuple(O.prediction_summary(df).first()) == (101, 50.0, 95.0)


def test_groups_without_a_name_are_described_too(spark, distributed):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], "g string, v double")
    got = {r["g"]: (r["count"], r["q50"], r["max"]) for r in O.describe(df, ["v"], ["g"]).collect()}
    assert got == {"a": (2, 2.0, 3.0), None: (1, 5.0, 5.0)}
    assert {r["g"] for r in O.box_stats(df, "v", "g").collect()} == {"a", None}


def test_one_month_of_every_year_opens_its_folders_only(spark, tmp_path):
    from brisa.sources.readings import ensure_snapshot

    df = spark.range(4_000).select(
        F.expr("timestamp_ntz '2020-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id AS INT))").alias("datetime"),
        F.when(F.col("id") < 366, 10.0).otherwise(15.0).alias("x"),
    )
    table = ensure_snapshot(spark, str(tmp_path / "s"), lambda: df)
    for source in (table, df):
        rows = O.same_month_by_year(source, 12, ["x"])
        assert [(r.year, r["mean"]) for r in rows.orderBy("year").collect()] == [(2020, 10.0)] + [(y, 15.0) for y in range(2021, 2031)]
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = O.same_month_by_year(table, 12, ["x"])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pruned = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert all(f"{y}-12" in pruned for y in range(2020, 2031))
    assert O.same_month_by_year(table, 12, ["x"], years=(2021, 2022)).count() == 2
    assert O.same_month_by_year(df.limit(0), 12, ["x"]).count() == 0


def test_density_curves_have_area_one(spark):
    import numpy as np

    df = spark.createDataFrame(
        [("a", 10.0 ** (i / 100)) for i in range(200)] + [("b", 10.0 ** (i % 7)) for i in range(50)] + [("c", 5.0), ("c", 5.0), ("d", -1.0)],
        "g string, v double",
    )
    rows = O.density_curve(df, "v", "g", points=400).collect()
    assert {r.g for r in rows} == {"a", "b"}
    for g in ("a", "b"):
        own = sorted((r.x, r.density) for r in rows if r.g == g)
        x, d = np.array(own).T
        assert np.trapezoid(d, x) == __import__("pytest").approx(1.0, abs=0.01)
    values = np.log10([10.0 ** (i / 100) for i in range(200)])
    bw = values.std(ddof=1) * 200**-0.2
    for r in rows[:400:37]:
        if r.g == "a":
            want = np.exp(-0.5 * ((r.x - values) / bw) ** 2).sum() / (200 * bw * np.sqrt(2 * np.pi))
            assert abs(r.density - want) < 1e-4
