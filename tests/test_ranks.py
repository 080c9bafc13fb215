"""The distributed order statistics against brute force, also on skewed data."""

import datetime as dt
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brisa.operators import ranks as K


def brute_quantile(values, p):
    v = sorted(values)
    at = p * (len(v) - 1)
    low, high = int(at), min(int(at) + 1, len(v) - 1)
    return v[low] + (at - low) * (v[high] - v[low])


def skewed(seed=3, n=4000):
    """One group holds a third of all rows and one value a third of that group."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 == 0 else f"g{rng.randrange(20)}"
        v = 5.0 if g == "hot" and i % 9 == 0 else round(rng.expovariate(0.01), 3)
        rows.append((g if i % 50 else None, None if i % 41 == 0 else v, float(rng.randrange(4))))
    return rows


@pytest.mark.parametrize("forced", [True, False])
def test_grouped_quantiles(spark, forced):
    spark.conf.set("brisa.directRows", "0" if forced else "1000000")
    spark.conf.set("brisa.broadcastRows", "0" if forced else "1000")
    try:
        rows = skewed()
        df = spark.createDataFrame(rows, "g string, v double, w double").repartition(6)
        probs = [0.0, 0.25, 0.5, 0.95, 1.0]
        got = {(r["g"], r["column"]): r["q"] for r in K.exact_quantiles(df, ["v", "w"], probs, ["g"]).collect()}
        groups = {r[0] for r in rows}
        assert len(got) == 2 * len(groups)
        for g in groups:
            for i, c in ((1, "v"), (2, "w")):
                values = [r[i] for r in rows if r[0] == g and r[i] is not None]
                want = [brute_quantile(values, p) for p in probs]
                assert got[(g, c)] == pytest.approx(want, abs=1e-9)
    finally:
        spark.conf.unset("brisa.directRows")
        spark.conf.unset("brisa.broadcastRows")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_quantiles_of_any_list(distributed, values):
    df = distributed.createDataFrame([(v,) for v in values], "v double")
    q = K.exact_quantiles(df, ["v"], [0.1, 0.5, 0.9]).first()["q"]
    assert q == pytest.approx([brute_quantile(values, p) for p in (0.1, 0.5, 0.9)], rel=1e-9, abs=1e-9)


def test_no_values_no_row(distributed):
    df = distributed.createDataFrame([(None,), (float("nan"),)], "v double")
    assert K.exact_quantiles(df, ["v"], [0.5]).collect() == []


@pytest.mark.parametrize("n", [0, 1, 777, 1999, 2000, 5000])
def test_first_rows_with_heavy_ties(distributed, n):
    rng = random.Random(1)
    rows = [(1.0 if i % 3 else float(rng.randrange(50)), i) for i in range(2000)]
    df = distributed.createDataFrame(rows, "t double, id bigint").repartition(5)
    got = {(r["t"], r["id"]) for r in K.first_rows(df, n, ["t", "id"]).collect()}
    assert got == set(sorted(rows)[:n])


def test_first_rows_by_time_is_pushed_down(distributed, tmp_path):
    path = str(tmp_path / "t")
    distributed.range(1000).select(
        "id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)").alias("t")
    ).write.parquet(path)
    cut = K.first_rows(distributed.read.parquet(path), 100, ["t", "id"])
    assert cut.count() == 100
    assert "LessThan(t" in cut._jdf.queryExecution().toString()


def test_text_is_ranked_by_its_bytes(spark):
    names = ["a", "ab", "abcdefgh", "abcdefghi", "abcdefgz", "Z", "é", "日本語", "b"]
    rows = [(i // 5, n) for i, n in enumerate(names * 4)]
    rows = sorted(set(rows))
    df = spark.createDataFrame(rows, "t int, k string").repartition(3)
    want = sorted(rows, key=lambda r: (r[0], r[1].encode()))
    for n in (1, 4, 7, len(rows) - 1):
        assert sorted(tuple(r) for r in K.first_rows(df, n, ["t", "k"]).collect()) == sorted(want[:n])


def test_a_cut_inside_equal_rows_is_refused(spark):
    df = spark.createDataFrame([(1, "a")] * 5, "t int, k string")
    with pytest.raises(ValueError, match="does not identify"):
        K.first_rows(df, 2, ["t", "k"])


def test_cut_does_not_depend_on_the_time_zone(spark):
    start = dt.datetime(2024, 3, 10)
    df = spark.createDataFrame([(start + dt.timedelta(minutes=30 * i),) for i in range(20)], "t timestamp_ntz")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert K.first_rows(df, 5, ["t"]).count() == 5
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("values", [[float("inf")] * 30 + [1.0] * 270, [-math.inf, 0.0, -0.0, math.nan, 5.0, math.inf, 5.0]])
def test_both_plans_agree_on_odd_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = []
    for limit in ("0", "1000000"):
        spark.conf.set("brisa.directRows", limit)
        found.append(K.exact_quantiles(df, ["v"], [0.0, 0.3, 0.5, 0.95, 0.99, 1.0]).first()["q"])
    spark.conf.unset("brisa.directRows")
    assert str(found[0]) == str(found[1])


def test_hot_values_get_their_own_bucket(spark):
    df = spark.createDataFrame([(7.0,)] * 900 + [(float(i),) for i in range(100)], "v double")
    edges = K.fit_splitters(df, ["v"], 1000)["v"]
    assert 7.0 in edges and edges[edges.index(7.0) + 1] == pytest.approx(7.0)


@pytest.mark.parametrize("partitions", ["1", "16", "64"])
def test_same_result_for_any_partition_count(distributed, partitions):
    distributed.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = distributed.createDataFrame(skewed(5, 900), "g string, v double, w double")
        got = {r["column"]: r["q"] for r in K.exact_quantiles(df, ["v"], [0.3, 0.6]).collect()}
        values = [r[1] for r in skewed(5, 900) if r[1] is not None]
        assert got["v"] == pytest.approx([brute_quantile(values, p) for p in (0.3, 0.6)])
    finally:
        distributed.conf.set("spark.sql.shuffle.partitions", "4")
