import bisect
import random

import pytest
from pyspark.sql import functions as F

from brisa.operators import drift as D
from brisa.plans.drift_check import drift_check
from tests.conftest import frame, raw_rows


def samples(spark, ref, prod, schema):
    return spark.createDataFrame(ref, schema).withColumns({D.REF: F.lit(True), D.PROD: F.lit(False)}).unionByName(
        spark.createDataFrame(prod, schema).withColumns({D.REF: F.lit(False), D.PROD: F.lit(True)})
    )


def normal(seed, mean, n=1000, sd=5):
    rng = random.Random(seed)
    return [(rng.gauss(mean, sd),) for _ in range(n)]


def brute_ks(a, b):
    a, b = sorted(a), sorted(b)
    return max(abs(bisect.bisect_right(a, x) / len(a) - bisect.bisect_right(b, x) / len(b)) for x in a + b)


@pytest.mark.parametrize("rows", ["1000000", "0"])
@pytest.mark.parametrize("shift", [0, 1, 50])
def test_ks_is_exact(spark, rows, shift):
    spark.conf.set("brisa.directRows", rows)
    try:
        a, b = normal(1, 100), normal(2, 100 + shift, n=700)
        a += [(100.0,)] * 300  # a value both samples share often
        got = D.ks(samples(spark, a, b, "x double"), ["x"]).first()
        want = brute_ks([v for (v,) in a], [v for (v,) in b])
        assert got["statistic"] == pytest.approx(want, abs=1e-12)
        assert (got["n_ref"], got["n_prod"]) == (1300, 700)
        if shift == 50:
            assert got["drift"] and got["statistic"] > 0.5
    finally:
        spark.conf.unset("brisa.directRows")


def test_same_distribution_does_not_drift(spark):
    row = D.ks(samples(spark, normal(11, 100), normal(12, 100), "x double"), ["x"]).first()
    assert not row["drift"]


def test_too_little_data(spark):
    row = D.ks(samples(spark, [(10.0,)], [(20.0,)], "x double"), ["x"]).first()
    assert (row["p_value"], row["statistic"], row["drift"]) == (1.0, 0.0, False)


def test_text_and_nulls_do_not_count(spark):
    got = D.ks(samples(spark, [("1",), ("x",), ("2",)], [(None,), ("1",), ("2",)], "x string"), ["x"]).first()
    assert (got["n_ref"], got["n_prod"], got["statistic"]) == (2, 2, 0.0)


@pytest.mark.parametrize(
    "d,n1,n2,p",
    # Published 5 % and 1 % points for large samples: c(alpha) * sqrt((n1 + n2) / (n1 * n2)).
    [(1.358 * (2 / 10**7) ** 0.5, 10**7, 10**7, 0.05), (1.628 * (2 / 10**7) ** 0.5, 10**7, 10**7, 0.01)],
)
def test_ks_p_value_at_critical_points(spark, d, n1, n2, p):
    row = spark.range(1).select(D.ks_p_value(F.lit(d), F.lit(n1), F.lit(n2))).first()
    assert row[0] == pytest.approx(p, rel=0.02)


@pytest.mark.parametrize(
    "x,dof,p",
    [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05),
     (24.995790139728616, 15, 0.05), (6.634896601021213, 1, 0.01), (124.342113404004, 100, 0.05), (0.0, 3, 1.0)],
)
def test_chi2_tail_at_critical_points(x, dof, p):
    assert D.chi2_tail(x, dof) == pytest.approx(p, rel=1e-6)


def test_new_level_with_yates(spark):
    ref, prod = [("N",)] * 500, [("N",)] * 400 + [("NE",)] * 100
    row = D.chi2(samples(spark, ref, prod, "wd string"), ["wd"]).first()
    assert row["statistic"] == pytest.approx(108.9)
    assert row["effect"] == pytest.approx(0.33, abs=1e-3)
    assert row["drift"] and row["dof"] == 1


def test_same_levels_and_single_level(spark):
    same = [("N",), ("N",), ("S",), ("S",)]
    assert not D.chi2(samples(spark, same, same, "wd string"), ["wd"]).first()["drift"]
    one = D.chi2(samples(spark, [("N",)] * 3, [("N",)] * 3, "wd string"), ["wd"]).first()
    assert (one["statistic"], one["p_value"], one["drift"]) == (0.0, 1.0, False)


def test_three_levels_without_correction(spark):
    ref = [("a",)] * 30 + [("b",)] * 20 + [("c",)] * 50
    prod = [("a",)] * 10 + [("b",)] * 30 + [(None,)] * 60
    row = D.chi2(samples(spark, ref, prod, "x string"), ["x"]).first()
    want = 0.0
    for a, b in ((30, 10), (20, 30), (50, 0), (0, 60)):
        e = (a + b) / 2
        want += (a - e) ** 2 / e + (b - e) ** 2 / e
    assert row["statistic"] == pytest.approx(want) and row["dof"] == 3


def test_verdict_names_both_columns(spark):
    ref = [(v, "N") for (v,) in normal(1, 100, 500)]
    prod = [(v, "S") for (v,) in normal(2, 150, 500)]
    both = D.compare(samples(spark, ref, prod, "TEMP double, wd string"), ["TEMP", "PRES"], ["wd"])
    row = D.verdict(both, 0.0).first()
    assert (row["n_columns"], row["n_drifting"], row["share"]) == (2, 2, 1.0)
    assert row["drifting"] == "TEMP,wd" and row["status"] == D.DRIFT


def test_threshold_is_strict(spark):
    rows = spark.createDataFrame([("a", True), ("b", False)], "column string, drift boolean")
    assert D.verdict(rows, 0.5).first()["status"] == D.NO_DRIFT
    assert D.verdict(rows, 0.49).first()["status"] == D.DRIFT


def test_missing_columns_are_ignored(spark):
    rows = [(1.0,), (2.0,)]
    got = D.compare(samples(spark, rows, rows, "TEMP double"), ["TEMP", "PRES"], ["wd"]).collect()
    assert [r["column"] for r in got] == ["TEMP"] and not got[0]["drift"]


def test_check_of_partitions(spark):
    df = frame(spark, raw_rows())  # all rows lie in partition "test"
    assert drift_check(df, "test", "test").status == D.NO_DRIFT
    assert drift_check(df, "train", "test").status == D.ERROR  # train is empty
    assert drift_check(df, "nope", "test").status == D.ERROR


@pytest.mark.parametrize("rows", ["1000000", "0"])
def test_ks_of_infinite_and_equal_values(spark, rows):
    inf = float("inf")
    a = [-inf] * 5 + [0.0] * 20 + [-0.0] * 20 + [inf] * 30
    b = [-inf] * 15 + [0.0] * 50 + [1.0] * 10 + [inf] * 5
    spark.conf.set("brisa.directRows", rows)
    try:
        got = D.ks(samples(spark, [(v,) for v in a], [(v,) for v in b], "x double"), ["x"]).first()
        assert got["statistic"] == pytest.approx(brute_ks(a, b), abs=1e-12)
    finally:
        spark.conf.unset("brisa.directRows")


def test_chi_square_tail_has_no_seam():
    for z in (-3.0, -1.0, 0.0, 1.0, 3.0):
        x = [n + z * (2 * n) ** 0.5 for n in (D.MAX_TERMS, D.MAX_TERMS + 1)]
        assert D.chi2_tail(x[0], D.MAX_TERMS) == pytest.approx(D.chi2_tail(x[1], D.MAX_TERMS + 1), abs=1e-4)


@pytest.mark.parametrize("shift", [0, 1])
def test_open_buckets_are_split_until_few_values_are_left(spark, distributed, monkeypatch, shift):
    monkeypatch.setattr(D, "KS_BUCKETS", 40)
    monkeypatch.setattr(D, "KS_OPEN_VALUES", 40)
    looked = []
    inside = D._ks_inside

    def spied(numbers, curves, looks):
        looked.append(sum(int((curves[c].a + curves[c].b)[o].sum()) for c, o in looks.items()))
        return inside(numbers, curves, looks)

    monkeypatch.setattr(D, "_ks_inside", spied)
    a, b = normal(3, 100, n=900), normal(4, 100 + shift, n=1100)
    a, b = a + [(99.5,)] * 200, b + [(99.5,)] * 210
    both = samples(spark, [(x, -x) for (x,) in a], [(x, -x) for (x,) in b], "x double, y double")
    for r in D.ks(both, ["x", "y"]).collect():
        sign = 1 if r.column == "x" else -1
        want = brute_ks([sign * v for (v,) in a], [sign * v for (v,) in b])
        assert r.statistic == pytest.approx(want, abs=1e-12)
    assert sum(looked) <= 40


def test_a_sample_against_itself_moves_no_values(spark, distributed, monkeypatch):
    def never(*_):
        raise AssertionError("no bucket is to be looked into")

    monkeypatch.setattr(D, "_ks_inside", never)
    rows = spark.createDataFrame(normal(5, 10), "x double").withColumns({D.REF: F.lit(True), D.PROD: F.lit(True)})
    row = D.ks(rows, ["x"]).first()
    assert (row.n_ref, row.n_prod, row.statistic, row.drift) == (1000, 1000, 0.0, False)


def test_tasks_hand_on_buckets_and_not_values(spark, distributed, monkeypatch):
    """The counting scan shuffles a row for each task, column and bucket."""
    df = spark.range(0, 200_000, 1, 4).select(F.rand(3).alias("x"), (F.col("id") % 2 == 0).alias(D.REF))
    df = df.withColumn(D.PROD, ~F.col(D.REF))
    curve = {"x": D._Curve(D.np.linspace(0.01, 0.99, 99), *D.np.zeros((3, 100), int))}
    values = D._open_values(df, curve, {"x": D.np.ones(100, bool)})
    counted = values.groupBy("column", "bucket").agg(*D._counts())
    counted.collect()
    written = [m for m in metrics(counted) if m[0] == "shuffle records written"]
    assert [n for _, n in written] == [4 * 100]


def metrics(df):
    """(name, value) of the metrics of the plan that ran."""
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        found = node.metrics().iterator()
        while found.hasNext():
            pair = found.next()
            out.append((pair._2().name().get(), pair._2().value()))
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children().iterator()
        while children.hasNext():
            todo.append(children.next())
    return out
