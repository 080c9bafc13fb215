import datetime as dt

import pytest
from pyspark.sql import functions as F

from brisa.operators import gate as G
from brisa.operators import metrics as E
from brisa.plans.promotion import decide, promote
from brisa.plans.training import should_retrain
from brisa.sources.ledger import Ledger, RegistryUnavailable, UnknownAlias, current_state
from tests.conftest import Offset

SOUND = "rule string, column string, scope string, violations bigint"


def run(spark, cand, champ, cand_groups, champ_groups, broken=0):
    contract = spark.createDataFrame([("range", "x", "row", broken)], SOUND)
    metrics = [("candidate", float(cand), 0.5)] + ([("champion", float(champ), 0.5)] if champ else [])
    groups = [("candidate", "temporada", k, float(v), 60) for k, v in cand_groups.items()]
    groups += [("champion", "temporada", k, float(v), 60) for k, v in champ_groups.items()]
    judged = G.criteria(
        contract,
        spark.createDataFrame(metrics, "model string, mae double, r2 double"),
        spark.createDataFrame(groups, "model string, axis string, grp string, mae double, n bigint"),
        "candidate",
        "champion" if champ else None,
    )
    return judged, G.verdict(judged, champ is not None).first()


@pytest.mark.parametrize(
    "cand,champ,cg,hg,promoted,reason",
    [
        (20, None, {"invierno": 21}, {}, True, G.REASON_FIRST),
        (20, 15, {"invierno": 21}, {"invierno": 16}, False, G.REASON_FAILED + "mejora_global, sin_regresion_por_subgrupo"),
        (19.9, 20, {"invierno": 21}, {"invierno": 21}, False, G.REASON_FAILED + "mejora_global"),
        (19.8, 20, {"invierno": 21}, {"invierno": 21}, True, G.REASON_ALL),
        (15, 20, {"invierno": 30, "verano": 10}, {"invierno": 20, "verano": 12}, False, G.REASON_FAILED + "sin_regresion_por_subgrupo"),
        (15, 20, {"invierno": 21}, {"verano": 12}, False, G.REASON_FAILED + "sin_regresion_por_subgrupo"),
        (15, 20, {"invierno": 21}, {"invierno": 0}, False, G.REASON_FAILED + "sin_regresion_por_subgrupo"),
    ],
)
def test_decision_table(spark, cand, champ, cg, hg, promoted, reason):
    _, row = run(spark, cand, champ, cg, hg)
    assert (row["promote"], row["reason"]) == (promoted, reason)
    assert row["first_model"] == (champ is None and promoted)
    assert row["validation_status"] == ("passed" if promoted else "failed")


def test_broken_contract_ends_the_gate(spark):
    judged, row = run(spark, 1, 20, {"invierno": 1}, {"invierno": 20}, broken=1)
    status = [r["status"] for r in judged.orderBy("pos").collect()]
    assert status == [G.FAILS, G.SKIPPED, G.SKIPPED]
    assert row["reason"] == G.REASON_FAILED + "contrato_de_datos"


def test_thresholds_are_not_negative():
    with pytest.raises(ValueError):
        G.Thresholds(min_gain=-0.1)
    with pytest.raises(ValueError):
        G.Thresholds(max_group_loss=-1)


def test_metrics_of_an_offset_model(spark, holdout):
    scored = Offset(1.0).transform(holdout)
    row = E.global_metrics(scored).first()
    assert (row["n"], row["mae"], row["rmse"]) == (120, 1.0, 1.0)
    groups = {(r["axis"], r["grp"]): r["mae"] for r in E.subgroup_metrics(scored).collect()}
    assert groups == {("temporada", "invierno"): 1.0, ("temporada", "verano"): 1.0}
    assert len(E.subgroup_metrics(scored, min_rows=30).collect()) == 6


def test_r2_of_a_constant_target(spark):
    df = spark.createDataFrame([(5.0, 5.0, 6.0)] * 3, "pm25 double, a double, b double")
    assert E.global_metrics(df, prediction="a").first()["r2"] == 1.0
    assert E.global_metrics(df, prediction="b").first()["r2"] == 0.0


def test_gate_on_a_holdout(spark, holdout):
    judged = decide(holdout, {"candidate": Offset(5), "champion": Offset(10)})
    assert G.verdict(judged, True).first()["promote"]
    bad = holdout.withColumn("pm25", F.when(F.col("i") == 0, 5000.0).otherwise(F.col("pm25")))
    skipped = decide(bad, {"candidate": Offset(5), "champion": Offset(10)}).orderBy("pos").collect()
    assert [r["status"] for r in skipped] == [G.FAILS, G.SKIPPED, G.SKIPPED]
    limits = decide(holdout, {"candidate": Offset(50)}, limits=True).orderBy("pos").collect()
    assert [r["status"] for r in limits] == [G.PASSES, G.PASSES, G.PASSES, G.FAILS]


@pytest.fixture
def ledger(spark, tmp_path):
    out = Ledger(spark, str(tmp_path / "ledger"))
    out.register("m", "1", "10", dt.datetime(2024, 1, 1))
    out.register("m", "2", "5", dt.datetime(2024, 1, 2))
    out.set_alias("m", "candidate", "2", dt.datetime(2024, 1, 2))
    return out


def load(uri):
    return Offset(float(uri))


def test_better_candidate_moves_the_alias(ledger, holdout):
    ledger.set_alias("m", "champion", "1", dt.datetime(2024, 1, 3))
    done = promote(holdout, ledger, "m", load=load, moment=dt.datetime(2024, 1, 4))
    assert done.promoted and ledger.version_of("m", "champion") == "2"
    assert ledger.tags_of("m", "2")["validation_status"] == "passed"
    ledger.set_alias("m", "champion", "1", dt.datetime(2024, 1, 5))  # rollback
    assert ledger.version_of("m", "champion") == "1"


def test_worse_candidate_leaves_evidence_only(ledger, holdout):
    ledger.register("m", "3", "12", dt.datetime(2024, 1, 3))
    ledger.set_alias("m", "champion", "1", dt.datetime(2024, 1, 3))
    done = promote(holdout, ledger, "m", version="3", load=load, moment=dt.datetime(2024, 1, 4))
    assert not done.promoted and ledger.version_of("m", "champion") == "1"
    assert ledger.tags_of("m", "3")["validation_status"] == "failed"
    assert ledger.latest_version("m") == "3"


def test_dry_run_writes_nothing(ledger, holdout):
    before = ledger.events().count()
    done = promote(holdout, ledger, "m", load=load, dry_run=True)
    assert done.verdict.first()["promote"] and not done.promoted
    assert ledger.events().count() == before


def test_first_model_is_promoted(ledger, holdout):
    done = promote(holdout, ledger, "m", load=load)
    assert done.promoted and done.champion_version is None
    assert ledger.tags_of("m", "2")["gate_motivo"] == G.REASON_FIRST


def test_unreadable_ledger_is_not_a_missing_champion(spark, tmp_path, holdout):
    path = tmp_path / "broken"
    path.mkdir()
    (path / "_SUCCESS").write_text("")
    (path / "part-0.parquet").write_text("no parquet")
    broken = Ledger(spark, str(path))
    with pytest.raises(Exception) as error:
        promote(holdout, broken, "m", load=load)
    assert not isinstance(error.value, UnknownAlias)
    assert issubclass(RegistryUnavailable, RuntimeError)


def test_retraining(spark, tmp_path):
    assert should_retrain("a", None) and should_retrain("a", "a", forced=True)
    assert not should_retrain("a", "a") and should_retrain("b", "a")
    ledger = Ledger(spark, str(tmp_path / "state"))
    assert ledger.load_state("d") is None
    ledger.save_state("d", "a", dt.datetime(2024, 1, 1))
    ledger.save_state("d", "b", dt.datetime(2024, 1, 2))
    assert ledger.load_state("d") == "b"
    assert current_state(ledger.events(), "state").count() == 1


def test_beating_the_baseline(spark):
    def table(base, forest):
        return spark.createDataFrame([("baseline", base), ("bosque", forest)], "model string, mae double")

    assert E.require_gain(table(30.0, 16.0), "baseline", "bosque") == pytest.approx(14 / 30)
    with pytest.raises(E.NotBetter):
        E.require_gain(table(30.0, 31.0), "baseline", "bosque")
    with pytest.raises(KeyError):
        E.require_gain(table(30.0, None), "baseline", "bosque")


def test_worst_entity_and_maps(spark, monkeypatch):
    df = spark.createDataFrame(
        [("a", 1.0, 2.0), ("b", 1.0, 4.0), ("b", 1.0, 2.0)], "station string, pm25 double, prediction double"
    )
    per = E.entity_metrics(df)
    assert E.worst_entity(per).first()["station"] == "b"
    assert E.as_maps(per, "station", "mae").first()["values"] == {"a": 1.0, "b": 2.0}
    monkeypatch.setattr(E, "MAX_MAP", 1)
    with pytest.raises(Exception, match="more than 1 keys"):
        E.as_maps(per, "station", "mae").collect()


def test_one_pass_metrics_agree_with_separate_ones(spark):
    rows = [(f"s{i % 3}", "a" if i % 2 else "b", i % 24, 1e9 + i % 17, 1e9 + (i * 7) % 19) for i in range(400)]
    df = spark.createDataFrame(
        rows, "station string, temporada string, hora int, pm25 double, prediction double"
    ).withColumn("split", F.lit("x"))
    want = E.global_metrics(df).first()
    total, groups = E.split_measures(E.measure(df))
    split_total, per_entity = E.measure_entities(df, "split")
    for got in (total.first(), split_total.first()):
        for name in ("n", "mae", "rmse", "r2"):
            # A mean near 1e9 is known to about 1e-7, so both sides carry some 1e-8.
            assert got[name] == pytest.approx(want[name], rel=1e-7)
    assert sorted(map(tuple, groups.select("axis", "grp", "n").collect())) == sorted(
        map(tuple, E.subgroup_metrics(df).select("axis", "grp", "n").collect())
    )
    worst = E.worst_entity(E.entity_metrics(df)).first()["mae"]
    assert split_total.first()["worst_entity_mae"] == pytest.approx(worst)
    assert per_entity.count() == 3
