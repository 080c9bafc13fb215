import datetime as dt

import pytest
from pyspark.sql import functions as F

from brisa import spec as S
from brisa.operators import forest as R
from brisa.operators.metrics import global_metrics
from brisa.plans.scoring import batch_score
from brisa.plans.training import train_and_evaluate, training_flow
from brisa.sources import sinks as K
from brisa.sources.ledger import Ledger

FAST = {"numTrees": 5, "maxDepth": 4}


@pytest.fixture(scope="module")
def model_frame(spark):
    i = F.col("id").cast("int")
    return spark.range(64).select(
        F.when(i % 2 == 0, "a").otherwise("b").alias("station"),
        F.when(i % 2 == 0, "N").otherwise("S").alias("wd"),
        F.when(i % 3 == 0, "invierno").otherwise("verano").alias("temporada"),
        *[(F.lit(float(p)) + i).alias(c) for p, c in enumerate(S.MEASURES)],
        (i % 24).cast("smallint").alias("hora"),
        (i % 7).cast("smallint").alias("dia_semana"),
        (i % 12 + 1).cast("smallint").alias("mes"),
        (F.lit(25.0) + i % 6).alias("pm25"),
    )


def test_forest_scores_unseen_and_missing_values(spark, model_frame, tmp_path):
    model = R.fit_forest(model_frame, **FAST)
    odd = model_frame.limit(4).withColumn("station", F.lit("new")).withColumn("CO", F.lit(None).cast("double"))
    scored = model.transform(odd)
    assert scored.filter(F.col("prediction").isNull()).count() == 0
    path = str(tmp_path / "m")
    model.save(path)
    a = sorted(r["prediction"] for r in model.transform(model_frame).collect())
    b = sorted(r["prediction"] for r in R.Imputed.load(path).transform(model_frame).collect())
    assert a == b
    assert global_metrics(model.transform(model_frame)).first()["mae"] < global_metrics(
        R.Baseline.fit(model_frame).transform(model_frame)
    ).first()["mae"]


def test_training_needs_all_frames(model_frame):
    with pytest.raises(ValueError):
        train_and_evaluate(model_frame, {"valid": model_frame, "test": None})
    metrics, entities, _ = train_and_evaluate(model_frame, {"valid": model_frame, "test": model_frame}, **FAST)
    assert {(r["model"], r["split"]) for r in metrics.collect()} == {
        (m, s) for m in ("baseline", "bosque") for s in ("valid", "test")
    }
    assert entities.count() == 8


def test_search_is_seeded_and_in_its_space(model_frame, tmp_path):
    assert R.draw_trials(5) == R.draw_trials(5) != R.draw_trials(5, seed=1)
    for t in R.draw_trials(50):
        for name, (kind, low, high) in R.SEARCH_SPACE.items():
            assert low <= t[name] <= high and isinstance(t[name], kind)
    space = {"numTrees": (int, 2, 4), "maxDepth": (int, 2, 3), "minInstancesPerNode": (int, 1, 3), "featureShare": (float, 0.3, 1.0)}
    trials = R.tune_forest(model_frame, model_frame, trials=2, space=space)
    assert trials.count() == 2 and set(R.best_trial(trials)) == set(space)
    store = str(tmp_path)
    K.append_trials(trials, store, "search", R.TRIAL_MEASURES)
    session = model_frame.sparkSession
    assert session.read.parquet(f"{store}/params").count() == 2 * len(space)
    metrics = session.read.parquet(f"{store}/metrics")
    assert metrics.count() == 2 * 4 and {r.parent_run_id for r in metrics.collect()} == {"search"}


def test_too_many_levels_are_refused(model_frame, monkeypatch):
    monkeypatch.setattr(R, "MAX_LEVELS", 1)
    with pytest.raises(ValueError, match="levels"):
        R.fit_forest(model_frame, **FAST)


class Foreign:
    def predict(self, frame):
        return frame["x"] * 2


def test_foreign_models_score_by_batch(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("x"))
    got = R.predict_with(df, lambda: Foreign(), ["x"]).orderBy("x").collect()
    assert [r["prediction"] for r in got] == [2.0 * i for i in range(10)]


def test_whole_flow(spark, tmp_path):
    from brisa.queries import tables as Q

    readings = Q.readings(spark, "/root/testdata/sf0.001").withColumn(
        "pm25", F.col("PM10") / 20 + 1
    )
    readings = readings.withColumn("pm25", F.coalesce("pm25", F.col("NO2") / 8 + 1))
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    store = str(tmp_path / "store")
    done = training_flow(readings, ledger, store, "m", Q.EVENTS, as_of=Q.AS_OF, **FAST)
    assert done.trained and done.version == "1"
    assert ledger.version_of("m", "candidate") == "1"
    assert ledger.tags_of("m", "1") == {"validation_status": "pending"}
    again = training_flow(readings, ledger, store, "m", Q.EVENTS, as_of=Q.AS_OF, **FAST)
    assert not again.trained
    assert spark.read.parquet(f"{store}/metrics").count() == 2 * 2 * 4
    assert spark.read.parquet(f"{store}/params").count() == 3
    assert spark.read.parquet(f"{store}/entities").count() == 2 * 2 * 12
    batch, summary = batch_score(
        readings, "produccion", ledger, "m", str(tmp_path / "p"), Q.EVENTS,
        alias="candidate", as_of=Q.AS_OF, moment=dt.datetime(2024, 2, 2),
    )
    assert batch.startswith("produccion-") and summary.first()["n_rows"] > 100


def test_a_bound_on_rows_leaves_fills_and_levels_whole(model_frame):
    rare = model_frame.withColumn("wd", F.when(F.col("mes") == 7, "rare").otherwise(F.col("wd")))
    whole = R.fit_encoder(rare)
    model = R.fit_forest(rare, rows=3, key="CO", **FAST)
    assert (model.numeric, model.categorical) == (whole.numeric, whole.categorical)
    for i in range(3):
        assert model.pipeline.stages[i].labels == whole.pipeline.stages[i].labels
    assert model.pipeline.stages[-1].getNumTrees == FAST["numTrees"]


def test_halving_grows_the_best_again_from_more_rows(model_frame):
    space = {"numTrees": (int, 2, 4), "maxDepth": (int, 1, 4), "minInstancesPerNode": (int, 1, 3), "featureShare": (float, 0.3, 1.0)}
    rungs = ((5, 20), (3, 40), (2, 1_000))
    trials = R.halve_forest(model_frame, model_frame, rungs=rungs, space=space, key="CO")
    rows = trials.collect()
    alive = set(range(5))
    for rung, (entered, most) in enumerate(rungs):
        own = [r for r in rows if r.rung == rung]
        assert {r.trial for r in own} == alive and len(own) == entered
        assert {r["rows"] for r in own} == {min(most, 64)} and {r.n for r in own} == {64}
        best = sorted(own, key=lambda r: (r.mae, r.trial))[: rungs[rung + 1][0] if rung < 2 else 1]
        alive = {r.trial for r in own if r.kept}
        assert alive == {r.trial for r in best}
    assert R.best_of_rungs(trials) == R.draw_trials(5, space=space)[alive.pop()]


def test_samples_of_rungs_are_nested(model_frame):
    small, large = (R.sample_rows(R.sample_rows(model_frame, 50, "CO"), n, "CO") for n in (10, 30))
    assert {r.CO for r in small.collect()} < {r.CO for r in large.collect()} < {r.CO for r in R.sample_rows(model_frame, 50, "CO").collect()}


def test_the_encoder_is_fitted_in_few_scans(spark, model_frame):
    from tests.test_prepare import scans

    train, done = scans(spark, model_frame.withColumn("wd", F.when(F.col("mes") == 3, None).otherwise(F.col("wd"))))
    encoder = R.fit_encoder(train)
    assert done() == 3  # the count and the medians, and the levels
    assert encoder.categorical.values["wd"] == "S" and list(encoder.pipeline.stages[2].labels) == ["N", "S"]
