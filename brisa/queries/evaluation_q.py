"""Queries over metrics, gate, modelling, scoring."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from brisa.operators import gate as G
from brisa.operators import metrics as E
from brisa import spec as S
from brisa.operators.features import build_features
from brisa.operators.forest import (
    RUNGS,
    SEARCH_SPACE,
    TRIALS,
    Imputed,
    draw_trials,
    fit_encoder,
    fit_forest,
    halve_forest,
    predict_with,
    tune_forest,
)
from brisa.operators.partitions import slice_label
from brisa.operators.prepare import prepare_partition
from brisa.plans.promotion import decide, promote
from brisa.plans.scoring import batch_score
from brisa.plans.training import train_and_evaluate, training_flow
from brisa.queries import models as M
from brisa.queries import tables as Q
from brisa.queries.registry import query
from brisa.session import scratch_path
from brisa.sources.ledger import Ledger
from brisa.sources.readings import fingerprint

_M = f"WITH {Q.models_sql('test')}, {Q.STACKED}"
_ERR = "abs(pm25 - prediction)"
_WIDE = (
    "w AS (SELECT model, count(*) AS n, avg(abs(pm25 - prediction)) AS mae, "
    "sqrt(avg((pm25 - prediction) * (pm25 - prediction))) AS rmse, "
    "1 - sum((pm25 - prediction) * (pm25 - prediction)) / (var_pop(pm25) * count(*)) AS r2 FROM m GROUP BY model)"
)
_GROUPS = (
    f"sg AS (SELECT model, 'temporada' AS axis, temporada AS grp, avg({_ERR}) AS mae, count(*) AS n FROM m GROUP BY 1, 3 "
    f"HAVING count(*) >= 50 UNION ALL SELECT model, 'hora', {Q.band_sql('hora')} AS grp, avg({_ERR}), count(*) FROM m "
    "GROUP BY 1, 3 HAVING count(*) >= 50)"
)


def _round(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "metrics_global",
    f"{_M}, {_WIDE} SELECT model, n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2 FROM w",
)
def metrics_global(spark, sf_dir):
    return _round(E.global_metrics(M.stacked(spark, sf_dir), ["model"]), "mae", "rmse", "r2")


@query(
    "mae_by_entity",
    f"{_M} SELECT model, station, round(avg({_ERR}), 6) AS mae, count(*) AS n FROM m GROUP BY model, station",
)
def mae_by_entity(spark, sf_dir):
    rows = E.entity_metrics(M.stacked(spark, sf_dir), Q.EVENTS, ["model"])
    return _round(rows, "mae").orderBy("model", "station")


@query(
    "mae_by_entity_map",
    f"{_M} SELECT model, station, round(avg({_ERR}), 6) AS mae FROM m GROUP BY model, station",
)
def mae_by_entity_map(spark, sf_dir):
    rows = _round(E.entity_metrics(M.stacked(spark, sf_dir), Q.EVENTS, ["model"]), "mae")
    maps = E.as_maps(rows, "station", "mae", ["model"])
    return maps.select("model", F.explode("values").alias("station", "mae"))


@query(
    "worst_entity",
    f"{_M}, e2 AS (SELECT model, station, avg({_ERR}) AS mae FROM m GROUP BY model, station), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY mae DESC, station) AS rn FROM e2) "
    "SELECT model, station, round(mae, 6) AS mae FROM k WHERE rn = 1",
)
def worst_entity(spark, sf_dir):
    per_entity = E.entity_metrics(M.stacked(spark, sf_dir), Q.EVENTS, ["model"])
    return _round(E.worst_entity(per_entity, Q.EVENTS, ["model"]), "mae")


@query(
    "metrics_by_subgroup",
    f"{_M}, {_GROUPS} SELECT model, axis, grp, round(mae, 6) AS mae, n FROM sg",
)
def metrics_by_subgroup(spark, sf_dir):
    return _round(E.subgroup_metrics(M.stacked(spark, sf_dir), ["model"]), "mae")


@query(
    "evaluate_models",
    f"{_M}, {_WIDE}, {_GROUPS}, u AS (SELECT model, 'global' AS axis, 'all' AS grp, 'mae' AS metric, mae AS value FROM w "
    "UNION ALL SELECT model, 'global', 'all', 'rmse', rmse FROM w UNION ALL SELECT model, 'global', 'all', 'r2', r2 FROM w "
    "UNION ALL SELECT model, axis, grp, 'mae', mae FROM sg UNION ALL SELECT model, axis, grp, 'n', CAST(n AS DOUBLE) FROM sg) "
    "SELECT model, axis, grp, metric, round(value, 6) AS value FROM u",
)
def evaluate_models(spark, sf_dir):
    return _round(E.evaluate(M.stacked(spark, sf_dir), Q.EVENTS, ["model"]), "value")


@query(
    "beat_baseline",
    f"{_M}, {_WIDE}, p AS (SELECT max(mae) FILTER (model = 'champion') AS baseline, max(mae) FILTER (model = 'candidate') AS candidate FROM w) "
    "SELECT round(baseline, 6) AS baseline, round(candidate, 6) AS candidate, candidate < baseline AS beats, "
    "round((baseline - candidate) / baseline, 6) + 0.0e0 AS gain FROM p",
)
def beat_baseline(spark, sf_dir):
    metrics = E.global_metrics(M.stacked(spark, sf_dir), ["model"])
    row = E.gain_over_baseline(metrics, "champion", "candidate")
    return _round(row, "baseline", "candidate").withColumn("gain", F.round("gain", 6) + 0.0)


# --- gate ----------------------------------------------------------------------

_PAIR = "pr AS (SELECT max(mae) FILTER (model = 'candidate') AS new, max(mae) FILTER (model = 'champion') AS base FROM w)"
_CHANGE = (
    "ch AS (SELECT a.axis, a.grp, a.mae AS new, b.mae AS base, (a.mae - b.mae) / b.mae AS change FROM sg a JOIN sg b "
    "ON a.axis = b.axis AND a.grp = b.grp WHERE a.model = 'candidate' AND b.model = 'champion' AND b.mae <> 0)"
)


@query(
    "gate_global",
    f"{_M}, {_WIDE}, {_PAIR} SELECT 'mejora_global' AS criterion, new <= base * (1.0e0 - 0.01e0) AS passed FROM pr",
)
def gate_global(spark, sf_dir):
    metrics = E.global_metrics(M.stacked(spark, sf_dir), ["model"])
    return G.global_criterion(metrics, "candidate", "champion").select("criterion", "passed")


@query(
    "gate_subgroups",
    f"{_M}, {_GROUPS}, {_CHANGE} SELECT count(*) AS n_groups, count(*) FILTER (change > 0.05) AS n_worse, "
    "(SELECT concat('mae_', axis, '_', grp) FROM ch ORDER BY change DESC, concat('mae_', axis, '_', grp) LIMIT 1) AS worst, "
    "round(max(change), 6) + 0.0e0 AS worst_change, count(*) > 0 AND count(*) FILTER (change > 0.05) = 0 AS passed FROM ch",
)
def gate_subgroups(spark, sf_dir):
    groups = E.subgroup_metrics(M.stacked(spark, sf_dir), ["model"])
    row = G.group_verdict(G.compare_groups(groups, "candidate", "champion"))
    return row.withColumn("worst_change", F.round("worst_change", 6) + 0.0)


@query(
    "gate_limits",
    f"{_M}, {_WIDE} SELECT 'limites_absolutos' AS criterion, max(mae) <= 45 AND max(r2) >= 0 AS passed FROM w WHERE model = 'candidate'",
)
def gate_limits(spark, sf_dir):
    metrics = E.global_metrics(M.stacked(spark, sf_dir), ["model"])
    return G.limit_criterion(metrics, "candidate").select("criterion", "passed")


_DECISION = (
    f"{_PAIR}, {_CHANGE}, c AS (SELECT 1 AS pos, 'contrato_de_datos' AS criterion, TRUE AS passed UNION ALL "
    "SELECT 2, 'mejora_global', new <= base * (1.0e0 - 0.01e0) FROM pr UNION ALL "
    "SELECT 3, 'sin_regresion_por_subgrupo', count(*) > 0 AND count(*) FILTER (change > 0.05) = 0 FROM ch)"
)


@query(
    "gate_decision",
    f"{_M}, {_WIDE}, {_GROUPS}, {_DECISION}, v AS (SELECT bool_and(passed) AS promote, "
    "string_agg(criterion, ', ' ORDER BY pos) FILTER (NOT passed) AS failed FROM c) "
    "SELECT promote, FALSE AS first_model, CASE WHEN promote THEN 'todos los criterios pasan' ELSE "
    "concat('criterios no superados: ', failed) END AS reason, CASE WHEN promote THEN 'passed' ELSE 'failed' END AS validation_status FROM v",
)
def gate_decision(spark, sf_dir):
    """The holdout keeps its contract; both models are scored on it."""
    holdout = M.prepared(spark, sf_dir, "test", validate=True)
    criteria = decide(holdout, M.fitted(spark, sf_dir), Q.EVENTS)
    return G.verdict(criteria, has_champion=True)


_EVENT = "SELECT 'pm25' AS subject, {v} AS version, '{kind}' AS kind, {key} AS key, {value} AS value, TIMESTAMP '{ts}' AS ts"


def _event(version: str, kind: str, key: str, value: str, ts: str) -> str:
    return _EVENT.format(v=f"'{version}'", kind=kind, key=f"'{key}'", value=value, ts=ts)


@query(
    "gate_end_to_end",
    f"{_M}, {_WIDE}, {_GROUPS}, {_DECISION}, v AS (SELECT bool_and(passed) AS promote, "
    "string_agg(criterion, ', ' ORDER BY pos) FILTER (NOT passed) AS failed FROM c) "
    + " UNION ALL ".join(
        [
            _event("1", "version", "1", "'champion'", "2024-02-01 01:00:00"),
            _event("2", "version", "2", "'candidate'", "2024-02-01 02:00:00"),
            _event("1", "alias", "candidate", "'1'", "2024-02-02 01:00:00"),
            _event("1", "tag", "1/validation_status", "'passed'", "2024-02-02 01:00:00"),
            _event("1", "tag", "1/gate_motivo", "'primer modelo: no hay champion con el que comparar'", "2024-02-02 01:00:00"),
            _event("1", "alias", "champion", "'1'", "2024-02-02 01:00:00"),
            _event("2", "alias", "candidate", "'2'", "2024-02-02 02:00:00"),
            _event("2", "tag", "2/validation_status", "CASE WHEN promote THEN 'passed' ELSE 'failed' END", "2024-02-02 02:00:00") + " FROM v",
            _event("2", "tag", "2/gate_motivo", "CASE WHEN promote THEN 'todos los criterios pasan' "
                   "ELSE concat('criterios no superados: ', failed) END", "2024-02-02 02:00:00") + " FROM v",
            _event("2", "alias", "champion", "'2'", "2024-02-02 02:00:00") + " FROM v WHERE promote",
        ]
    ),
)
def gate_end_to_end(spark, sf_dir):
    """Register two models, promote the first, then put the second through the gate."""
    ledger = Ledger(spark, scratch_path(spark, "registry"))
    models = M.fitted(spark, sf_dir)
    for version, name in (("1", "champion"), ("2", "candidate")):
        ledger.register("pm25", version, name, dt.datetime(2024, 2, 1, int(version)))
    holdout = M.prepared(spark, sf_dir, "test", validate=True)
    for version in ("1", "2"):
        moment = dt.datetime(2024, 2, 2, int(version))
        ledger.set_alias("pm25", "candidate", version, moment)
        promote(holdout, ledger, "pm25", Q.EVENTS, load=models.get, moment=moment)
    return ledger.events().select("subject", "version", "kind", "key", "value", "ts")


_PRINT_SQL = f"SELECT {Q.fingerprint_sql('CAST(event_id AS VARCHAR)', 'event_type')} AS fingerprint FROM events"


@query(
    "retrain_needed",
    f"WITH c AS ({_PRINT_SQL}), l AS ({_PRINT_SQL} WHERE event_type <> 'error') SELECT c.fingerprint, l.fingerprint AS recorded, "
    "c.fingerprint <> l.fingerprint AS retrain FROM c, l",
)
def retrain_needed(spark, sf_dir):
    """The recorded state lacks one event type, so the table counts as changed."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type")
    ledger = Ledger(spark, scratch_path(spark, "state"))
    before = fingerprint(events.filter(F.col("event_type") != "error")).first()["fingerprint"]
    ledger.save_state("events", before)
    last = spark.range(1).select(F.lit(ledger.load_state("events")).alias("fingerprint"))
    return G.retrain_needed(fingerprint(events), last)


# --- models --------------------------------------------------------------------


_LINE_NUMBERS = (*Q.LINE_SPEC.measures, "hora", "dia_semana", "mes")
_LINE_LEVELS = {"temporada": S.SEASONS, "flag": ("A", "N", "R", S.UNKNOWN), "l_linestatus": ("F", "O")}
_DUMMIES = ", ".join(
    f"CASE WHEN {c} = '{v}' THEN 1.0e0 ELSE 0.0e0 END AS {c}_{v}" for c, levels in _LINE_LEVELS.items() for v in sorted(levels)
)


@query(
    "one_hot",
    f"WITH {Q.L}, f AS (SELECT * REPLACE (coalesce(flag, 'desconocido') AS flag), {Q.calendar_sql('l_shipdate')} FROM l), "
    f"t AS (SELECT * FROM f WHERE {Q.range_sql(Q.LINE_SPEC.ranges[0], 'l_shipdate')}), "
    "m AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in _LINE_NUMBERS) + " FROM t) "
    f"SELECT l_orderkey, l_linenumber, {_DUMMIES}, "
    + ", ".join(f"round(coalesce(CAST({c} AS DOUBLE), m_{c}), 6) AS {c}" for c in _LINE_NUMBERS)
    + f" FROM f, m WHERE {Q.range_sql(Q.LINE_SPEC.ranges[3], 'l_shipdate')}",
)
def one_hot(spark, sf_dir):
    """The whole feature vector: imputed, encoded, numbers passed through. Fitted on
    train, applied to production, where flag X was never seen and is all zeros."""
    from pyspark.ml.functions import vector_to_array

    built = build_features(Q.lines(spark, sf_dir), Q.LINE_SPEC)
    train = slice_label(built, "train", Q.LINE_SPEC.ranges, "l_shipdate")
    later = slice_label(built, "produccion", Q.LINE_SPEC.ranges, "l_shipdate")
    encoder = fit_encoder(train, Q.LINE_SPEC)
    rows = encoder.encode(later).select("l_orderkey", "l_linenumber", vector_to_array("features").alias("x"))
    names = [f"{c}_{v}" for c, levels in _LINE_LEVELS.items() for v in sorted(levels)]
    cells = [F.col("x")[i].alias(n) for i, n in enumerate(names)]
    numbers = [F.round(F.col("x")[len(names) + i], 6).alias(c) for i, c in enumerate(_LINE_NUMBERS)]
    return rows.select("l_orderkey", "l_linenumber", *cells, *numbers)


# Bounds on the rows that trees are grown from here, drawn by a hash of event_id; fills and levels come from all.
FIT_ROWS = 500
TOLD_ROWS = 3_000
SEARCH_ROWS = 150


# The search's space with fewer and lower trees, so that the last rung's 50,000 rows are soon grown from.
_SMALL_TREES = {**SEARCH_SPACE, "numTrees": (int, 5, 20), "maxDepth": (int, 5, 12)}


@query(
    "forest_predict",
    f"WITH {Q.R}, {Q.prepared_sql('test')} SELECT event_id, station, pm25, TRUE AS in_train_range, TRUE AS same_when_loaded FROM p_test",
)
def forest_predict(spark, sf_dir):
    """Fit, save, load, and score the test partition with both; a forest's mean of train
    targets cannot leave their range."""
    train = M.prepared(spark, sf_dir, "train", validate=True)
    model = fit_forest(train, Q.EVENTS, rows=FIT_ROWS, key="event_id")
    path = scratch_path(spark, "forest")
    model.save(path)
    low, high = train.agg(F.min("pm25"), F.max("pm25")).first()
    test = M.prepared(spark, sf_dir, "test").select("event_id", "pm25", *Q.EVENTS.features)
    scored = model.transform(test).withColumnRenamed(E.PREDICTION, "before")
    scored = Imputed.load(path).transform(scored)
    return scored.select(
        "event_id",
        "station",
        "pm25",
        F.col(E.PREDICTION).between(low, high).alias("in_train_range"),
        (F.col(E.PREDICTION) == F.col("before")).alias("same_when_loaded"),
    )


_BOUNDED = "CASE WHEN model = 'baseline' THEN round({0}, 6) END AS {0}"


@query(
    "train_evaluate",
    f"WITH {Q.R}, {Q.prepared_sql('train')}, {Q.prepared_sql('valid')}, {Q.prepared_sql('test')}, "
    "x AS (SELECT 'valid' AS split, station, pm25 FROM p_valid UNION ALL SELECT 'test', station, pm25 FROM p_test), "
    "g AS (SELECT avg(pm25) AS mean FROM p_train), "
    "w AS (SELECT split, count(*) AS n, avg(abs(pm25 - mean)) AS mae, sqrt(avg((pm25 - mean) * (pm25 - mean))) AS rmse, "
    "1 - sum((pm25 - mean) * (pm25 - mean)) / (var_pop(pm25) * count(*)) AS r2 FROM x, g GROUP BY split), "
    "k AS (SELECT split, max(mae) AS worst_entity_mae FROM (SELECT split, station, avg(abs(pm25 - mean)) AS mae FROM x, g GROUP BY 1, 2) GROUP BY split) "
    "SELECT b.model, w.split, w.n, "
    + ", ".join(_BOUNDED.format(m) for m in ("mae", "rmse", "r2", "worst_entity_mae"))
    + ", TRUE AS sound FROM w JOIN k USING (split), (VALUES ('baseline'), ('bosque')) b(model)",
)
def train_evaluate(spark, sf_dir):
    """The baseline's errors are exact; a forest's are held to bounds: no worse than half
    as much again as the baseline's, and rmse and the worst entity not below the mean error."""
    later = {label: M.prepared(spark, sf_dir, label, validate=True) for label in ("valid", "test")}
    train = M.prepared(spark, sf_dir, "train", validate=True)
    metrics, _, _ = train_and_evaluate(train, later, Q.EVENTS, rows=FIT_ROWS, key="event_id")
    base = metrics.filter("model = 'baseline'").select("split", F.col("mae").alias("base"))
    metrics = metrics.join(F.broadcast(base), "split")  # a row for each split
    sound = F.col("mae").between(0, 1.5 * F.col("base")) & (F.col("rmse") >= F.col("mae")) & (F.col("worst_entity_mae") >= F.col("mae"))
    exact = F.col("model") == "baseline"
    measures = [F.when(exact, F.round(m, 6)).alias(m) for m in ("mae", "rmse", "r2", "worst_entity_mae")]
    return metrics.select("model", "split", "n", *measures, sound.alias("sound"))


_TRIALS_SQL = ", ".join(
    f"({i}, " + ", ".join(f"{v}e0" if isinstance(v, float) else str(v) for v in t.values()) + ")"
    for i, t in enumerate(draw_trials(TRIALS))
)


@query(
    "tune_forest",
    f"WITH {Q.R}, {Q.prepared_sql('valid')} SELECT t.*, (SELECT count(*) FROM p_valid) AS n, TRUE AS sound "
    f"FROM (VALUES {_TRIALS_SQL}) t(trial, " + ", ".join(f'"{p}"' for p in SEARCH_SPACE) + ")",
)
def tune_forest_q(spark, sf_dir):
    """The seeded search, all trials in the declared space, judged on the valid partition."""
    train, valid = (M.prepared(spark, sf_dir, label, validate=True) for label in ("train", "valid"))
    trials = tune_forest(train, valid, Q.EVENTS, parallel=4, rows=SEARCH_ROWS, key="event_id")
    spread = valid.agg(F.max("pm25") - F.min("pm25")).first()[0]
    sound = F.col("mae").between(0, spread) & (F.col("rmse") >= F.col("mae")) & (F.col("worst_entity_mae") >= F.col("mae"))
    return trials.select("trial", *SEARCH_SPACE, "n", sound.alias("sound"))


# A target that the measures tell: forests are held to it, as a mean cannot follow it.
_TOLD = "coalesce(coalesce(PM10 / 20, NO2 / 8) + 1, 1.0e0)"
_TOLD_SQL = (
    f"{Q.R}, y AS (SELECT * REPLACE ({_TOLD} AS pm25) FROM r), "
    + ", ".join(Q.clean_sql(f"p_{label}", "y", Q.slice_sql(label)) for label in ("train", "valid", "test"))
    + ", g AS (SELECT avg(pm25) AS mean FROM p_train)"
)


def _told(spark, sf_dir, label):
    rows = Q.readings(spark, sf_dir).withColumn("pm25", F.expr(_TOLD))
    return prepare_partition(rows, label, Q.EVENTS, as_of=Q.AS_OF)


@query(
    "tune_halving",
    f"WITH {_TOLD_SQL}, b AS (SELECT avg(abs(pm25 - mean)) AS mae, count(*) AS n FROM p_valid, g) "
    "SELECT CAST(rung AS BIGINT) AS rung, CAST(trials AS BIGINT) AS n_trials, least(most, (SELECT count(*) FROM p_train)) AS \"rows\", "
    "b.n, TRUE AS best_went_on, CASE WHEN rung = 2 THEN round(b.mae, 6) END AS baseline_mae, CASE WHEN rung = 2 THEN TRUE END AS below_half "
    f"FROM (VALUES {', '.join(f'({i}, {t}, {n})' for i, (t, n) in enumerate(RUNGS))}) v(rung, trials, most), b",
)
def tune_halving(spark, sf_dir):
    """Successive halving on nested samples up to 50,000 rows: who went on was best in the rung
    before, and the one that is left errs less than half as much as the mean does."""
    train, valid = (_told(spark, sf_dir, label).persist() for label in ("train", "valid"))
    try:
        trials = halve_forest(train, valid, Q.EVENTS, parallel=4, key="event_id", space=_SMALL_TREES)
        mean = train.agg(F.avg("pm25")).first()[0]
        base = valid.agg(F.avg(F.abs(F.col("pm25") - mean))).first()[0]
    finally:
        train.unpersist()
        valid.unpersist()
    place = F.row_number().over(Window.partitionBy("rung").orderBy("mae", "trial"))
    on = F.element_at(F.array(*[F.lit(n) for n in (*[t for t, _ in RUNGS[1:]], 1)]), F.col("rung").cast("int") + 1)
    entered = F.lag("kept").over(Window.partitionBy("trial").orderBy("rung"))  # a few dozen rows
    placed = trials.withColumns({"place": place, "entered": F.coalesce(entered, F.col("rung") == 0)})
    rungs = placed.groupBy("rung").agg(
        F.count("*").alias("n_trials"),
        F.max("rows").alias("rows"),
        F.max("n").alias("n"),
        F.bool_and((F.col("kept") == (F.col("place") <= on)) & F.col("entered")).alias("best_went_on"),
        F.min(F.when(F.col("kept"), F.col("mae"))).alias("mae"),
    )
    last = F.col("rung") == len(RUNGS) - 1
    return rungs.select(
        "rung", "n_trials", "rows", "n", "best_went_on",
        F.when(last, F.round(F.lit(base), 6)).alias("baseline_mae"),
        F.when(last, F.col("mae") < 0.5 * base).alias("below_half"),
    )


@query(
    "train_evaluate_told",
    f"WITH {_TOLD_SQL}, x AS (SELECT 'valid' AS split, station, pm25 FROM p_valid UNION ALL SELECT 'test', station, pm25 FROM p_test), "
    "w AS (SELECT split, count(*) AS n, round(avg(abs(pm25 - mean)), 6) AS baseline_mae FROM x, g GROUP BY split) "
    "SELECT *, TRUE AS below_half, TRUE AS explains_half, TRUE AS worst_below_baseline FROM w",
)
def train_evaluate_told(spark, sf_dir):
    """A forest on later splits of a target that the measures tell: it errs less than half as
    much as the mean, explains over half of the variance, and serves no entity worse than that."""
    later = {label: _told(spark, sf_dir, label) for label in ("valid", "test")}
    metrics, _, _ = train_and_evaluate(
        _told(spark, sf_dir, "train"), later, Q.EVENTS, rows=TOLD_ROWS, key="event_id", numTrees=60
    )
    base, forest = (metrics.where(F.col("model") == m).drop("model") for m in ("baseline", "bosque"))
    both = forest.join(base.select("split", F.col("mae").alias("base")), "split")  # a row for each split
    return both.select(
        "split", "n", F.round("base", 6).alias("baseline_mae"),
        (F.col("mae") < 0.5 * F.col("base")).alias("below_half"),
        (F.col("r2") > 0.5).alias("explains_half"),
        (F.col("worst_entity_mae") < F.col("base")).alias("worst_below_baseline"),
    )


class Doubled:
    """A model of another library: any object with ``predict(frame)``."""

    def predict(self, frame):
        return frame["CO"] * 2 + frame["hora"]


@query(
    "predict_with",
    f"WITH {Q.R}, {Q.prepared_sql('valid')} SELECT event_id, round(CO * 2 + hora, 6) AS prediction FROM p_valid",
)
def predict_with_q(spark, sf_dir):
    rows = M.prepared(spark, sf_dir, "valid").select("event_id", *Q.EVENTS.features)
    scored = predict_with(rows, Doubled, list(Q.EVENTS.features))
    return scored.select("event_id", F.round(E.PREDICTION, 6).alias("prediction"))


@query(
    "training_flow",
    "SELECT * FROM (VALUES (1, TRUE, '1', 'candidate', '1'), (2, FALSE, NULL, 'candidate', '1')) t(run, trained, version, alias, alias_version)",
)
def training_flow_q(spark, sf_dir):
    """The whole flow twice over one table: the second run finds nothing new. The target is
    made to depend on the measures, so that a forest beats the mean."""
    rows = Q.readings(spark, sf_dir)
    made = F.coalesce(F.col("PM10") / 20, F.col("NO2") / 8) + 1
    rows = rows.withColumn("pm25", F.coalesce(made, F.lit(1.0)))
    ledger, store = Ledger(spark, scratch_path(spark, "registry")), scratch_path(spark, "store")
    out = []
    for run in (1, 2):
        done = training_flow(
            rows, ledger, store, "pm25", Q.EVENTS, as_of=Q.AS_OF, rows=SEARCH_ROWS, key="event_id"
        )
        out.append((run, done.trained, done.version, "candidate", ledger.version_of("pm25", "candidate")))
    return spark.createDataFrame(out, "run int, trained boolean, version string, alias string, alias_version string")


@query(
    "batch_score",
    f"WITH {Q.R}, {Q.prepared_sql('train')}, {Q.prepared_sql('produccion')}, "
    "e AS (SELECT station, avg(pm25) AS m FROM p_train GROUP BY station), "
    "z AS (SELECT coalesce(e.m, (SELECT avg(pm25) FROM p_train)) AS p FROM p_produccion r LEFT JOIN e USING (station)) "
    "SELECT count(*) AS n_rows, round(avg(p), 3) AS mean, round(quantile_cont(p, 0.95), 3) AS p95 FROM z",
)
def batch_score_q(spark, sf_dir):
    """Champion resolved from the ledger, scored, stored, summarized from the store."""
    ledger = Ledger(spark, scratch_path(spark, "registry"))
    ledger.register("pm25", "1", "candidate")
    ledger.set_alias("pm25", "champion", "1")
    _, summary = batch_score(
        Q.readings(spark, sf_dir),
        "produccion",
        ledger,
        "pm25",
        scratch_path(spark, "predictions"),
        Q.EVENTS,
        as_of=Q.AS_OF,
        load=M.fitted(spark, sf_dir).get,
    )
    return summary
