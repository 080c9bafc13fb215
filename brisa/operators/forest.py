"""Regressors: the mean baseline and the random forest, as Spark ML pipelines."""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa import spec as S
from brisa.operators.metrics import PREDICTION, entity_metrics, global_metrics, worst_entity
from brisa.operators.prepare import Fill, fit_medians, sample_rows

# --- fixed values -----------------------------------------------------------
FOREST_DEFAULTS = {"numTrees": 300, "minInstancesPerNode": 3, "maxDepth": 15}
# Search space: lowest and highest value of every parameter. Spark ML has no
# minimum size for splitting a node, so that dimension is not searched, and its
# trees are at most 30 deep.
SEARCH_SPACE = {
    "numTrees": (int, 100, 500),
    "maxDepth": (int, 5, 30),
    "minInstancesPerNode": (int, 1, 10),
    "featureShare": (float, 0.3, 1.0),
}
TRIALS = 20
# ----------------------------------------------------------------------------


FEATURES = "features"
#: Memory for the counts of the nodes that are split in one pass over the rows: passes
#: are what growing many trees takes time for.
NODE_MEMORY_MB = 1_024
#: Most levels of a categorical that is one-hot encoded.
MAX_LEVELS = 10_000


@dataclass(frozen=True)
class Baseline:
    """Predicts the mean target of its training rows."""

    mean: float

    @staticmethod
    def fit(train: DataFrame, target: str = S.TARGET) -> Baseline:
        return Baseline(train.agg(F.avg(target).alias("m")).first()["m"])

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PREDICTION, F.lit(self.mean))


@dataclass(frozen=True)
class Imputed:
    """A fitted pipeline behind the fills learned from the same training rows."""

    numeric: Fill
    categorical: Fill
    pipeline: PipelineModel
    numeric_features: tuple[str, ...]

    def prepare(self, df: DataFrame) -> DataFrame:
        typed = df.withColumns({f"__n_{c}": F.coalesce(F.col(c).cast("double"), F.lit(self.numeric.values[c])) for c in self.numeric_features})
        return typed.withColumns(
            {f"__c_{c}": F.coalesce(F.col(c).cast("string"), F.lit(v)) for c, v in self.categorical.values.items()}
        )

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.pipeline.transform(self.prepare(df))
        return scored.select(*df.columns, PREDICTION)

    def encode(self, df: DataFrame) -> DataFrame:
        """Rows with their feature vector."""
        return self.pipeline.transform(self.prepare(df)).select(*df.columns, FEATURES)

    def save(self, path: str) -> None:
        """Pipeline and fills under one path."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        rows = [("n", c, None if v is None else float(v), None) for c, v in self.numeric.values.items()]
        rows += [("c", c, None, v) for c, v in self.categorical.values.items()]
        session = _session()
        session.createDataFrame(
            rows, "kind string, column string, number double, text string"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/fills")

    @staticmethod
    def load(path: str) -> Imputed:
        rows = _session().read.parquet(f"{path}/fills").collect()
        numeric = {r["column"]: r["number"] for r in rows if r["kind"] == "n"}
        categorical = {r["column"]: r["text"] for r in rows if r["kind"] == "c"}
        return Imputed(
            Fill(numeric), Fill(categorical), PipelineModel.load(f"{path}/pipeline"), tuple(numeric)
        )


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


def fit_levels(train: DataFrame, columns: list[str] | tuple[str, ...]) -> dict[str, tuple[str | None, list[str]]]:
    """Most frequent value (the smallest on a tie) and sorted levels of text columns, from one
    count of all their values. More than ``MAX_LEVELS`` of a column are an error, found on
    the counted rows before any comes to the driver."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    counted = (
        train.select(F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = counted.limit(MAX_LEVELS * len(columns) + 1).collect()
    sizes = Counter(r["column"] for r in rows)
    if large := {c: f"{n} or more" for c, n in sizes.items() if n > MAX_LEVELS}:
        raise ValueError(f"too many levels for one-hot encoding: {large}")
    own = {c: [r for r in rows if r["column"] == c] for c in columns}
    most = {c: min(x, key=lambda r: (-r["n"], r["value"]))["value"] if x else None for c, x in own.items()}
    return {c: (most[c], sorted(r["value"] for r in x)) for c, x in own.items()}


def encoder_stages(levels: dict[str, list[str]]) -> list:
    """Index and one-hot encode text columns of known levels.

    An unseen level falls in the dropped last slot, so its vector is all zeros while
    every seen level keeps a slot of its own.
    """
    names = list(levels)
    # A model for each column: levels of several columns in one call must be equally many.
    indexers = [
        StringIndexerModel.from_labels(levels[c], inputCol=c, outputCol=f"{c}__i", handleInvalid="keep") for c in names
    ]
    encoder = OneHotEncoder(
        inputCols=[f"{c}__i" for c in names],
        outputCols=[f"{c}__v" for c in names],
        dropLast=True,  # the indexer's slot for unseen levels
    )
    return [*indexers, encoder]


def fit_encoder(train: DataFrame, spec: S.ReadingSpec = S.READINGS) -> Imputed:
    """Fills, one-hot encoding and feature vector learned from the training rows.

    Its ``transform`` gives the vector in ``features``; every level of a categorical is
    a slot, so more than ``MAX_LEVELS`` of them are an error. Beside the medians one count
    of the text columns' values serves fills, levels and the bound.
    """
    numeric = fit_medians(train, spec.numeric_features)
    levels = fit_levels(train, spec.categorical_features)
    categorical = Fill({c: most for c, (most, _) in levels.items()})
    texts = [f"__c_{c}" for c in spec.categorical_features]
    assembler = VectorAssembler(
        inputCols=[*[f"{c}__v" for c in texts], *[f"__n_{c}" for c in spec.numeric_features]],
        outputCol=FEATURES,
    )
    unfitted = Imputed(numeric, categorical, None, tuple(spec.numeric_features))
    # The encoder takes its sizes from the indexer's levels: fitting reads no rows.
    stages = encoder_stages({f"__c_{c}": names for c, (_, names) in levels.items()})
    pipeline = Pipeline(stages=[*stages, assembler]).fit(unfitted.prepare(train))
    return Imputed(numeric, categorical, pipeline, tuple(spec.numeric_features))


def _forest(spec: S.ReadingSpec, seed: int, overrides: dict) -> RandomForestRegressor:
    settings = {**FOREST_DEFAULTS, "featureSubsetStrategy": "all", "subsamplingRate": 1.0, **overrides}
    if "featureShare" in settings:
        settings["featureSubsetStrategy"] = str(settings.pop("featureShare"))
    return RandomForestRegressor(
        featuresCol=FEATURES,
        labelCol=spec.target,
        predictionCol=PREDICTION,
        seed=seed,
        maxBins=64,
        maxMemoryInMB=NODE_MEMORY_MB,
        **settings,
    )


def _labelled(train: DataFrame, spec: S.ReadingSpec) -> DataFrame:
    """Training rows with a double target."""
    return train.withColumn(spec.target, F.col(spec.target).cast("double"))


def _grown_from(train: DataFrame, spec: S.ReadingSpec, rows: int | None, key) -> DataFrame:
    """Training rows that trees are grown from; exactly ``rows`` of them if a bound is given."""
    return train if rows is None else sample_rows(train, rows, key or spec.key)


def fit_forest(
    train: DataFrame,
    spec: S.ReadingSpec = S.READINGS,
    seed: int = S.SEED,
    *,
    rows: int | None = None,
    key: str | None = None,
    **overrides,
) -> Imputed:
    """Fit fills, encoding and forest on the training rows; overrides win.

    Fills and encoding are learned from all rows. ``rows`` bounds those that trees are
    grown from: that many are drawn by a hash of ``key`` (default: the key of the spec).
    All by default.
    """
    train = _labelled(train, spec)
    encoder = fit_encoder(train, spec)
    forest = _forest(spec, seed, overrides).fit(encoder.encode(_grown_from(train, spec, rows, key)))
    return replace(encoder, pipeline=PipelineModel([*encoder.pipeline.stages, forest]))


def draw_trials(n: int, seed: int = S.SEED, space: dict = SEARCH_SPACE) -> list[dict]:
    """Parameter sets of a seeded random search."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        out.append(
            {
                name: rng.randint(low, high) if kind is int else round(rng.uniform(low, high), 4)
                for name, (kind, low, high) in space.items()
            }
        )
    return out


def tune_forest(
    train: DataFrame,
    valid: DataFrame,
    spec: S.ReadingSpec = S.READINGS,
    trials: int = TRIALS,
    seed: int = S.SEED,
    space: dict = SEARCH_SPACE,
    parallel: int = 2,
    *,
    rows: int | None = None,
    key: str | None = None,
) -> DataFrame:
    """One row per trial with its parameters and its error on the later rows, the worst
    entity's too.

    Fills and encoding are fitted once and both tables' vectors kept for all trials; a
    trial only grows its forest. Trials are whole Spark jobs; a few are kept in flight
    at a time. ``valid`` is the judge; the test partition plays no part. ``rows`` and
    ``key`` bound the rows that trees are grown from as in ``fit_forest``.
    """
    train = _labelled(train, spec)
    encoder = fit_encoder(train, spec)
    seen = encoder.encode(_grown_from(train, spec, rows, key)).select(FEATURES, spec.target).persist()
    later = encoder.encode(valid).select(FEATURES, spec.entity, F.col(spec.target).cast("double")).persist()
    proposals = draw_trials(trials, seed, space)

    def run(i: int) -> tuple:
        scored = _forest(spec, seed, proposals[i]).fit(seen).transform(later)
        row = global_metrics(scored, target=spec.target).first()
        worst = worst_entity(entity_metrics(scored, spec), spec).first()["mae"]
        return (i, *[proposals[i][p] for p in space], row["n"], row["mae"], row["rmse"], row["r2"], worst)

    try:
        with ThreadPoolExecutor(parallel) as pool:
            found = list(pool.map(run, range(trials)))
    finally:
        seen.unpersist()
        later.unpersist()
    kinds = {int: "bigint", float: "double"}
    measures = ["n bigint", *[f"{m} double" for m in TRIAL_MEASURES]]
    schema = ", ".join(["trial bigint", *[f"{p} {kinds[k]}" for p, (k, _, _) in space.items()], *measures])
    return train.sparkSession.createDataFrame(found, schema)


#: Rungs of successive halving: trials that enter one, and rows that their trees are grown
#: from. The last ones see as many rows as the search's models are trained on.
RUNGS = ((TRIALS, 1_500), (7, 8_000), (2, 50_000))


def halve_forest(
    train: DataFrame,
    valid: DataFrame,
    spec: S.ReadingSpec = S.READINGS,
    rungs: tuple[tuple[int, int], ...] = RUNGS,
    seed: int = S.SEED,
    space: dict = SEARCH_SPACE,
    parallel: int = 2,
    *,
    key: str | None = None,
) -> DataFrame:
    """The search of ``tune_forest`` by successive halving: one row per rung and trial with
    (rung, trial, parameters, rows, n, errors, kept).

    All trials grow their forests from a small sample; of each rung the best by ``mae``
    (then by number) go on and are grown again from more rows. Samples are drawn by a hash
    of the key, so a rung's rows are among the next one's. ``rows`` is how many there were
    (all, where there are fewer), ``n`` the rows of ``valid`` that judge, ``kept`` whether
    the trial went on; in the last rung that is the best one. Fills, levels and the largest
    sample's vectors are made once.
    """
    train = _labelled(train, spec)
    keys = list(spec.key) if key is None else [key]
    encoder = fit_encoder(train, spec)
    largest = _grown_from(train, spec, max(rows for _, rows in rungs), key)
    grown = encoder.encode(largest).select(FEATURES, spec.target, *keys).persist()
    later = encoder.encode(valid).select(FEATURES, spec.entity, F.col(spec.target).cast("double")).persist()
    proposals = draw_trials(rungs[0][0], seed, space)

    def run(i: int, seen: DataFrame) -> tuple:
        scored = _forest(spec, seed, proposals[i]).fit(seen).transform(later)
        row = global_metrics(scored, target=spec.target).first()
        worst = worst_entity(entity_metrics(scored, spec), spec).first()["mae"]
        return (i, *[proposals[i][p] for p in space], row["n"], row["mae"], row["rmse"], row["r2"], worst)

    found, alive = [], list(range(len(proposals)))
    try:
        for rung, (_, rows) in enumerate(rungs):
            seen = sample_rows(grown, rows, keys).select(FEATURES, spec.target).persist()
            try:
                n_rows = seen.count()
                with ThreadPoolExecutor(parallel) as pool:
                    told = list(pool.map(lambda i, s=seen: run(i, s), alive))
            finally:
                seen.unpersist()
            mae = len(space) + 2
            ranked = [t[0] for t in sorted(told, key=lambda t: (t[mae], t[0]))]
            kept = set(ranked[: rungs[rung + 1][0] if rung + 1 < len(rungs) else 1])
            width = len(space) + 1
            found += [(rung, *t[:width], n_rows, *t[width:], t[0] in kept) for t in told]
            alive = sorted(kept)
    finally:
        grown.unpersist()
        later.unpersist()
    kinds = {int: "bigint", float: "double"}
    parameters = [f"{p} {kinds[k]}" for p, (k, _, _) in space.items()]
    measures = ["n bigint", *[f"{m} double" for m in TRIAL_MEASURES]]
    schema = ", ".join(["rung bigint", "trial bigint", *parameters, "rows bigint", *measures, "kept boolean"])
    return train.sparkSession.createDataFrame(found, schema)


def best_of_rungs(trials: DataFrame) -> dict:
    """The parameters that the last rung kept."""
    best = trials.where("kept").orderBy(F.desc("rung")).first().asDict()
    return {k: v for k, v in best.items() if k not in ("rung", "trial", "rows", "n", "kept", *TRIAL_MEASURES)}


#: Errors of a trial.
TRIAL_MEASURES = ("mae", "rmse", "r2", "worst_entity_mae")


def best_trial(trials: DataFrame) -> dict:
    best = trials.orderBy("mae", "trial").first().asDict()
    return {k: v for k, v in best.items() if k not in ("trial", "n", *TRIAL_MEASURES)}


def predict_with(
    df: DataFrame, model_loader: Callable, features: list[str], name: str = PREDICTION
) -> DataFrame:
    """Score with any object that has ``predict(frame)``, batch by Arrow batch.

    ``model_loader`` runs once per task, so the model need not travel in every
    closure.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_loader()
        for batch in batches:
            yield batch.assign(**{name: model.predict(batch[features])})

    return df.mapInPandas(score, schema)
