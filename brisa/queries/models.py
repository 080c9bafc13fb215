"""Closed-form regressors that SQL can state too, used to check evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa import spec as S
from brisa.operators.forest import Baseline
from brisa.operators.metrics import PREDICTION, stack_models
from brisa.operators.prepare import prepare_partition
from brisa.operators.sizes import join_checked
from brisa.queries import tables as Q


@dataclass(frozen=True)
class EntityMean:
    """Predicts the train mean of the reading's entity, else the train mean."""

    means: DataFrame
    fallback: float
    entity: str

    @staticmethod
    def fit(train: DataFrame, fallback: float, spec: S.ReadingSpec = S.READINGS) -> EntityMean:
        means = train.groupBy(spec.entity).agg(F.avg(spec.target).alias("__mean"))
        return EntityMean(means, fallback, spec.entity)

    def transform(self, df: DataFrame) -> DataFrame:
        joined = join_checked(df, self.means, [self.entity], "left")
        score = F.coalesce("__mean", F.lit(self.fallback))
        return joined.select(*df.columns, score.alias(PREDICTION))


def prepared(spark: SparkSession, sf_dir: str, label: str, validate: bool = False) -> DataFrame:
    return prepare_partition(
        Q.readings(spark, sf_dir), label, Q.EVENTS, validate=validate, as_of=Q.AS_OF
    )


def fitted(spark: SparkSession, sf_dir: str) -> dict[str, object]:
    train = prepared(spark, sf_dir, "train")
    baseline = Baseline.fit(train)
    return {"champion": baseline, "candidate": EntityMean.fit(train, baseline.mean, Q.EVENTS)}


def scored(spark: SparkSession, sf_dir: str, label: str = "test") -> DataFrame:
    """A prepared partition with columns ``champion`` and ``candidate``."""
    out = prepared(spark, sf_dir, label)
    for name, model in fitted(spark, sf_dir).items():
        out = model.transform(out).withColumnRenamed(PREDICTION, name)
    return out


def stacked(spark: SparkSession, sf_dir: str, label: str = "test") -> DataFrame:
    """The same, one row per reading and model."""
    return stack_models(
        scored(spark, sf_dir, label), {"champion": "champion", "candidate": "candidate"}
    )
