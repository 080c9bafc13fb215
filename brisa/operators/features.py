"""The feature builder and the ordered feature projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa import spec as S
from brisa.functions import calendar as C
from brisa.functions.values import known


def build_features(df: DataFrame, spec: S.ReadingSpec = S.READINGS) -> DataFrame:
    """Fill null categoricals and derive season, hour, weekday and month.

    Idempotent: every derived column depends on the event time alone.
    """
    S.require_columns(df.columns, spec.required)
    t = F.col(spec.time)
    filled = {c: known(F.col(c).cast("string")) for c in spec.categoricals}
    derived = {
        S.SEASON: C.season(t),
        S.HOUR: C.hour(t),
        S.WEEKDAY: C.weekday(t),
        S.MONTH: C.month(t),
    }
    return df.withColumns({**filled, **derived})


def select_features(df: DataFrame, spec: S.ReadingSpec = S.READINGS) -> DataFrame:
    """Features in their fixed order, then the target as a double."""
    S.require_columns(df.columns, (*spec.features, spec.target))
    return df.select(*spec.features, F.col(spec.target).cast("double").alias(spec.target))
