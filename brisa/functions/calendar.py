"""Calendar columns: event time, hour, weekday, month, season, hour band."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brisa import spec as S


def event_time(year: str, month: str, day: str, hour: str) -> Column:
    """Zone-less timestamp of four integer columns; impossible dates give null."""
    return F.expr(f"try_make_timestamp_ntz(`{year}`, `{month}`, `{day}`, `{hour}`, 0, 0)")


def hour(t: Column) -> Column:
    return F.hour(t).cast("smallint")


def weekday(t: Column) -> Column:
    """Monday is 0."""
    return F.weekday(t).cast("smallint")


def month(t: Column) -> Column:
    return F.month(t).cast("smallint")


def season(t: Column) -> Column:
    """Season of a timestamp; a null time keeps a null season."""
    m = F.month(t)
    chain = F.when(m.isNull(), F.lit(None).cast("string"))
    for name, months in S.SEASON_MONTHS.items():
        chain = chain.when(m.isin(*months), F.lit(name))
    return chain.otherwise(F.lit(S.LAST_SEASON))


def hour_band(h: Column) -> Column:
    """Band of an hour number; anything else is its own band."""
    chain = None
    for name, (first, last) in S.HOUR_BANDS.items():
        hit = h.between(first, last)
        chain = F.when(hit, F.lit(name)) if chain is None else chain.when(hit, F.lit(name))
    return chain.otherwise(F.lit(S.OTHER_BAND))


def month_start(t: Column) -> Column:
    """First day of the month, the key of all monthly series."""
    return F.trunc(t, "month")
