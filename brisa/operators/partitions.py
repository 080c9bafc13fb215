"""Time partitions: slice by range, label every row, resolve a label."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa import spec as S


#: Column that a loaded snapshot has for its month folders ("yyyy-MM"). Slices prune by
#: it and drop it.
MONTH_FOLDER = "part_month"


def _covered(df: DataFrame, ranges: tuple[S.TimeSpan, ...], time: str) -> DataFrame:
    """Rows inside any of the ranges; in a snapshot only from the folders in question."""
    hit = folders = F.lit(False)
    for r in ranges:
        hit = hit | in_range(r, time)
        last = r.end - dt.timedelta(microseconds=1)
        folders = folders | F.col(MONTH_FOLDER).between(f"{r.start:%Y-%m}", f"{last:%Y-%m}")
    if MONTH_FOLDER in df.columns:
        df = df.filter(folders).drop(MONTH_FOLDER)
    return df.filter(hit)


def _ntz(moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def in_range(r: S.TimeSpan, time: str = S.TIME) -> Column:
    """Half-open literal predicate, so it reaches the file scan."""
    return (F.col(time) >= _ntz(r.start)) & (F.col(time) < _ntz(r.end))


def slice_range(df: DataFrame, r: S.TimeSpan, time: str = S.TIME) -> DataFrame:
    return _covered(df, (r,), time)


def slice_spans(df: DataFrame, spans: tuple[S.TimeSpan, ...], time: str = S.TIME) -> DataFrame:
    """Rows inside any of the spans."""
    return _covered(df, spans, time)


def label_rows(
    df: DataFrame,
    ranges: tuple[S.TimeSpan, ...] = S.RANGES,
    time: str = S.TIME,
    name: str = "particion",
) -> DataFrame:
    """Add the label of the range a row falls in; rows outside all are left out.

    The ranges are a handful of literals, so this is a narrow projection with
    pushed-down filters and needs no join.
    """
    chain = F
    for r in ranges:
        chain = chain.when(in_range(r, time), F.lit(r.label))
    return _covered(df, ranges, time).withColumn(name, chain)


def resolve(label: str, ranges: tuple[S.TimeSpan, ...] = S.RANGES) -> tuple[S.TimeSpan, ...]:
    """All ranges declared under a label."""
    found = tuple(r for r in ranges if r.label == label)
    if not found:
        raise KeyError(f"unknown partition {label!r}; valid: {sorted({r.label for r in ranges})}")
    return found


def slice_label(
    df: DataFrame, label: str, ranges: tuple[S.TimeSpan, ...] = S.RANGES, time: str = S.TIME
) -> DataFrame:
    """Rows of every range under a label, in one scan."""
    return _covered(df, resolve(label, ranges), time)
