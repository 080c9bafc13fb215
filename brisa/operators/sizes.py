"""Checks of size that decide between a direct plan and a distributed one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which one task may hold or sort a whole input.
DIRECT_ROWS = 200_000
#: Rows up to which a table may be broadcast.
BROADCAST_ROWS = 200_000

DIRECT_ROWS_KEY = "brisa.directRows"
BROADCAST_ROWS_KEY = "brisa.broadcastRows"


def direct_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(DIRECT_ROWS_KEY, str(DIRECT_ROWS)))


def fits(df: DataFrame, limit: int) -> bool:
    """Whether a table has at most ``limit`` rows.

    A plain count: it is combined map-side and often answered from file footers,
    while a limit would gather rows in one task first.
    """
    return df.count() <= limit


def join_checked(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that broadcasts ``right`` only when its counted size allows it.

    Beyond the bound it is a plain shuffle join, whose skewed partitions the
    adaptive skew-join rule splits. Counting computes ``right``, so it is kept for
    the join itself; Spark evicts it when memory is needed.
    """
    right = right.persist()
    limit = int(left.sparkSession.conf.get(BROADCAST_ROWS_KEY, str(BROADCAST_ROWS)))
    if fits(right, limit):
        return left.join(F.broadcast(right), on, how)
    return left.join(right.hint("shuffle_merge"), on, how)


def join_null_safe(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner"
) -> DataFrame:
    """``join_checked`` in which null keys meet: a struct around null is no null."""

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({f"__k{i}": F.struct(F.col(k)) for i, k in enumerate(on)})

    keys = [f"__k{i}" for i in range(len(on))]
    return join_checked(keyed(left), keyed(right).drop(*on), keys, how).drop(*keys)
