"""Snapshots bucketed by key: work per key needs no exchange.

A bucket holds all rows of its keys, sorted. Grouping by the bucketing columns, with or
without more, and joins between tables of as many buckets then read a bucket a task and
move nothing. A bucket is as large as its keys: with an entity that holds a large part of
all rows, bucket by entity and month, which cuts it and still serves every grouping that
names both.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NOTE = "_bucketing"  # readers pass over names that begin with an underscore


def _name(path: str) -> str:
    return "brisa_bucketed_" + hashlib.sha256(path.encode()).hexdigest()[:16]


def write_bucketed(df: DataFrame, path: str, by: list[str], order: list[str] | None = None, buckets: int = 64) -> DataFrame:
    """Write ``df`` below ``path`` in ``buckets`` buckets of the columns ``by``, every one
    sorted by ``order`` (by default the same columns), and open it. One shuffle; a bucket
    is one file. A table that was there is replaced."""
    spark, order = df.sparkSession, order or by
    name = _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.repartition(buckets, *[F.col(f"`{c}`") for c in by]).write.mode("overwrite").format("parquet")
    writer.option("path", path).bucketBy(buckets, *by).sortBy(*order).saveAsTable(name)
    note = json.dumps({"by": by, "order": order, "buckets": buckets})
    spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{_NOTE}")
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_bucketed``, also in another session: its buckets are registered
    in the session's catalog from the note beside the data."""
    note = json.loads(spark.read.text(f"{path}/{_NOTE}").first().value)
    schema = spark.read.parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by, order = (", ".join(f"`{c}`" for c in note[k]) for k in ("by", "order"))
    name = _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({order}) "
        f"INTO {note['buckets']} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
