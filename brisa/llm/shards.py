"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every row has a point on the ring and belongs to the shard of the next virtual node
clockwise, unless that shard is full: then it goes on to the next shard that has
room. Rows arrive in classes of falling size (powers of two) and, inside a class, by
their point, so that the last rooms are filled by the smallest rows and loads end
within the bound and a few small rows.

The ring is cut into a fixed number of cells. One aggregate gives the size of every
(class, cell); the ring walk over these bounded figures decides which cells a shard
takes whole and at which offset a cell is cut. Rows then only need their offset inside
their own small cell: no row is ever compared with a whole shard.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm.text import stored

CELLS = 4_096
VIRTUAL_NODES = 128
#: Most a shard may hold above the mean.
SLACK = 0.002


def _point(shard: int, node: int) -> int:
    return int.from_bytes(hashlib.md5(f"{shard}:{node}".encode()).digest()[:8], "big")


def ring(shards: int, nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(point, shard) of every virtual node, clockwise."""
    return sorted((_point(s, v), s) for s in range(shards) for v in range(nodes))


def walk(cells: list[tuple[int, int, int]], shards: int, slack: float, n_cells: int = CELLS):
    """Deal (class, cell, load) to shards: {(class, cell): [(offset, shard), ...]}.

    ``offset`` is where in the cell's running load the shard's share begins.
    """
    circle = ring(shards)
    points = [p for p, _ in circle]
    bound = (1 + slack) * sum(x for _, _, x in cells) / shards
    load = [0.0] * shards
    dealt = {}
    for cls, cell, size in sorted(cells, key=lambda x: (-x[0], x[1])):
        at = bisect.bisect_left(points, cell * (2**64 // n_cells))
        offset, parts, tried = 0.0, [], set()
        while offset < size and len(tried) < shards:
            shard = circle[at % len(circle)][1]
            at += 1
            if shard in tried:
                continue
            tried.add(shard)
            share = min(size - offset, max(0.0, bound - load[shard]))
            if share > 0:
                parts.append((offset, shard))
                load[shard] += share
                offset += share
        if not parts:
            parts.append((0.0, min(range(shards), key=lambda s: (load[s], s))))
        dealt[cls, cell] = parts
    return dealt


def assign(df: DataFrame, key: list[str], size: str, shards: int, slack: float = SLACK) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 inside the shard).

    ``key`` places a row on the ring and ``size`` is its load, at least 1 (null counts
    as 1). Rows alike in all key columns share a cell; any of them may go on when the
    cell is cut, so ties need no order of their own. Every other column is kept;
    columns called shard or slot are replaced. An empty table stays empty.
    """
    spark = df.sparkSession
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    names = {c: f"c{i}" for i, c in enumerate(kept)}
    load = F.greatest(F.coalesce(F.col(f"`{size}`"), F.lit(1)).cast("long"), F.lit(1))
    point = F.xxhash64(*[F.col(f"`{c}`") for c in key])
    rows = df.select(
        *[F.col(f"`{c}`").alias(n) for c, n in names.items()],
        load.alias("load"),
        point.alias("point"),
        F.floor(F.log2(load)).cast("int").alias("cls"),
        F.shiftrightunsigned(point, 64 - (CELLS.bit_length() - 1)).cast("int").alias("cell"),
    )
    rows = stored(rows, "shard-rows")
    sums = rows.groupBy("cls", "cell").agg(F.sum("load").alias("load"))
    # At most 64 classes x CELLS rows, whatever the input.
    cells = [(r.cls, r.cell, r.load) for r in sums.collect()]
    dealt = walk(cells, shards, slack)
    parts = spark.createDataFrame(
        [(c, x, [o for o, _ in p], [s for _, s in p]) for (c, x), p in dealt.items()],
        "cls int, cell int, offsets array<double>, owners array<int>",
    )
    inside = Window.partitionBy("cls", "cell").orderBy("point", *names.values())
    before = F.sum("load").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("load")
    placed = rows.join(F.broadcast(parts), ["cls", "cell"]).withColumn("before", before)
    part = F.when(F.size("owners") == 1, 1).otherwise(
        F.greatest(F.lit(1), F.size(F.filter("offsets", lambda o: o <= F.col("before"))))
    )
    placed = placed.withColumn("shard", F.element_at("owners", part)).drop("offsets", "owners")
    placed = stored(placed, "shard-placed")
    counts = placed.groupBy("shard", "cls", "cell").count()
    order = Window.partitionBy("shard").orderBy(F.desc("cls"), "cell")
    first = counts.withColumn("first", F.sum("count").over(order) - F.col("count")).drop("count")
    # At most shards x 64 x CELLS rows.
    place = Window.partitionBy("cls", "cell", "shard").orderBy("before", "point")
    done = placed.join(F.broadcast(first), ["shard", "cls", "cell"]).withColumn(
        "slot", F.col("first") + F.row_number().over(place) - 1
    )
    return done.select(*[F.col(n).alias(c) for c, n in names.items()], "shard", F.col("slot").cast("long"))
