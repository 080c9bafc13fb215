"""Mix sources to target weights along a low-discrepancy schedule.

The mix is a sequence of slots of equally many words. Slot i has the golden-ratio
point frac((i + 1/2) * phi); cumulative target shares turn the point into a source, so
that every stretch of the mix holds nearly its share of every source. The r-th slot of
a source takes the r-th block of the source's stream: its rows in hashed order, from
the start again when it is used up, cut into blocks of the slot's size. A source's
slots beyond its target are left out, missing ones follow at the end, and its last
block is cut at the target, so the words taken meet the target.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm.text import row_mark, stored, word_count, words

#: Words of a slot.
BLOCK = 256
#: Slots whose ranks are counted in one group.
_CHUNK = 65_536
#: Most sources; their sizes and targets are held by the driver.
MAX_SOURCES = 100_000
GOLDEN = (math.sqrt(5) - 1) / 2


def targets(
    sizes: dict[str | None, int], weights=(3, 1, 2), share: float = 1.5, limit: float = 2.0
) -> dict[str | None, float]:
    """Target of every source: ``share`` of all sizes by the repeating weights.

    Sources are taken by code point, null last. No target exceeds ``limit`` times its
    source's size; what that cuts off goes to the others by weight until none is above.
    """
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), list(order), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if per * weight[s] > limit * sizes[s]]
        for s in above:
            out[s] = limit * sizes[s]
            left -= out[s]
        if not above:
            out.update({s: per * weight[s] for s in open_})
            break
        open_ = [s for s in open_ if s not in out]
    return out


def hashed(key: Column, seed: str = "mix") -> Column:
    """The shuffled order of rows; null keys count as empty."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))))


def placed(
    df: DataFrame, key: str, source: str, size: Column, carry: dict[str, Column] | None = None, **rule
) -> tuple[DataFrame, DataFrame]:
    """Rows with the place of their words in their source's stream, and the sources.

    (src, cell, nth) identifies a row; ``carry`` adds narrow columns of the caller's.

    A source's running sum goes by cells of the hash: cell totals give each cell's
    start, and a row only needs the sum inside its cell. Rows with equal keys and sizes
    may swap places, which changes no figure.
    """
    spark = df.sparkSession
    order = hashed(F.col(key))
    rows = df.select(
        F.col(key).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        size.alias("size"),
        order.alias("order"),
        F.substring(order, 1, 3).alias("cell"),
        *[c.alias(n) for n, c in (carry or {}).items()],
    )
    rows = stored(rows, "mix-rows")
    totals = rows.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {r.source: r["size"] for r in totals}
    goal = targets(sizes, **rule)
    sources = spark.createDataFrame(
        [(s, i, sizes[s], float(t), int(t)) for i, (s, t) in enumerate(goal.items())],
        "source string, src int, source_size long, target double, words long",
    )
    rows = rows.join(F.broadcast(sources), rows.source.eqNullSafe(sources.source)).drop(sources.source)
    cells = rows.groupBy("src", "cell").agg(F.sum("size").alias("total"))
    run = Window.partitionBy("src").orderBy("cell")
    cells = cells.select("src", "cell", (F.sum("total").over(run) - F.col("total")).alias("base"))
    inside = Window.partitionBy("src", "cell").orderBy("order", "size")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("before", upto - F.col("size")).withColumn("nth", F.row_number().over(inside))
    rows = rows.join(cells, ["src", "cell"]).withColumn("start", F.col("base") + F.col("before"))
    return rows.drop("base", "before"), sources


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, src, rank) of the mix: the order of slots and the block each one takes."""
    spark = sources.sparkSession
    goal = sorted((r.src, r.words) for r in sources.select("src", "words").collect())
    need = [(s, -(-w // block)) for s, w in goal if w > 0]
    empty = spark.createDataFrame([], "slot long, src int, rank long")
    if not need:
        return empty
    total = sum(n for _, n in need)
    upper = np.cumsum([w for _, w in goal if w > 0], dtype="float64")
    upper /= upper[-1]
    ids = np.array([s for s, _ in need], dtype="int32")

    @F.pandas_udf("int")
    def source_of(slots: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for slot in slots:
            points = np.mod((slot.to_numpy() + 0.5) * GOLDEN, 1.0)
            yield pd.Series(ids[np.minimum(np.searchsorted(upper, points, side="right"), len(ids) - 1)])

    slots = spark.range(total).select(F.col("id").alias("slot"), source_of("id").alias("src"))
    slots = slots.withColumn("chunk", F.floor(F.col("slot") / _CHUNK))
    slots = stored(slots, "mix-slots")
    counts = slots.groupBy("src", "chunk").agg(F.count("*").alias("n"))
    run = Window.partitionBy("src").orderBy("chunk")
    first = counts.select("src", "chunk", (F.sum("n").over(run) - F.col("n")).alias("first"))
    inside = Window.partitionBy("src", "chunk").orderBy("slot")
    needs = spark.createDataFrame(need, "src int, need long")
    ranked = (
        slots.withColumn("row", F.row_number().over(inside) - 1)
        .join(first, ["src", "chunk"])
        .join(F.broadcast(needs), "src")  # at most MAX_SOURCES rows
        .withColumn("rank", F.col("first") + F.col("row"))
        .where(F.col("rank") < F.col("need"))
        .select("slot", "src", "rank")
    )
    given = slots.groupBy("src").agg(F.count("*").alias("given"))
    short = needs.join(given, "src", "left").withColumn("given", F.coalesce("given", F.lit(0)))
    short = short.where(F.col("given") < F.col("need"))
    missing = short.select(
        "src", F.explode(F.sequence("given", F.col("need") - 1)).alias("rank")
    ).select((F.lit(total) + F.col("rank")).alias("slot"), "src", "rank")
    return ranked.unionByName(missing)


def pieces(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for every block that a row's words meet, in each pass over its source:
    (rank, pass, from_word, to_word) beside the row; rows without any keep one null."""
    start = F.col("start")
    passes = F.ceil(F.col("words") / F.greatest(F.col("source_size"), F.lit(1))).cast("int")
    rows = rows.withColumn(
        "pass", F.explode_outer(F.when((F.col("size") > 0) & (passes > 0), F.sequence(F.lit(0), passes - 1)))
    )
    rows = rows.withColumn("at", F.col("pass") * F.col("source_size") + start)
    rows = rows.withColumn("end", F.least(F.col("at") + F.col("size"), F.col("words")))
    taken = F.col("at") < F.col("end")
    ranks = F.sequence(F.floor(F.col("at") / block), F.floor((F.col("end") - 1) / block))
    rows = rows.withColumn("rank", F.explode_outer(F.when(taken, ranks)))
    low = F.greatest(F.col("rank") * block, F.col("at")) - F.col("at")
    high = F.least((F.col("rank") + 1) * block, F.col("end")) - F.col("at")
    return rows.withColumn("from_word", low).withColumn("to_word", high).drop("at", "end")


def mix(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block: int = BLOCK,
    carry: dict[str, Column] | None = None,
    **rule,
) -> DataFrame:
    """The mix: rows of ``df``'s keys with (slot, pass, from_word, to_word).

    A row appears once for every block it has words in, and once with nulls if the mix
    takes none of it. Null texts have no words; null sources are a source of their own;
    repeated rows are rows of their own. An empty table gives an empty mix. Reruns
    agree: nothing depends on the order in which rows are read.
    """
    rows, sources = placed(df, key, source, word_count(F.col(text)), carry, **rule)
    slots = schedule(sources, block)
    return pieces(rows, block).join(slots, ["src", "rank"], "left")


def taken_words(mixed: DataFrame) -> DataFrame:
    """Per row of the mixed table: its size, its source's size and target, words taken."""
    words_of = F.when(F.col("slot").isNotNull(), F.col("to_word") - F.col("from_word"))
    kept = ("doc_id", "size", "source_size", "target")
    return mixed.groupBy("src", "cell", "nth").agg(
        *[F.first(c).alias(c) for c in kept],
        F.coalesce(F.sum(words_of), F.lit(0)).cast("long").alias("taken"),
    ).select(*kept, "taken")


def mixed_texts(df: DataFrame, **options) -> DataFrame:
    """``df`` as the mix takes it: a row for every pass over a document, whose text is
    cut (words joined by one space) where the mix takes only some of its words.

    Needs the columns doc_id, text, source; n_chars is brought up to date if there. Every
    row comes out with its own other columns, also beside rows of the same id and text.
    """
    mark = row_mark(df)
    mixed = mix(df, carry={"mark": mark}, **options).where(F.col("slot").isNotNull())
    spans = mixed.groupBy("src", "cell", "nth", "pass").agg(
        F.first("doc_id").alias("id"),
        F.first("mark").alias("mark"),
        F.first("source").alias("from"),
        F.first("size").alias("size"),
        F.min("from_word").alias("low"),
        F.max("to_word").alias("high"),
    )
    spans = spans.select(*[F.col(c).alias(f"__{c}") for c in ("id", "mark", "from", "size", "low", "high")])
    texts = df.withColumn("__text_mark", mark).dropDuplicates(["doc_id", "__text_mark", "source"])
    same = [
        texts.doc_id.eqNullSafe(spans["__id"]),
        texts["__text_mark"] == spans["__mark"],
        texts.source.cast("string").eqNullSafe(spans["__from"]),
    ]
    both = texts.join(spans, same)
    taken = F.col("__high") - F.col("__low")
    some = F.array_join(F.slice(words(F.col("text")), (F.col("__low") + 1).cast("int"), taken.cast("int")), " ")
    both = both.withColumn("text", F.when(taken == F.col("__size"), F.col("text")).otherwise(some))
    if "n_chars" in df.columns:
        both = both.withColumn("n_chars", F.length("text").cast("long"))
    return both.select(*df.columns)
