"""A prefix trie of conversations, by ROLLUP over columns of turn ids.

Every conversation is cut into blocks of ``BLOCK`` turns; a block is a row with a column
of turn ids for every place in it. One ROLLUP over these columns, with the block's
number and the node before the block as fixed keys, makes a group of every prefix of
every conversation; grouping_id tells how long it is. Later blocks carry the key of the
node that the block before ended at, so conversations of any length take one pass.

A node is owned by its smallest member. The nodes a conversation owns are the last ones
on its path, from a depth ``own`` on, so sums over distinct nodes of a subtree become
sums over the conversations that pass through: a turn counts where it is not owned (one
of n - 1 spare copies), a leaf and a child where it is. The first ROLLUP finds owners,
the second one sums.
"""

from __future__ import annotations

import hashlib
from operator import add

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm.text import stored

#: Turns of a block: positional columns of the ROLLUP.
BLOCK = 8
#: Turns, or blocks, of one conversation whose running figures are counted in one group.
CELL = 4_096
#: Conversation ids that one list of a node's ends spans.
SPAN = 4_096


def _running(df: DataFrame, key: str, cell: str, order: list[Column], sums: dict[str, tuple]) -> DataFrame:
    """Add figures over all rows of a key before each row: name -> (aggregate that also
    joins its own results, column, the same of two figures). A key's rows are counted cell by cell (cells follow
    the order) and only cell totals are set against each other, so a key that holds a
    third of all rows is shared out."""
    inside = Window.partitionBy(key, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(key).orderBy(F.asc_nulls_first(cell)).rowsBetween(Window.unboundedPreceding, -1)
    cells = df.groupBy(key, cell).agg(*[f(c).alias(n) for n, (f, c, _) in sums.items()])
    cells = cells.select(
        F.col(key).alias("__key"),
        F.col(cell).alias("__cell"),
        *[f(n).over(ahead).alias(f"__{n}") for n, (f, _, _) in sums.items()],
    ).where(" OR ".join(f"__{n} IS NOT NULL" for n in sums))  # the first cell has nothing before
    rows = df.withColumns({n: f(c).over(inside) for n, (f, c, _) in sums.items()})
    rows = rows.join(cells, [F.col(key).eqNullSafe(cells["__key"]), F.col(cell).eqNullSafe(cells["__cell"])], "left")
    whole = {n: both(F.coalesce(n, F.lit(0)), F.coalesce(f"__{n}", F.lit(0))) for n, (_, _, both) in sums.items()}
    return rows.withColumns(whole).drop("__key", "__cell", *[f"__{n}" for n in sums])


def numbered(df: DataFrame) -> DataFrame:
    """Turns as (conv_id, pos, a, b, len): places from 0 by turn, null first, equal turns
    by a hash of role and text; a and b name role and text, len is the text's bytes.
    Null roles and texts are empty. Texts themselves go no further."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    sha = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = df.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.xxhash64(F.lit(1), sha).alias("a"),
        F.xxhash64(F.lit(2), sha).alias("b"),
        F.octet_length(text).cast("long").alias("len"),
        F.floor(F.col("turn") / CELL).alias("cell"),
    )
    order = [F.asc_nulls_first("turn"), F.col("a"), F.col("b")]
    rows = stored(rows, "trie-hashed")
    return _running(rows, "conv_id", "cell", order, {"pos": (F.sum, F.lit(1), add)}).select("conv_id", "pos", "a", "b", "len")


def rebuilt(turns: DataFrame, group: int, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their group: the first ``head`` turns
    (at most ``most``) of conversation conv_id - conv_id % group, then what follows their
    own first ``head`` turns. Gives turns as (conv_id, depth, a, b, len), depth from 1, and
    conversations as (conv_id, n): their lengths. ``turns`` are numbered ones. A
    conversation without an id keeps its turns."""
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(group))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    firsts = turns.where((F.col("pos") < most) & (F.pmod("conv_id", F.lit(group)) == 0))
    bases = convs.where(F.pmod("conv_id", F.lit(group)) == 0).select(
        F.col("conv_id").alias("base"), F.least("own", F.lit(most)).alias("given")
    )
    convs = convs.withColumns({"base": base, "head": F.coalesce(head, F.lit(0))}).join(bases, "base", "left")
    # The first of a group stays as it is; the head is its own.
    same = F.coalesce(F.col("base") == F.col("conv_id"), F.lit(True))
    pre = F.when(same, 0).otherwise(F.least("head", F.coalesce("given", F.lit(0))))
    convs = convs.select(
        "conv_id", F.when(same, 0).otherwise(F.col("head")).alias("skip"), pre.alias("pre"), "own", "base"
    ).withColumn("n", F.col("pre") + F.greatest(F.col("own") - F.col("skip"), F.lit(0)))
    convs = stored(convs, "trie-convs")
    shift = convs.select(F.col("conv_id").alias("c"), "skip", "pre")
    own = turns.join(shift, turns.conv_id.eqNullSafe(shift.c)).where(F.col("pos") >= F.col("skip"))
    own = own.select("conv_id", (F.col("pos") - F.col("skip") + F.col("pre") + 1).alias("depth"), "a", "b", "len")
    firsts = firsts.select(F.col("conv_id").alias("base"), "pos", "a", "b", "len")
    borrowed = convs.where("pre > 0").select("conv_id", "base", "pre").join(firsts, "base")
    borrowed = borrowed.where("pos < pre").select("conv_id", (F.col("pos") + 1).alias("depth"), "a", "b", "len")
    return own.unionByName(borrowed), convs.select("conv_id", "n")


def blocks(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Rows (conv_id, n, block, pa, pb, t0..): the turns of a block as structs (a, b, len),
    null beyond the conversation's end, and the key of the node before the block. Every
    conversation has a first block, also without turns."""
    at = F.col("depth") - 1
    turn = F.struct("a", "b", "len")
    # A node's key is the exclusive or of hashes of its turns and their depths.
    mixed = {f"h{x}": F.xxhash64(F.lit(i), "depth", "a", "b") for i, x in enumerate("ab")}
    rows = turns.withColumns({"block": F.floor(at / BLOCK), "slot": at % BLOCK, "turn": turn, **mixed})
    rows = rows.groupBy("conv_id", "block").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "turn"))).alias("turns"),  # at most BLOCK
        *[F.bit_xor(f"h{x}").alias(f"h{x}") for x in "ab"],
    )
    columns = [F.try_element_at("turns", F.lit(i).cast("long")).alias(f"t{i}") for i in range(BLOCK)]
    rows = rows.select("conv_id", "block", "ha", "hb", *columns)
    ids = convs.select(F.col("conv_id").alias("c"), "n")
    rows = ids.join(rows, rows.conv_id.eqNullSafe(ids.c), "left").drop("conv_id").withColumnRenamed("c", "conv_id")
    rows = rows.withColumn("block", F.coalesce("block", F.lit(0)))
    rows = stored(rows.withColumn("cell", F.floor(F.col("block") / CELL)), "trie-turns-of-blocks")
    sums = {f"p{x}": (F.bit_xor, F.col(f"h{x}"), Column.bitwiseXOR) for x in "ab"}
    return _running(rows, "conv_id", "cell", [F.col("block")], sums).drop("ha", "hb", "cell")


def _prefixes(rows: DataFrame, sums: dict[str, str]) -> DataFrame:
    """The groups of all prefixes: (block, pa, pb, t0.., level) and the aggregates.
    ``level`` is the number of the block's turns in the prefix; level 0 stays in the first
    block alone, elsewhere it is the block before's last level."""
    spark = rows.sparkSession
    names = [f"t{i}" for i in range(BLOCK)]
    aggregates = ", ".join(f"{expression} AS {name}" for name, expression in sums.items())
    found = spark.sql(
        f"SELECT block, pa, pb, {', '.join(names)}, {aggregates}, "
        f"{BLOCK} - CAST(bit_count(grouping_id()) AS INT) AS level "
        f"FROM {{rows}} GROUP BY block, pa, pb, ROLLUP({', '.join(names)})",
        rows=rows,
    )
    # A conversation that ends inside the block has no turn at deeper levels.
    last = F.element_at(F.array(*names), F.greatest("level", F.lit(1)))
    real = F.when(F.col("level") == 0, F.col("block") == 0).otherwise(last.isNotNull())
    return found.where(real).withColumn("depth", F.col("block") * BLOCK + F.col("level"))


def _key(level: Column, part: str) -> Column:
    """Part of the key of the node at a level of its block."""
    i = "ab".index(part)
    out = F.col(f"p{part}")
    for j in range(BLOCK):
        hashed = F.xxhash64(F.lit(i), F.col("block") * BLOCK + (j + 1), F.col(f"t{j}.a"), F.col(f"t{j}.b"))
        out = out.bitwiseXOR(F.when(level > j, hashed).otherwise(0))
    return out


def _digests(ends: DataFrame) -> DataFrame:
    """(ka, kb, ends_sha256) of nodes at which conversations end. Ids are listed span by
    span; a node's lists are hashed one after the other as they stream by.

    The lists are dealt out straight from where they were written. After a join or grouping
    by the same key Spark leaves out the repartition, and is then free to read the join's
    shuffle in other pieces: nothing but a repartition keeps a node's rows in one task."""
    ids = F.array_join(F.array_sort(F.collect_list("conv_id")), ",")
    lists = ends.groupBy("ka", "kb", F.floor(F.col("conv_id") / SPAN).alias("span")).agg(ids.alias("ids"))
    lists = stored(lists, "trie-ends")

    def streamed(batches):
        def out(done):
            columns = zip(*done, strict=True) if done else ([], [], [])
            types = (pa.int64(), pa.int64(), pa.string())
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["ka", "kb", "ends_sha256"])

        node = sha = None
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("ka", "kb", "ids")]
            for ka, kb, text in zip(*columns, strict=True):
                if node == (ka, kb):
                    sha.update(b"," + text.encode())
                    continue
                if node:
                    done.append((*node, sha.hexdigest()))
                node, sha = (ka, kb), hashlib.sha256(text.encode())
            yield out(done)
        if node:
            yield out([(*node, sha.hexdigest())])

    dealt = lists.repartition("ka", "kb").sortWithinPartitions("ka", "kb", "span")
    return stored(dealt.mapInArrow(streamed, "ka long, kb long, ends_sha256 string"), "trie-digests")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Every node of the trie of ``turns`` (conv_id, depth, a, b, len), of which ``convs``
    (conv_id, n) has the lengths: conv_id (smallest member), depth, parent_conv_id, n_convs
    (members), n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations without turns are members of the root alone. A conversation whose id is
    null is one more member: it is counted, but stands after all ids and is in no list of
    ends. Node keys have 128 bits of hashes, so that two nodes share one by chance in
    about 1 of 2**128 / nodes**2 tables; they are no defence against texts made up for it.
    No conversations, no nodes, not even a root.
    """
    # Every step is written, so that no plan holds more than a few shuffles: the driver keeps
    # the plan and code of whatever runs, and the steps are read two to four times.
    rows = stored(blocks(turns, convs), "trie-blocks")
    # Null ids sort last: the smallest member is an id where there is one.
    levels = range(BLOCK + 1)
    first = _prefixes(
        rows.withColumn("end", F.col("n") - F.col("block") * BLOCK),
        {"conv_id": "min(conv_id)", "n_convs": "count(*)", **{f"e{j}": f"count_if(end = {j})" for j in levels}},
    )
    ended = F.element_at(F.array(*[f"e{j}" for j in levels]), F.col("level") + 1)
    level, before = F.col("level"), F.col("block") * BLOCK
    nodes = first.select(
        "conv_id",
        "depth",
        (ended == F.col("n_convs")).cast("int").alias("leaf"),
        *[_key(level, x).alias(f"k{x}") for x in "ab"],
        *[_key(level - 1, x).alias(f"q{x}") for x in "ab"],
    )
    nodes = stored(nodes, "trie-nodes")
    owners = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("own"),
        F.max("leaf").alias("leaf"),
        F.min_by(F.struct("qa", "qb"), "depth").alias("parent"),
    )
    owners = stored(owners, "trie-owners")
    above = nodes.select(F.col("conv_id").alias("above"), F.col("ka").alias("xa"), F.col("kb").alias("xb"))
    top = owners.where("own = 0").withColumn("above", F.lit(None).cast("long"))
    lower = owners.where("own > 0").join(above, [F.col("parent.qa") == F.col("xa"), F.col("parent.qb") == F.col("xb")])
    owners = top.select("conv_id", "own", "leaf", "above").unionByName(lower.select("conv_id", "own", "leaf", "above"))
    ends = rows.withColumn("level", (F.col("n") - before).cast("int"))
    last = (F.col("level") > 0) & (F.col("level") <= BLOCK) | (F.col("n") == 0)
    ends = ends.where(last & F.col("conv_id").isNotNull())
    ends = ends.select("conv_id", *[_key(level, x).alias(f"k{x}") for x in "ab"])
    digests = _digests(ends)
    owners = owners.withColumnRenamed("conv_id", "c")
    rows = rows.join(owners, rows.conv_id.eqNullSafe(owners.c), "left").drop("c")
    own = F.coalesce("own", F.col("n") + 1)
    lens = [F.coalesce(F.col(f"t{j}.len"), F.lit(0)) for j in range(BLOCK)]
    spare = [F.when(before + j + 1 < own, lens[j]).otherwise(0) for j in range(BLOCK)]
    # Spare bytes of the blocks behind this one: of the whole conversation, less those up to here.
    here = sum(spare[1:], spare[0])
    rows = rows.withColumns({"leaf": F.coalesce("leaf", F.lit(0)), "own": own, "here": here})
    rows = stored(rows.withColumn("cell", F.floor(-F.col("block") / CELL)), "trie-owned")
    rows = _running(rows, "conv_id", "cell", [F.desc("block")], {"behind": (F.sum, F.col("here"), add)})
    left = {f"u{BLOCK}": F.col("behind")}
    for j in reversed(range(BLOCK)):
        left[f"u{j}"] = left[f"u{j + 1}"] + spare[j]
    child = {f"d{j}": ((own <= before + j + 1) & (before + j + 1 <= F.col("n"))).cast("int") for j in levels}
    # A node at level j has its own turn at place j - 1; the root has none.
    rows = rows.withColumns({**left, **child})
    second = _prefixes(
        rows,
        {
            "conv_id": "min(conv_id)",
            "n_convs": "count(*)",
            "mine": f"min_by(struct(own, above), coalesce(conv_id, {2**63 - 1}))",
            "n_leaves": "sum(leaf)",
            **{f"d{j}": f"sum(d{j})" for j in levels},
            **{f"u{j}": f"sum(u{j})" for j in range(BLOCK)},
        },
    )

    def at_level(names: list[str]) -> Column:
        return F.element_at(F.array(*names), F.col("level") + 1)

    second = second.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > F.col("mine.own"), F.col("conv_id")).otherwise(F.col("mine.above")).alias("parent_conv_id"),
        "n_convs",
        at_level([f"d{j}" for j in levels]).alias("n_children"),
        "n_leaves",
        at_level(["u0", *[f"u{j}" for j in range(BLOCK)]]).alias("saved_tokens"),
        *[_key(level, x).alias(f"k{x}") for x in "ab"],
    )
    out = stored(second, "trie-summed").join(digests, ["ka", "kb"], "left")
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", nobody)).drop("ka", "kb")


def prefix_trie(df: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """The trie (see ``trie``) of the conversations in ``df`` (conv_id, turn, role, text),
    each rebuilt to begin like the first of its group of ids (see ``rebuilt``) by as many
    turns as the CRC-32 of its id leaves by ``heads``. Extra columns do not matter."""
    turns = stored(numbered(df), "trie-turns")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    return trie(*rebuilt(turns, group, head, heads - 1))
