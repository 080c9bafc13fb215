"""Near duplicates: SimHash fingerprints of distinct five-word shingles matched by Golay-code
fuzzy hashing, verified by the Jaccard similarity of the whole texts, alike from 0.8 on.

Texts with equal sets of shingles collapse to one node. Candidates are nodes whose
fingerprints share a fuzzy key (see ``simhash``) and differ in at most ``REACH`` bits. Up to 4
bits the keys miss none; at 0.8 pairs differ in some 10 bits, where they miss many. So
nodes with an equal band of min-hashes are candidates too: with ``BANDS`` bands of ``ROWS`` a
pair of similarity s shares none with probability (1 - s**ROWS)**BANDS, 7 in a million at 0.8 and
less above. Candidates only say which texts are held against each other: every link that
joins two texts was verified on their whole sets. What candidates connect is compared in
one place, a large group in pairs of blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm import simhash
from brisa.llm.components import components
from brisa.llm.text import stored, trim, with_arrow
from brisa.operators.sizes import join_checked, join_null_safe

SHINGLE = 5
SEED = 42
#: Least similarity, as a fraction.
ALIKE = (4, 5)
#: Differing bits up to which fingerprints that share a key make candidates. Of two unrelated
#: texts 1 pair in 100 million is that near, so such links stay few in large tables.
REACH = 10
#: Bands of min-hashes, and min-hashes in each.
BANDS, ROWS = 30, 5
#: Nodes, and bytes of their sets, of one group that are compared in one place; more are
#: split in blocks.
BLOCK = 1_024
BLOCK_BYTES = 4 << 20


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles of the lower-cased words; all words are one
    shingle where there are fewer, and there is none without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # as in simhash.fingerprint
    if not words:
        return np.empty(0, np.uint64)
    found = {b" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}
    return np.unique(np.array([xxhash.xxh64_intdigest(s, SEED) for s in found], np.uint64))


def fingerprint(hashes: np.ndarray) -> int:
    """SimHash of a set of shingles; 0 without shingles."""
    return simhash.majority(hashes[at : at + 65_536] for at in range(0, len(hashes), 65_536))


def bands(hashes: np.ndarray) -> np.ndarray:
    """A key for each band: hash of its number and its min-hashes. No bands without shingles."""
    import xxhash

    if not len(hashes):
        return np.empty(0, np.int64)
    factors = np.random.default_rng(SEED).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 1_024):
        np.minimum(least, (hashes[at : at + 1_024, None] * factors).min(axis=0), out=least)
    keys = [xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64)


def alike_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what is alike among some sets: a spanning forest, never all pairs."""
    sizes = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    seen = np.zeros(len(ids) + 1, bool)
    over, under = ALIKE
    links, left = [], np.arange(len(sets))
    flat, owner = ids, np.repeat(np.arange(len(sets)), sizes)
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            mine = ids[ends[at] - sizes[at] : ends[at]]
            seen[mine] = True
            shared = np.bincount(owner[seen[flat]], minlength=len(sets))[left]
            seen[mine] = False
            near = under * shared >= over * (sizes[left] + sizes[at] - shared)
            if near.any():
                hit = left[near]
                links += [(int(at), int(x)) for x in hit]
                queue += hit.tolist()
                left = left[~near]
                rest = np.zeros(len(sets), bool)
                rest[left] = True
                rest = rest[owner]
                flat, owner = flat[rest], owner[rest]
    return links


def _hashed(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, mark, node, n, fp, bands) of every row: ``node`` hashes the set of ``n`` shingles,
    ``fp`` is its fingerprint."""
    rows = df.select(F.col(key).alias(key), F.xxhash64(text).alias("mark"), F.col(text).alias("__t"))

    def hashed(batches):
        import xxhash

        for (texts,) in batches:
            nodes, sizes, fps, keys = [], [], [], []
            for t in texts:
                s = shingles(t.as_py())
                nodes.append(xxhash.xxh64_intdigest(s.tobytes(), SEED))
                sizes.append(len(s))
                fps.append(fingerprint(s))
                keys.append(bands(s))
            yield [
                pa.array(np.array(nodes, np.uint64).view(np.int64)),
                pa.array(sizes, pa.int32()),
                pa.array(np.array(fps, np.uint64).view(np.int64)),
                pa.array(keys, pa.list_(pa.int64())),
            ]
        trim()

    found = with_arrow(rows, ["__t"], "node long, n int, fp long, bands array<long>", hashed)
    return found.select(key, "mark", "node", "n", "fp", "bands")


def _verified(df: DataFrame, rows: DataFrame, near: DataFrame, key: str, text: str, block: int) -> DataFrame:
    """Links (u, v) between the nodes of one component of ``near`` (node, component)
    whose texts are alike: enough of them to connect all that are linked."""
    place = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("mark").alias("mark"))
    first = rows.groupBy("node").agg(F.min(place).alias("at"), F.first("n").alias("n"))
    first = stored(join_checked(first, near, ["node"]).select("node", "component", "n", "at"), "compared")
    size = F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") * 8 / BLOCK_BYTES))
    sizes = first.groupBy("component").agg(size.cast("int").alias("blocks"), F.count("*").alias("nodes"))
    sizes = sizes.where("nodes > 1").drop("nodes")
    first = join_checked(first, sizes, ["component"])
    first = first.select(F.col("at.key").alias(key), F.col("at.mark").alias("__mark"), "node", "component", "blocks")
    texts = df.select(key, F.col(text).alias("__t")).withColumn("__mark", F.xxhash64("__t"))
    texts = join_null_safe(texts, first, [key, "__mark"]).select("__t", "node", "component", "blocks")

    def packed(batches):
        for (values,) in batches:
            yield [pa.array([shingles(t.as_py()).tobytes() for t in values], pa.binary())]
        trim()

    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.least(j, F.col("own")) * F.col("blocks") + F.greatest(j, F.col("own")),
    )
    sets = with_arrow(texts, ["__t"], "__s binary", packed).drop("__t")
    dealt = sets.withColumn("own", own).withColumn("cell", F.explode(met))
    dealt = dealt.select("component", "cell", "node", "__s").repartition("component", "cell")

    def linked(batches):
        def out(nodes, sets):
            links = alike_links([np.frombuffer(s, np.uint64) for s in sets])
            ends = [pa.array([nodes[x[i]] for x in links], pa.int64()) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(ends, ["u", "v"])

        now, nodes, sets = None, [], []
        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(4))
            for component, cell, node, s in zip(*columns, strict=True):
                if (component, cell) != now:
                    if len(nodes) > 1:
                        yield out(nodes, sets)
                    now, nodes, sets = (component, cell), [], []
                nodes.append(node)
                sets.append(s)
        if len(nodes) > 1:
            yield out(nodes, sets)
        del nodes, sets
        trim()

    return dealt.sortWithinPartitions("component", "cell").mapInArrow(linked, "u long, v long")


def near_fingerprints(rows: DataFrame) -> DataFrame:
    """Links (u, v) between nodes by their fingerprints. Nodes of one fingerprint are linked
    to the smallest of them, which stands for all in the links to others."""
    nodes = stored(rows.select("fp", "node").distinct(), "fingerprinted")
    first = stored(nodes.groupBy("fp").agg(F.min("node").alias("first")), "fingerprints")
    near = simhash.near_links(first, REACH, beyond=True)
    for end in ("u", "v"):
        named = first.select(F.col("fp").alias(end), F.col("first").alias(f"n{end}"))
        near = join_checked(near, named, [end])
    same = join_checked(nodes, first, ["fp"]).where("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    return near.select(F.col("nu").alias("u"), F.col("nv").alias("v")).unionByName(same)


def shared_bands(rows: DataFrame) -> DataFrame:
    """Links (u, v) between nodes by their bands. Every node of a band is linked to the
    band's smallest one, so links grow with the rows."""
    keyed = rows.select("node", F.explode("bands").alias("band")).distinct()
    least = keyed.groupBy("band").agg(F.min("node").alias("v"), F.count("*").alias("nodes"))
    least = stored(least.where("nodes > 1").select("band", "v"), "bands")
    links = join_checked(keyed, least, ["band"]).where("node <> v")
    return links.select(F.col("node").alias("u"), "v")


def candidates(rows: DataFrame) -> DataFrame:
    """(node, component): what near fingerprints or shared bands connect."""
    return components(near_fingerprints(rows).unionByName(shared_bands(rows)))


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(key, mark, component) of every row: ``component`` names the group of texts that
    verified links connect, ``mark`` hashes the text. Texts without words are one group.
    Repeated rows stay rows."""
    rows = stored(_hashed(df, key, text), "shingled")
    near = stored(candidates(rows), "candidates")
    links = _verified(df, rows, near, key, text, block)
    classes = stored(components(links), "alike")
    named = rows.join(classes, rows.node == classes.node, "left")
    return named.select(key, "mark", F.coalesce("component", rows.node).alias("component"))


def leaders(df: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row of each group of texts that are alike, chosen as ``simhash.leaders`` does."""
    return simhash.firsts(df, groups(df, key, text, block), key, text)
