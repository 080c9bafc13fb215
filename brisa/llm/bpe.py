"""Byte-level BPE by recursive DuckDB queries inside every Spark partition.

A text is cut into words by the vocabulary's pattern. The distinct words that a
worker has not met become token-position rows, at first one row a byte. A recursive
query joins neighbouring rows with the merge table and contracts, in every word, the
leftmost pair of least rank, until no pair of any word is left. Decoding joins the
ids with the vocabulary and puts the pieces together by an ordered aggregation, one for
all texts of a batch: one sort instead of a sort for every text.

One round contracts every sure pair of a word: nothing of lesser or equal rank can ever take
one of its two tokens away, and the merged token can form no pair of lesser rank with
anything. Whatever merges come first leave such a pair alone, so the order of ranks comes to
it as it stands. Of each word's least rank a round contracts every occurrence (from the left,
not overlapping) if the merged token can form no pair of lesser rank, else the leftmost one.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm.text import hold, trim, with_arrow

#: Words of each of the two generations that a worker remembers.
CACHED = 500_000
#: Bytes of new words that one recursion takes on, and the rows it may pile up.
TOGETHER = 300_000
ROWS = 3_000_000

# A row's key is its word and its place in it, so one order serves all words.
_ROUNDS = """
WITH RECURSIVE t(round, key, tok, done) AS (
    SELECT 0, key, tok, false FROM start
    UNION ALL
    (WITH p AS MATERIALIZED (
        SELECT round, key >> 32 AS w, key, tok, lead(tok) OVER o AS next, lead(key) OVER o >> 32 AS nextw,
            row_number() OVER o AS i
        FROM t WHERE round < {rounds} AND NOT done WINDOW o AS (ORDER BY key)),
    q AS (
        SELECT p.w, p.i, g.rank, g.safe, g.by_right, g.by_left
        FROM p JOIN merges g ON g.l = p.tok AND g.r = p.next WHERE p.nextw = p.w),
    m AS MATERIALIZED (
        SELECT w, i, rank, safe, safe
            AND (lead(i) OVER o IS DISTINCT FROM i + 1 OR lead(by_right) OVER o > rank)
            AND (lag(i) OVER o IS DISTINCT FROM i - 1 OR lag(by_left) OVER o > rank) AS sure
        FROM q WINDOW o AS (ORDER BY i)),
    least AS MATERIALIZED (SELECT w, min(rank) AS rank FROM m WHERE rank IS NOT NULL GROUP BY w),
    c AS (
        SELECT m.w, m.i, m.rank, m.safe, row_number() OVER (PARTITION BY m.w ORDER BY m.i) AS nth
        FROM m JOIN least l ON l.w = m.w AND l.rank = m.rank WHERE NOT m.sure),
    best AS MATERIALIZED (
        SELECT i, rank FROM m WHERE sure
        UNION ALL
        SELECT i, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY w, i - nth ORDER BY i) AS inrun FROM c)
        WHERE nth = 1 OR (safe AND inrun % 2 = 1)),
    -- The left row of a pair becomes the merged token, the right one goes.
    e AS (SELECT i, rank FROM best UNION ALL SELECT i + 1, NULL FROM best)
    -- A word without pairs is handed on once more, as done.
    SELECT p.round + 1, p.key, CASE WHEN e.i IS NULL THEN p.tok ELSE e.rank END, l.w IS NULL
    FROM p LEFT JOIN least l ON l.w = p.w LEFT JOIN e ON e.i = p.i
    WHERE e.i IS NULL OR e.rank IS NOT NULL))
SELECT key >> 32 AS w, tok, done FROM t WHERE done OR round = {rounds} ORDER BY key
"""

# A byte of a piece is the character of its number; what ends a text is neither a byte's
# character nor a token's id.
_DECODE = "SELECT string_agg(v.piece, '' ORDER BY d.at) FROM tokens d JOIN vocabulary v USING (id)"
_END = (1 << 32, "\u0100")


def ranks_of(data: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64, a space, the rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """(l, r, rank, safe, by_right, by_left) of neighbouring tokens. ``rank`` is that of the
    token they make, null if none. It is unsafe if that token can make one of lesser rank with a
    neighbour. ``by_right`` is the least rank of a token made of l and any token that begins
    with r, ``by_left`` of any token that ends with l, and r; pairs that could hold back no
    merge are left out."""
    none = 2**31 - 1
    rank_of, right, left, unsafe = {}, {}, {}, set()
    # The greatest rank of a token whose right, or left, part is this token.
    as_right, as_left = {}, {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            l, r = ranks.get(token[:cut]), ranks.get(token[cut:])
            if l is None or r is None:
                continue
            rank_of[l, r] = rank
            unsafe.update(x for x in (l, r) if x > rank)
            as_right[r] = max(rank, as_right.get(r, rank))
            as_left[l] = max(rank, as_left.get(l, rank))
            for end in range(cut + 1, len(token) + 1):
                first = ranks.get(token[cut:end])
                if first is not None and right.get((l, first), none) > rank:
                    right[l, first] = rank
            for begin in range(cut):
                last = ranks.get(token[begin:cut])
                if last is not None and left.get((last, r), none) > rank:
                    left[last, r] = rank
    pairs = list(rank_of)
    pairs += [k for k in right if k not in rank_of and right[k] <= as_right.get(k[0], -1)]
    held = set(pairs)
    pairs += [k for k in left if k not in held and left[k] <= as_left.get(k[1], -1)]
    columns = {
        "l": [l for l, _ in pairs],
        "r": [r for _, r in pairs],
        "rank": [rank_of.get(k) for k in pairs],
        "by_right": [right.get(k, none) for k in pairs],
        "by_left": [left.get(k, none) for k in pairs],
    }
    table = pa.table({name: pa.array(c, pa.int32()) for name, c in columns.items()})
    return table.append_column("safe", pa.array([rank_of[k] not in unsafe if k in rank_of else None for k in pairs], pa.bool_()))


class Coder:
    """A worker's DuckDB with the merge table and the vocabulary, and its word cache."""

    def __init__(self, data: bytes, pattern: str, cached: int = CACHED, merges: pa.Table | None = None):
        import duckdb
        import regex

        self.ranks = ranks_of(data)
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary has no token for the bytes {missing[:5]}")
        self.find = regex.compile(pattern).findall
        self.cached = cached
        # Ids of words as bytes; what the older generation knows is taken over on use.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        # One thread and bounded memory: Spark runs a coder on each core. Nothing spills
        # to a machine's disk.
        self.db = duckdb.connect(
            config={"threads": 1, "memory_limit": "350MB", "temp_directory": "", "preserve_insertion_order": False}
        )
        self.db.register("given", merge_table(self.ranks) if merges is None else merges)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.db.unregister("given")
        pieces = [(i, t.decode("latin-1")) for t, i in self.ranks.items()] + [_END]
        ids, texts = zip(*pieces, strict=True)
        self.db.register("given", pa.table({"id": pa.array(ids, pa.int64()), "piece": pa.array(texts)}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self.db.unregister("given")

    def _contract(self, raw: list[bytes]) -> list[bytes]:
        """Token ids of words, contracted to the end."""
        out = [b""] * len(raw)
        sizes = np.array([len(r) for r in raw])
        word = np.repeat(np.arange(len(raw), dtype=np.int64), sizes)
        token = self.bytes[np.frombuffer(b"".join(raw), np.uint8)]
        while len(word):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            place = np.arange(len(word)) - np.repeat(first, np.diff(np.concatenate((first, [len(word)]))))
            rounds = int(max(4, min(64, ROWS // len(word))))
            self.db.register("start", pa.table({"key": word << 32 | place, "tok": token}))
            found = self.db.execute(_ROUNDS.format(rounds=rounds)).fetchnumpy()
            self.db.unregister("start")
            open_ = ~found["done"]
            word, token = found["w"][~open_], found["tok"][~open_].astype(np.int32)
            cuts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1], [True]))) if len(word) else []
            data = token.tobytes()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                out[word[a]] = data[4 * a : 4 * b]
            word, token = found["w"][open_].astype(np.int64), found["tok"][open_].astype(np.int32)
        return out

    def learn(self, new: list[str]) -> None:
        """Encode words and remember them. A word that is a token is that token."""
        todo, raw, size = [], [], 0
        for word in new:
            data = word.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(data)
            if whole is not None:
                self.words[word] = whole.to_bytes(4, "little")
                continue
            todo.append(word)
            raw.append(data)
            size += len(data)
            if size >= TOGETHER:
                self.words.update(zip(todo, self._contract(raw), strict=True))
                todo, raw, size = [], [], 0
        if todo:
            self.words.update(zip(todo, self._contract(raw), strict=True))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.find(t) if t else [] for t in texts]
        if len(self.words) > self.cached:
            self.words, self.older = {}, self.words
        known, older = self.words, self.older
        new = []
        for word in set(chain.from_iterable(split)).difference(known):
            ids = older.get(word)
            if ids is None:
                new.append(word)
            else:
                known[word] = ids
        if new:
            self.learn(new)
        return [np.frombuffer(b"".join([known[w] for w in ws]), "<i4") for ws in split]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        if not ids:
            return []
        end = np.array([_END[0]], np.int64)
        flat = np.concatenate([part for x in ids for part in (x, end)])
        self.db.register("tokens", pa.table({"at": np.arange(len(flat), dtype=np.int32), "id": flat}))
        ((text,),) = self.db.execute(_DECODE).fetchall()
        self.db.unregister("tokens")
        return [t.encode("latin-1") for t in text.split(_END[1])[:-1]]


_coders: dict[str, Coder] = {}


def _coder(data: bytes, pattern: str, merges: pa.Table, cached: int = CACHED) -> Coder:
    """The worker's coder of a vocabulary; it outlives tasks."""
    hold("bpe", _coders.clear)
    key = hashlib.md5(data + f"{cached} {pattern}".encode()).hexdigest()
    trim()
    if key not in _coders:
        _coders.clear()
        _coders[key] = Coder(data, pattern, cached, merges)
    return _coders[key]


#: Texts and bytes handled at once inside a batch.
_TEXTS = 1_024
_BYTES = 2 << 20


def _slices(sizes: list[int], most: int, texts: int = _TEXTS) -> Iterator[tuple[int, int]]:
    at = total = 0
    for i, n in enumerate(sizes):
        if i > at and (total + n > most or i - at >= texts):
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def vocabulary(path: str) -> bytes:
    """A rank file's bytes, read once by the driver: every task gets them."""
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=2)
def _merges(ranks: bytes) -> pa.Table:
    """The merge table, made once by the driver."""
    return merge_table(ranks_of(ranks))


def encoded(df: DataFrame, ranks: bytes, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the token ids (array<int>) of each whole text, without special tokens.

    Null and empty texts have none. Repeated rows stay rows; an existing column called
    ``out`` is replaced, all others are kept; an empty table stays empty.
    """
    shared = df.sparkSession.sparkContext.broadcast((ranks, pattern, _merges(ranks)))

    def encode(batches):
        coder = _coder(*shared.value)
        for (batch,) in batches:
            values = batch.to_pylist()
            parts = []
            for a, b in _slices([len(v) if v else 0 for v in values], _BYTES):
                parts += coder.encode(values[a:b])
            yield [_lists(parts)]

    return with_arrow(df, [text], f"`{out}` array<int>", encode)


def decoded(df: DataFrame, ranks: bytes, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that token ids stand for; null ids count as none."""
    shared = df.sparkSession.sparkContext.broadcast((ranks, pattern, _merges(ranks)))

    def decode(batches):
        coder = _coder(*shared.value)
        for (batch,) in batches:
            values = [np.array(v or (), np.int32) for v in batch.to_pylist()]
            parts = []
            for a, b in _slices([len(v) for v in values], _BYTES // 4):
                parts += coder.decode(values[a:b])
            yield [pa.array(parts, pa.binary())]

    return with_arrow(df, [ids], f"`{out}` binary", decode)


def ids_text(ids: str = "ids") -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(F.col(ids).cast("array<string>"), " ")


def coded(
    df: DataFrame, ranks: bytes, pattern: str, text: str = "text", cached: int = CACHED, texts: int = _TEXTS
) -> DataFrame:
    """Add ``ids`` and ``decoded`` as ``encoded`` and ``decoded`` do, in one worker: the
    ids go to the decoder without a way over the executor. ``cached`` is the number of
    words of a generation that a worker remembers, ``texts`` the number of texts that it
    handles at once: memory against time."""
    shared = df.sparkSession.sparkContext.broadcast((ranks, pattern, _merges(ranks), cached))

    def both(batches):
        coder = _coder(*shared.value)
        for (batch,) in batches:
            values = batch.to_pylist()
            ids, data = [], []
            for a, b in _slices([len(v) if v else 0 for v in values], _BYTES * texts // _TEXTS, texts):
                some = coder.encode(values[a:b])
                ids += some
                data += coder.decode(some)
            yield [_lists(ids), pa.array(data, pa.binary())]

    return with_arrow(df, [text], "ids array<int>, decoded binary", both)


def round_trip(
    df: DataFrame, ranks: bytes, pattern: str, text: str = "text", cached: int = CACHED, texts: int = _TEXTS
) -> DataFrame:
    """Encode each text and decode its ids: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    return coded(df.select("doc_id", text), ranks, pattern, text, cached, texts).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids_text().cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
