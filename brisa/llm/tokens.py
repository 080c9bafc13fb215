"""Token counts by a two-tier lookup of pre-token lengths.

Spaces end a piece and line breaks stand alone in the vocabularies this accepts, so
a text's token count is the sum over its pre-tokens (a run of spaces with the word
after it). Nearly all pre-tokens of a corpus are few distinct ones: a bounded table of
frequent pre-tokens and their lengths is broadcast, misses are encoded once per worker
and kept in a bounded cache. The frequent ones are counted over all texts: a task's
bounded summary is all that is shuffled.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.text import n_bytes

_SPACE = "▁"
_PRETOKEN = re.compile(f"{_SPACE}*[^{_SPACE}\n]+|{_SPACE}+")
_SUMMARY = pa.schema([("w", pa.string()), ("n", pa.int64())])

#: Most entries of the broadcast table.
FREQUENT = 32_768
#: Most code points of a pre-token in the table and in a cache: with that, both are bounded
#: in bytes. Longer ones are encoded every time.
LONGEST = 64
#: Pre-tokens a task counts side by side; of more, the rarer half is forgotten.
COUNTED = 4 * FREQUENT
#: Tasks that merge the summaries, and so the tables that the driver gets.
_MERGED = 8
#: Most pre-tokens a worker remembers beside the table.
CACHED = 300_000
#: Texts whose misses are encoded in one call.
_TOGETHER = 64


def _processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_model(model: bytes) -> None:
    """Refuse a vocabulary whose pieces may reach across pre-tokens."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    spec = pb.ModelProto()
    spec.ParseFromString(model)
    norm = spec.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
        raise ValueError("the model must keep texts as they are and add one space in front")
    for piece in spec.pieces:
        if piece.type == piece.USER_DEFINED or (
            piece.type == piece.NORMAL
            and (_SPACE in piece.piece.lstrip(_SPACE) or ("\n" in piece.piece and len(piece.piece) > 1))
        ):
            raise ValueError(f"piece {piece.piece!r} may reach across pre-tokens")


def pretokens(text: str) -> list[str]:
    """Pre-tokens of a non-empty text, without its line breaks."""
    return _PRETOKEN.findall(_SPACE + text.replace(" ", _SPACE))


def _lengths(sp, found: list[str]) -> list[int]:
    """Token counts of pre-tokens. The library puts a space in front: it stands for the
    pre-token's own first space, or else a line break shields the word from it."""
    plain = [
        w[1:].replace(_SPACE, " ") if w[0] == _SPACE and len(w) > 1 else "\n" + w.lstrip(_SPACE)
        for w in found
    ]
    ids = sp.encode(plain, num_threads=1)
    return [
        len(i) if w[0] == _SPACE and len(w) > 1 else 1 if w == _SPACE else len(i) - 2
        for w, i in zip(found, ids, strict=True)
    ]


def frequent_pretokens(df: DataFrame, text: str) -> list[str]:
    """The most frequent pre-tokens of all texts, sorted. A task counts at most ``COUNTED``
    of them and hands on its ``FREQUENT`` first, so that one which is rare in every task
    may be missed; only speed depends on that."""
    rows = df.select(F.col(text).alias("text")).where(F.col("text").isNotNull())

    def tops(batches):
        seen: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value:
                    seen.update(w for w in pretokens(value) if len(w) <= LONGEST)
                if len(seen) > COUNTED:
                    seen = Counter(dict(seen.most_common(COUNTED // 2)))
        best = seen.most_common(FREQUENT)
        yield pa.RecordBatch.from_pydict({"w": [w for w, _ in best], "n": [n for _, n in best]}, _SUMMARY)

    def first(batches):
        best: list[tuple[int, str]] = []
        for batch in batches:
            counts = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True)
            best = heapq.nlargest(FREQUENT, [*best, *counts])
        yield pa.RecordBatch.from_pydict({"w": [w for _, w in best], "n": [n for n, _ in best]}, _SUMMARY)

    merged = rows.mapInArrow(tops, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    found = merged.coalesce(_MERGED).mapInArrow(first, "w string, n long").collect()  # at most _MERGED * FREQUENT
    return sorted(r.w for r in heapq.nlargest(FREQUENT, found, key=lambda r: (r.n, r.w)))


def frequent_lengths(df: DataFrame, text: str, model: bytes) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens."""
    best = frequent_pretokens(df, text)
    return dict(zip(best, _lengths(_processor(model), best), strict=True)) if best else {}


_worker: dict[str, tuple[object, dict[str, int]]] = {}


def worker_cache(key: str, proto: bytes) -> tuple[object, dict[str, int]]:
    """The worker's processor and cache of a vocabulary; they outlive tasks. (A module's
    function finds the module's own store, a function sent with a task an empty copy.)"""
    if key not in _worker:
        _worker.clear()
        _worker[key] = (_processor(proto), {})
    return _worker[key]


def count_tokens(df: DataFrame, model_path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Add the number of tokens that the vocabulary's own library gives for each whole
    text, without begin, end or added special tokens.

    Null and empty texts have 0. Repeated rows keep their rows; other columns stay, and
    an existing column called ``out`` is replaced. An empty table gives an empty table.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    check_model(model)
    context = df.sparkSession.sparkContext
    table = frequent_lengths(df, text, model)
    names = list(table)
    # Compact: one text of all pre-tokens (none holds a line break) and one byte string.
    shared = context.broadcast(("\n".join(names), [table[w] for w in names], model))
    key = hashlib.md5(model).hexdigest()

    @F.pandas_udf("long")
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        joined, sizes, proto = shared.value
        frequent = dict(zip(joined.split("\n"), sizes, strict=True)) if sizes else {}
        sp, cache = worker_cache(key, proto)
        for batch in batches:
            counts = []
            values = batch.to_list()
            for at in range(0, len(values), _TOGETHER):
                huge: list[str] = []
                split = [pretokens(v) if v else [] for v in values[at : at + _TOGETHER]]
                misses = {w for ws in split for w in ws if w not in frequent and w not in cache}
                if misses:
                    if len(cache) + len(misses) > CACHED:
                        cache.clear()
                        misses = {w for ws in split for w in ws if w not in frequent}
                    todo = list(misses)
                    cache.update(zip(todo, _lengths(sp, todo), strict=True))
                    huge = [w for w in todo if len(w) > LONGEST]
                for v, ws in zip(values[at : at + _TOGETHER], split, strict=True):
                    breaks = v.count("\n") if v else 0
                    counts.append(breaks + sum(frequent[w] if w in frequent else cache[w] for w in ws))
                for w in huge:
                    cache.pop(w, None)
            yield pd.Series(counts, dtype="int64")

    return df.withColumn(out, lengths(F.col(text)))


def over_limit(df: DataFrame, limit: int, tokens: str = "n_tokens") -> DataFrame:
    """Add the size in bytes and whether a text has more than ``limit`` tokens."""
    return df.withColumn("n_bytes", n_bytes(F.col("text"))).withColumn("over_limit", F.col(tokens) > limit)
