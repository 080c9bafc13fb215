"""Pack token ids of documents into sequences of one length.

Documents go to groups at random. In every group a document's tokens are cut into whole
sequences and a rest; the rests are packed by first-fit decreasing: largest first, each
into the first bin that has room. The free room of the bins is the bottom row of a
tournament tree whose inner nodes hold the larger room of their two children, so the
first bin with room is found by one way down.

A sequence is padded to its full length unless its length is a power of two. Bins that
would be padded by more than ``slack`` tokens (mostly a group's last one) are therefore
cut into sequences of powers of two, which need none.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.text import trim

#: Tokens of a sequence.
CAPACITY = 4_096
#: Tokens of a group: what a task holds, with one document's own.
GROUP_TOKENS = 1 << 20
#: Bytes of text in a task, and the most tasks there are (their texts are streamed).
PART_BYTES = 8 << 20
MAX_PARTS = 20_000
#: Words and pieces of words of each of the two generations that a worker remembers (some
#: 200 bytes each), and texts encoded in one call.
CACHED = 300_000
_TOGETHER = 64


class FirstFit:
    """Bins of one capacity as a tournament tree over their free room."""

    def __init__(self, bins: int, capacity: int):
        self.base = 1 << max(0, (bins - 1).bit_length())
        self.room = [capacity] * (2 * self.base)

    def put(self, size: int) -> tuple[int, int]:
        """(bin, place in it) of an item in the first bin with room for it."""
        room, base, node = self.room, self.base, 1
        capacity = room[0]
        if room[1] < size:
            raise ValueError("no bin has room")
        while node < base:
            node *= 2
            if room[node] < size:
                node += 1
        bin_, at = node - base, capacity - room[node]
        left = room[node] - size
        while node:
            room[node] = left
            node //= 2
            left = max(room[2 * node], room[2 * node + 1]) if node else 0
        return bin_, at


def pack_lengths(
    lengths: list[int], capacity: int = CAPACITY, slack: int = CAPACITY // 64
) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Pieces (item, start, length, sequence, offset) of items of these lengths, and the
    number of sequences. Every unit of every item is in one piece; items of length 0 have
    none. Equal lengths go by their place."""
    pieces, sequences, rests = [], 0, []
    for i, n in enumerate(lengths):
        for start in range(0, n - n % capacity, capacity):
            pieces.append((i, start, capacity, sequences, 0))
            sequences += 1
        if n % capacity:
            rests.append((n % capacity, i))
    rests.sort(key=lambda r: (-r[0], r[1]))
    # First-fit fills all bins but one over half.
    tree = FirstFit(min(len(rests), 2 * sum(n for n, _ in rests) // capacity + 2), capacity)
    bins: list[list[tuple[int, int]]] = []
    for n, i in rests:
        b, _ = tree.put(n)
        if b == len(bins):
            bins.append([])
        bins[b].append((n, i))
    for items in bins:
        fill = sum(n for n, _ in items)
        cuts = [fill]
        if capacity - fill > slack and fill & (fill - 1):
            cuts = [1 << k for k in reversed(range(fill.bit_length())) if fill >> k & 1]
        at = 0
        for n, i in items:
            start = lengths[i] - n
            while n:
                part = min(n, cuts[0] - at)
                pieces.append((i, start, part, sequences, at))
                start, n, at = start + part, n - part, at + part
                if at == cuts[0]:
                    cuts.pop(0)
                    sequences, at = sequences + 1, 0
    return pieces, sequences


# The steps in front of the merges that ``Coder`` can take by itself on plain texts.
_NORMAL = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Visible ASCII and the Latin letters of two bytes, which are composed and have one lower case.
_PLAIN = re.compile(r"[\x09-\x0D\x20-~À-ÖØ-öø-ÿ]*")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\s0-9a-zß-öø-ÿ]+")
_SPECIAL = "<|"
_PACKED = [struct.Struct(f"<{n}I").pack for n in range(32)]


def _byte_letters() -> dict[int, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for
    themselves, the others are numbered from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: 256 + i for i, b in enumerate(rest)}


def plain_steps(spec: str) -> bool:
    """Whether a vocabulary drops white space, splits at it and takes the known steps."""
    shape = json.loads(spec)
    parts = (shape.get("normalizer") or {}).get("normalizers", [])
    steps = (shape.get("pre_tokenizer") or {}).get("pretokenizers", [])
    added = shape.get("added_tokens", [])
    return (
        [p["type"] for p in parts] == _NORMAL
        and parts[1]["pattern"] == {"Regex": r"\s+"}
        and [s["type"] for s in steps] == ["Split", "ByteLevel"]
        and steps[0]["pattern"] == {"Regex": _SPLIT}
        and (steps[0]["behavior"], steps[0]["invert"]) == ("Removed", True)
        and not steps[1]["add_prefix_space"]
        and not any(a[k] for a in added for k in ("lstrip", "rstrip", "single_word", "normalized"))
        and all(a["content"].startswith(_SPECIAL) for a in added)
    )


class Coder:
    """Token ids of texts as the tokenizers library gives them, without special tokens
    added. With ``plain`` (see ``plain_steps``) the ids of a piece between splits do not
    depend on its neighbours: new pieces are merged by the library once and remembered for
    two generations, and so are the words they make up. Plain texts are split here, as
    lower case and splits are simple for them; words with other characters go through the
    whole library."""

    def __init__(self, spec: str, plain: bool, cached: int = CACHED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.plain, self.cached, self.letters = plain, cached, _byte_letters()
        self.merge = self.tokenizer.model.tokenize
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _made(self, key: str) -> bytes:
        """Ids of a plain word or piece in lower case, or of any word with a tab in front."""
        if key[0] == "\t":
            ids = self.tokenizer.encode(key[1:], add_special_tokens=False).ids
        else:
            pieces = _PIECE.findall(key)
            if len(pieces) > 1:
                return b"".join([self._ids(p) for p in pieces])
            letters = key if key.isascii() else key.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.merge(letters)]
        return _PACKED[len(ids)](*ids) if len(ids) < len(_PACKED) else struct.pack(f"<{len(ids)}I", *ids)

    def _ids(self, key: str) -> bytes:
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = self._made(key)
            if len(self.new) >= self.cached:
                self.old, self.new = self.new, {}
            self.new[key] = found
        return found

    def _keys(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text) and _SPECIAL not in text:
            return text.lower().split()
        plain = {w: _PLAIN.fullmatch(w) and _SPECIAL not in w for w in set(_WORD.findall(text))}
        return [w.lower() if plain[w] else "\t" + w for w in _WORD.findall(text)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.plain:
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(e.ids, "<u4") for e in found]
        out = []
        for text in texts:
            keys = self._keys(text)
            ids = list(map(self.new.get, keys))
            if None in ids:
                ids = [self._ids(k) if x is None else x for k, x in zip(keys, ids, strict=True)]
            out.append(np.frombuffer(b"".join(ids), "<u4"))
        return out


_worker: dict[str, Coder] = {}


def worker_coder(spec: str, plain: bool) -> Coder:
    """The worker's coder of a vocabulary; it outlives tasks. (A module's function finds the
    module's own store, a function sent with a task would bring an empty copy.)"""
    name = hashlib.sha256(spec.encode()).hexdigest()
    if name not in _worker:
        _worker.clear()
        _worker[name] = Coder(spec, plain)
    return _worker[name]


def grouped(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text) dealt to parts at random, in random order. A row's number salts the
    hash, so repeated rows spread like all others. Null texts are empty."""
    rows = df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(MAX_PARTS, 1 + size // PART_BYTES)
    rows = rows.withColumn("order", F.xxhash64("key", F.monotonically_increasing_id()))
    rows = rows.repartitionById(parts, F.pmod("order", F.lit(parts)).cast("int"))
    return rows.sortWithinPartitions("order").select("key", "text")


def pack(
    df: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int | None = 2,
    capacity: int = CAPACITY,
    slack: int | None = None,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """Pieces of all texts, a row each: (doc_id, start, length, ids, doc_tokens,
    sequence_id, offset). ``ids`` holds the piece's token ids as little-endian unsigned
    32-bit numbers; ``start`` counts the document's ids before it.

    Every id of every whole text, and ``end_id`` after them, lies in exactly one piece;
    the pieces of a sequence follow each other without a gap. A null or empty text has
    ``end_id`` alone, without one it has no piece. Null keys are kept; repeated rows are
    documents of their own; other columns do not matter. An empty table gives no piece.
    A group ends with the document by which it has ``group_tokens`` tokens, so a task
    holds that many and the last document's.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    shared = df.sparkSession.sparkContext.broadcast(spec)
    slack, plain = capacity // 64 if slack is None else slack, plain_steps(spec)
    rows = grouped(df, key, text)
    fields = ["start", "length", "doc_tokens", "sequence_id", "offset"]
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_coder(shared.value, plain)
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 40
        keys: list = []
        ids: list[np.ndarray] = []
        tokens, types = 0, None

        def group() -> pa.RecordBatch:
            nonlocal first, tokens
            pieces, sequences = pack_lengths([len(x) for x in ids], capacity, slack)
            i, start, length, sequence, offset = np.array(pieces, np.int64).reshape(-1, 5).T
            total = np.array([len(x) for x in ids], np.int64)[i]
            raw = [ids[d][s : s + n].tobytes() for d, s, n in zip(i, start, length, strict=True)]
            numbers = dict(zip(fields, (start, length, total, sequence + first, offset), strict=True))
            columns = {"doc_id": pa.array(keys, types).take(pa.array(i)), **numbers, "ids": pa.array(raw, pa.binary())}
            first += sequences
            keys.clear()
            ids.clear()
            tokens = 0
            order = [c.split()[0] for c in schema.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(columns[c]) for c in order], order)

        for batch in batches:
            types = batch.schema.field("key").type
            for at in range(0, batch.num_rows, _TOGETHER):
                some = batch.slice(at, _TOGETHER)
                for k, found in zip(some.column(0), coder.encode(some.column(1).to_pylist()), strict=True):
                    keys.append(k.as_py())
                    ids.append(found if end_id is None else np.append(found, np.array([end_id], "<u4")))
                    tokens += len(ids[-1])
                    if tokens >= group_tokens:
                        yield group()
        if ids:
            yield group()
        trim()

    return rows.mapInArrow(packed, schema)
