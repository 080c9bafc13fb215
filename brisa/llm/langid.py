"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vectors of an n-gram's letters are
permuted by their place (rotated) and bound (multiplied); a text's vector bundles
(adds) those of its n-grams, a language's prototype bundles the unit vectors of its
texts. A document gets the language whose prototype, less the mean of all
prototypes, has the largest cosine with the document's vector less the same mean.
"""

from __future__ import annotations

import hashlib
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.text import hold, trim, with_arrow

DIMENSIONS = 1_024
#: Places of an n-gram's number: its letters' code points (21 bits each, 0 is a gap).
LETTERS = 1 << 21
N = 3
#: Most labelled texts of one language that profiles are learnt from (expected number).
FIT_ROWS = 4_000
#: Most languages: their prototypes are sent to every task.
MAX_LANGUAGES = 1_000
UNDETERMINED = "und"

_tables: dict[str, np.ndarray] = {}


def _letter_table() -> np.ndarray:
    """Lower-case code point of every letter of the basic plane; 0 for what is no letter."""
    if "letters" not in _tables:
        table = np.zeros(0x10000, np.uint32)
        for code in range(0x10000):
            if unicodedata.category(chr(code))[0] == "L":
                table[code] = ord(chr(code).lower()[0])
        _tables["letters"] = table
    return _tables["letters"]


_letters: dict[int, int] = {}
#: Most letters' vectors a worker keeps.
_LETTERS = 8_192
_known: np.ndarray | None = None


def _seeded(letter: int) -> np.ndarray:
    """Random vector of a letter, always the same."""
    bits = hashlib.shake_128(b"letter %d" % letter).digest(DIMENSIONS // 8)
    return np.unpackbits(np.frombuffer(bits, np.uint8)).view(np.int8) * 2 - 1


def _vectors(letters: np.ndarray) -> np.ndarray:
    """Vectors of letters, from the worker's bounded store."""
    global _known
    if _known is None:
        _known = np.empty((_LETTERS, DIMENSIONS), np.int8)
    distinct, at = np.unique(letters, return_inverse=True)
    if len(distinct) > _LETTERS:
        return np.stack([_seeded(x) for x in distinct.tolist()])[at]
    new = [x for x in distinct.tolist() if x not in _letters]
    if len(_letters) + len(new) > _LETTERS:
        _letters.clear()
        new = distinct.tolist()
    for x in new:
        _known[len(_letters)] = _seeded(x)
        _letters[x] = len(_letters)
    return _known[np.array([_letters[x] for x in distinct.tolist()], np.int64)[at]]


_grams: dict[int, int] = {}
#: Most bound n-gram vectors a worker keeps.
_GRAMS = 24_000
_bound: np.ndarray | None = None


def _gram_rows(grams: np.ndarray) -> np.ndarray:
    """Bound vectors of distinct n-grams, from the worker's bounded store."""
    global _bound
    if _bound is None:
        _bound = np.empty((_GRAMS, DIMENSIONS), np.int8)
    if len(grams) > _GRAMS:
        return _bind(grams)
    new = [g for g in grams.tolist() if g not in _grams]
    if len(_grams) + len(new) > _GRAMS:
        _grams.clear()
        new = grams.tolist()
    if new:
        _bound[len(_grams) : len(_grams) + len(new)] = _bind(np.array(new))
        for g in new:
            _grams[g] = len(_grams)
    return _bound[[_grams[g] for g in grams.tolist()]]


def _forget() -> None:
    """Drop what the worker has learnt."""
    global _known, _bound
    _known = _bound = None
    _letters.clear()
    _grams.clear()
    _tables.clear()


def _bind(grams: np.ndarray) -> np.ndarray:
    out = None
    for i in range(N):
        place = np.roll(_vectors(grams // LETTERS ** (N - 1 - i) % LETTERS), N - 1 - i, axis=1)
        out = place if out is None else out * place
    return out


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text's letters and their counts; runs of others are one gap."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = _letter_table()[np.minimum(codes, 0xFFFF)]
    if len(codes) and codes.max() > 0xFFFF:
        for i in np.flatnonzero(codes > 0xFFFF):
            c = chr(codes[i])
            letters[i] = ord(c.lower()[0]) if c.isalpha() else 0
    letters = np.concatenate(([0], letters, [0])).astype(np.int64)
    letters = letters[(letters != 0) | np.concatenate(([True], letters[:-1] != 0))]
    if len(letters) < N or not letters.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    grams = letters[: len(letters) - N + 1].copy()
    for i in range(1, N):
        grams = grams * LETTERS + letters[i : len(letters) - N + 1 + i]
    return np.unique(grams, return_counts=True)


def vector(text: str | None) -> np.ndarray | None:
    """Unit vector of a text, None if it has no letter."""
    grams, counts = gram_counts(text) if text else ((), ())
    if not len(grams):
        return None
    bundle = np.zeros(DIMENSIONS, np.float32)
    for at in range(0, len(grams), 2_048):
        rows = _gram_rows(grams[at : at + 2_048]).astype(np.float32)
        bundle += counts[at : at + 2_048].astype(np.float32) @ rows
    size = np.linalg.norm(bundle)
    return bundle / size if size else None


def fit(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, np.ndarray]:
    """Prototype of every language. Learns from about ``FIT_ROWS`` texts of a language at
    most, chosen by a hash of the key; a language with fewer gives all it has."""
    rows = df.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).cast("string").alias("key"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return {}
    shares = df.sparkSession.createDataFrame(
        [(r.lang, float(min(1.0, FIT_ROWS / r["count"]))) for r in sizes], "lang string, share double"
    )
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / F.lit(1 << 30)
    chosen = rows.join(F.broadcast(shares), "lang").where(place < F.col("share")).select("text", "lang")

    def bundles(batches):
        hold("langid", _forget)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                v = vector(value.as_py())
                if v is not None:
                    sums[label] = sums.get(label, 0) + v.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
            ["lang", "v"],
        )

    partial = chosen.mapInArrow(bundles, "lang string, v array<double>")
    # Texts add up per dimension, combined before the shuffle; one value a dimension is left.
    summed = partial.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    rows = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).collect()
    found = {}
    for r in sorted(rows, key=lambda r: r.lang):
        v = np.array([x.x for x in r.v])
        if (size := np.linalg.norm(v)) > 0:
            found[r.lang] = v / size
    return found


def identify(df: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1: half of one plus the winning cosine).

    Texts that are null or have no letter, and all texts if nothing was learnt, are
    ``und`` with score 0; ties go to the language that is first by name. Columns of
    these names are replaced, all others kept, repeated rows stay rows.
    """
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] for n in names]).reshape(len(names), DIMENSIONS)
    centre = matrix.mean(axis=0) if len(names) > 1 else np.zeros(DIMENSIONS)
    matrix = matrix - centre
    if names:
        matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    shared = df.sparkSession.sparkContext.broadcast((names, matrix, centre))  # at most MAX_LANGUAGES vectors

    def predict(batches):
        hold("langid", _forget)
        names, matrix, centre = shared.value
        for (texts,) in batches:
            langs, scores = [], []
            for value in texts:
                v = vector(value.as_py()) if names else None
                if v is None:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                v = v - centre
                cosines = matrix @ v / max(float(np.linalg.norm(v)), 1e-12)
                best = int(np.argmax(cosines))
                langs.append(names[best])
                scores.append(float(min(1.0, max(0.0, (1 + cosines[best]) / 2))))
            yield [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
        trim()

    return with_arrow(df, [text], "lang_pred string, score double", predict)


def held_out(key: str = "doc_id", folds: int = 5):
    """Whether a row is kept from learning: crc32 of its key as text, modulo folds, is 0."""
    crc = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return F.pmod(crc, F.lit(folds)) == 0


def identify_held_out(df: DataFrame, text="text", lang="lang", key="doc_id") -> DataFrame:
    """Learn from the rows that are not held out and predict every row."""
    prototypes = fit(df.where(~held_out(key)), text, lang, key)
    return identify(df.withColumn("held_out", held_out(key)), prototypes, text)
