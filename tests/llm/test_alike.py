"""The pipeline's near duplicates against plain Jaccard similarities."""

import random

import numpy as np
import pytest

import corpus_pipeline
from brisa.llm import alike, simhash
from tests.llm import brute


def five(text):
    w = brute.WORD.findall(brute.lower(text))
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def leaders(texts):
    """Index of the first text of each group that similarities of 0.8 or more connect."""
    sets, parent = [five(t) for t in texts], list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i for i in range(len(texts)) if find(i) == i}


def table(spark, texts):
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def prose(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def repeated_line(n=12):
    """Texts that are half one shared line, over and over, and else have nothing in common."""
    rng = random.Random(3)
    line = prose(rng, 5)
    return [" ".join(line * 40 + prose(rng, 200)) for _ in range(n)]


def test_alike_links():
    rng = random.Random(5)
    base = [prose(rng, rng.randrange(5, 80)) for _ in range(25)]
    texts = [" ".join(w if rng.random() > e else "x" for w in b) for b in base for e in (0, 0.01, 0.04, 0.1)]
    texts += ["", "one two", "One  TWO", "one two three"]
    texts = list({alike.shingles(t).tobytes(): t for t in texts}.values())
    links = alike.alike_links([alike.shingles(t) for t in texts])
    parent = list(range(len(texts)))
    for a, b in links:
        low, high = sorted((parent[a], parent[b]))
        parent = [low if p == high else p for p in parent]
    assert {i for i, p in enumerate(parent) if p == i} == leaders(texts)
    assert len(links) == len(texts) - len(leaders(texts))


@pytest.mark.parametrize("block", [alike.BLOCK, 5])
def test_a_repeated_line_is_no_near_copy(spark, sf, block):
    texts = repeated_line()
    texts += [texts[0] + " end", texts[3] + " end"]
    fps = [simhash.fingerprint(t) for t in texts]
    assert any((fps[0] ^ f).bit_count() <= simhash.BITS for f in fps[1:12])  # fingerprints link them
    got = {r.doc_id for r in alike.leaders(table(spark, texts), block=block).collect()}
    assert got == leaders(texts) == set(range(12))
    if block == alike.BLOCK:
        assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, table(spark, texts), sf).collect()} == got


def scattered(texts=60):
    """Texts of 100 to 1,000 words and a copy of each with 1 to 5 % of the words replaced."""
    rng = random.Random(11)
    out = []
    for i in range(texts):
        words = prose(rng, (100, 300, 1_000)[i % 3])
        edits = rng.sample(range(len(words)), max(1, len(words) * (1 + i % 5) // 100))
        out += [" ".join(words), " ".join("edit" if k in edits else w for k, w in enumerate(words))]
    return out


@pytest.mark.parametrize("block", [alike.BLOCK, 1])
def test_copies_with_scattered_edits(spark, sf, block):
    texts = scattered()
    want = leaders(texts)
    fps = [simhash.fingerprint(t) for t in texts]
    gone = [i for i in range(len(texts)) if i not in want]
    assert len(gone) > 20
    assert sum((fps[i] ^ fps[i - 1]).bit_count() > simhash.BITS for i in gone) > len(gone) / 2  # too far for fingerprints
    assert {r.doc_id for r in alike.leaders(table(spark, texts), block=block).collect()} == want


def test_recall_of_bands():
    """Pairs at the least similarity share a band."""
    rng = np.random.default_rng(2)
    for _ in range(500):
        sets = rng.integers(0, 2**63, 90, dtype=np.uint64)
        a, b = alike.bands(sets[:81]), alike.bands(sets[9:])  # 72 of 90 shared
        assert (a == b).any()
    assert not len(alike.bands(alike.shingles("")))


def test_fingerprint_of_a_set():
    text = "One two  three four five six one TWO three four five"
    assert alike.fingerprint(alike.shingles("")) == 0
    hashes = alike.shingles(text).tolist()
    assert len(hashes) == 6 and len(five(text)) == 6
    want = sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > 6)
    assert alike.fingerprint(alike.shingles(text)) == want
    again = text + " six one two three four five"  # only repeats: the same set
    assert alike.fingerprint(alike.shingles(again)) == want


def test_candidates_by_fingerprints(spark, sf, monkeypatch):
    """Golay keys alone lead to near copies: no pair within 4 bits is missed, most up to REACH."""
    monkeypatch.setattr(alike, "shared_bands", lambda rows: spark.createDataFrame([], "u long, v long"))
    rng = random.Random(4)
    texts = []
    for _ in range(40):
        words = prose(rng, 400)
        texts += [" ".join(words), " ".join("edit" if k in (90, 300) else w for k, w in enumerate(words))]
    fps = [alike.fingerprint(alike.shingles(t)) for t in texts]
    apart = [(fps[i] ^ fps[i + 1]).bit_count() for i in range(0, len(texts), 2)]
    got = {r.doc_id for r in alike.leaders(table(spark, texts)).collect()}
    assert {2 * i for i in range(40)} <= got
    missed = [d for i, d in enumerate(apart) if 2 * i + 1 in got]
    assert not [d for d in missed if d <= simhash.BITS] and len(missed) < 4
    assert any(d > simhash.BITS for d in apart)
    # Different sets of one fingerprint are candidates as well.
    rows = spark.createDataFrame([(1, 7), (2, 7), (3, 7), (3, 7), (4, -1)], "node long, fp long")
    assert {(r.u, r.v) for r in alike.near_fingerprints(rows).collect()} == {(2, 1), (3, 1)}


def test_every_near_copy_of_the_table(spark, sf):
    docs = sorted(brute.documents(sf), key=lambda d: d["doc_id"])
    kept = {docs[i]["doc_id"] for i in leaders([d["text"] for d in docs])}
    got = corpus_pipeline.near_duplicates(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    assert {r.doc_id for r in got.collect()} == kept
