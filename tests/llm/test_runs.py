"""Periodic runs against a plain search."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from brisa.llm import runs
from tests.llm import brute


def plain(w):
    """Every run, period by period; the smallest period of a stretch names it."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        k = 0
        while k < len(w) - q:
            s = k
            while k < len(w) - q and w[k] == w[k + q]:
                k += 1
            if k + q - s >= max(12, 2 * q):
                out.setdefault((s, k + q), q)
            k += 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def made(rng):
    """A text of noise, powers and copies of its own end."""
    letters, w = rng.choice([1, 2, 2, 3, 5, 30]), []
    noise = lambda n: [str(rng.randrange(letters)) for _ in range(n)]
    while len(w) < rng.randrange(0, 150):
        kind = rng.random()
        if kind < 0.4:
            w += noise(rng.randrange(1, 30))
        elif kind < 0.8:
            w += noise(rng.randrange(1, 20)) * rng.randrange(1, 6)
        elif w:
            w += w[-rng.randrange(1, len(w) + 1) :]
    return w


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_made_texts(seed):
    rng = random.Random(seed)
    texts = [made(rng) for _ in range(250)]
    found = list(runs.analysed([" ".join(w).encode() for w in texts]))
    for w, (n, got, collapsed) in zip(texts, found, strict=True):
        assert n == len(w) and got == plain(w)
        dropped = {i for s, length, q in got for i in range(s + q, s + length)}
        assert collapsed.decode().split() == [x for i, x in enumerate(w) if i not in dropped]


def test_grammar_derives_the_text():
    rng = random.Random(9)
    ids = [rng.randrange(4) for _ in range(3_000)] + [5] * 501
    g = runs.re_pair(runs.np.array(ids), 6)

    def derived(s):
        return [s] if s < 6 else derived(g.left[s - 6]) + derived(g.right[s - 6])

    assert [x for s in g.top for x in derived(s)] == ids
    pairs = [(a, b) for a, b in zip(g.top[:-1], g.top[1:]) if a != b]
    assert len(pairs) == len(set(pairs))


def test_query_text_by_text(spark, sf):
    import __spark_entry__ as entry

    rows = {r.doc_id: r for r in entry.queries()["op11_periodic_runs"](spark, sf).collect()}
    for d in brute.documents(sf):
        w, h = brute.WORD.findall(d["text"] or ""), zlib.crc32(str(d["doc_id"]).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        want, r = plain(w), rows[d["doc_id"]]
        assert r.n_runs == len(want)
        if want:
            best = min(want, key=lambda x: (-x[1], x[0], x[2]))
            assert (r.start, r.length, r.period) == best and r.exponent_milli == 1000 * best[1] // best[2]
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4


def test_long_texts_take_no_square_of_time():
    for text, many in ((b"a " * 200_000, 1), (b"lorem ipsum " * 100_000, 1)):
        ((_, found, collapsed),) = runs.analysed([text])
        assert len(found) == many and len(collapsed.split()) == found[0][2]


def test_odd_rows(spark, odd, none):
    found = runs.periodic_runs(odd.withColumn("runs", F.lit("extra"))).collect()
    assert len(found) == odd.count()
    for r in found:
        w = brute.WORD.findall(r.text or "")
        assert r.n_words == len(w) and [tuple(x) for x in r.runs] == plain(w[:400] if len(w) > 400 else w) or len(w) > 400
        assert r.fp == "extra"
    assert {r.collapsed for r in found if not (r.text or "").split()} == {""}
    long = next(r for r in found if r.doc_id == 7)
    assert [tuple(x) for x in long.runs] == [(0, 8_000, 2)] and long.collapsed == "lorem ipsum"
    assert runs.periodic_runs(none).count() == 0
