"""Packing against the library's ids and a plain first-fit."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from brisa.llm import packing
from tests.llm import brute

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def test_first_fit_is_the_plain_one():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.choice([8, 100, 4096])
        sizes = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 120))]
        tree, rooms = packing.FirstFit(len(sizes), capacity), [capacity] * len(sizes)
        for size in sizes:
            b = next(i for i, room in enumerate(rooms) if room >= size)
            assert tree.put(size) == (b, capacity - rooms[b])
            rooms[b] -= size
        with pytest.raises(ValueError):
            packing.FirstFit(1, 4).put(5)


def test_pieces_tile_items_and_sequences():
    rng = random.Random(6)
    for _ in range(200):
        capacity = rng.choice([8, 64, 4096])
        lengths = [
            rng.randrange(0, 3 * capacity) if rng.random() < 0.2 else rng.randrange(0, capacity // 2)
            for _ in range(rng.randrange(0, 60))
        ]
        pieces, n = packing.pack_lengths(lengths, capacity, capacity // 64)
        for place, total in ((0, lengths), (3, None)):
            spans = defaultdict(list)
            for p in pieces:
                spans[p[place]].append((p[1] if place == 0 else p[4], p[2]))
            for i, own in spans.items():
                own.sort()
                assert [s for s, _ in own] == np.cumsum([0, *[x for _, x in own]])[:-1].tolist()
                end = own[-1][0] + own[-1][1]
                assert end == total[i] if total else end <= capacity
        assert {p[3] for p in pieces} == set(range(n))
        fills = Counter()
        for p in pieces:
            fills[p[3]] += p[2]
        assert all(f >= capacity - capacity // 64 or f & (f - 1) == 0 for f in fills.values())


def test_coder_is_the_library(library):
    with open(PATH, encoding="utf-8") as file:
        spec = file.read()
    assert packing.plain_steps(spec)
    coder = packing.Coder(spec, True, cached=20)
    texts = [
        "", "<|endoftext|> a<|startoftext|>b", "It's don'T WE'RE 's x'd", "日本語 🙂 naïve café x̌", "İstanbul ΣΑΣ ΕΎΣ",
        "a b c\x1cd\x85e", "12 34 !!! ... a1b2 <a|b> <|", "é ́x Å K ﬁ", "a" * 5_000, "{~}|x",
    ]
    rng = random.Random(7)
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(128, 0x3000)])) for _ in range(60)) for _ in range(200)]
    for _ in range(2):
        for t, got in zip(texts, coder.encode(texts), strict=True):
            assert got.tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_query(spark, library):
    sf = "/root/testdata/sf0.01"
    docs = {d["doc_id"]: ids_of(library, d["text"]) for d in brute.documents(sf)}
    rows = entry.queries()["op13_packing"](spark, sf).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own = docs[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length > 0 and r.doc_tokens == len(docs[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, ids in docs.items():
        at = 0
        for start, length in sorted(pieces[doc]):
            assert start == at
            at += length
        assert at == len(ids)
    padding = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding < 0.005 * sum(map(len, docs.values()))


def test_groups_are_bounded_and_salted(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_BYTES", 2_000)
    same = spark.createDataFrame([(1, "the same words in every row " * 3)] * 300, "doc_id long, text string")
    rows = packing.pack(same, PATH, group_tokens=500).collect()
    assert len(rows) >= 300 and sum(r.length for r in rows) == 300 * rows[0].doc_tokens
    assert len({r.sequence_id >> 40 for r in rows}) > 5
    fills = Counter()
    for r in rows:
        fills[r.sequence_id] += r.length
    assert max(fills.values()) < 700  # a group ends soon after 500 tokens


def test_odd_rows(spark, odd, none, library):
    rows = packing.pack(odd, PATH).collect()
    want, got = Counter(), Counter()
    for r in odd.collect():
        want[r.doc_id] += len(ids_of(library, r.text))
    for r in rows:
        got[r.doc_id] += r.length
    assert got == want
    assert packing.pack(none, PATH).count() == 0
    assert packing.pack(odd.where("text IS NULL"), PATH, end_id=None).count() == 0
