"""Every registered query of the subpackage, against SQL or a plain version."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

import __spark_entry__ as entry
import check
import corpus_pipeline
from brisa.llm import bpe, winnow
from tests.llm import brute
from tests.llm.test_alike import leaders


def run(spark, sf, name):
    return entry.queries()[name](spark, sf).collect()


@pytest.mark.parametrize("name", ["op1_quality_rules", "op4_suffix_dedup", "op5_warc", "op9_mixing"])
def test_sql(spark, sf, name):
    verdict, detail, _ = check.compare(spark, check.oracle_connection(sf), name, sf)
    assert verdict == "ok", detail


def test_quality(spark, sf):
    docs = {d["doc_id"]: d["text"] for d in brute.documents(sf)}
    rows = run(spark, sf, "op1_quality_rules")
    assert len(rows) == len(docs)
    for r in rows:
        figures = brute.base_figures(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == figures
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_quality_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    good = {x["doc_id"]: x["quality"] for x in brute.documents(sf, "labels")}
    rows = [r for r in run(spark, sf, "op1_quality_rules") if r.doc_id in good and not r.base_failed]
    kept = [r.kept for r in rows if good[r.doc_id] == 1]
    leaked = [r.kept for r in rows if good[r.doc_id] == 0]
    assert np.mean(kept) > 0.98 and np.mean(leaked) < 0.1


def test_simhash(spark, sf):
    docs = sorted(brute.documents(sf), key=lambda d: d["doc_id"])
    fps = [brute.simhash(d["text"]) for d in docs]
    first = [docs[i]["doc_id"] for i in brute.components(fps)]
    want = {d["doc_id"]: (f"{f:016x}", c) for d, f, c in zip(docs, fps, first)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, sf, "op2_simhash")} == want


def test_fingerprints(spark, sf):
    docs = sorted(brute.documents(sf), key=lambda d: d["doc_id"])
    rows = {r.doc_id: r for r in run(spark, sf, "op3_fingerprints")}
    assert len(rows) == len(docs)
    for d, after in zip(docs, docs[1:] + docs[:1]):
        text, r = d["text"], rows[d["doc_id"]]
        edited = text[: len(text) - len(text) // 2] + after["text"][: len(text) // 2]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (set(winnow.winnow(t)[0].tolist()) for t in (text, edited, after["text"]))
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b))
        assert r.near_next == pytest.approx(len(a & c) / len(a | c))


def test_language(spark):
    sf = "/root/testdata/sf0.01"
    truth = {d["doc_id"]: d["lang"] for d in brute.documents(sf)}
    rows = [r for r in run(spark, sf, "op6_language_id")]
    assert len(rows) == len(truth)
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]) > 0.97


def test_tokens(spark, sf):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs = {d["doc_id"]: d["text"] for d in brute.documents(sf)}
    for r in run(spark, sf, "op7_token_counts"):
        assert (r.n_bytes, r.n_tokens) == (len(docs[r.doc_id].encode()), len(sp.encode(docs[r.doc_id])))
        assert r.over_limit == (r.n_tokens > 4096)


def test_shards(spark):
    sf = "/root/testdata/sf0.01"
    rows = run(spark, sf, "op8_sharding")
    docs = brute.documents(sf)
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((d["doc_id"], len(d["text"].encode()) + 1) for d in docs)
    loads = Counter()
    for r in rows:
        loads[r.shard] += r["size"]
    mean = sum(loads.values()) / 8
    assert max(loads.values()) < 1.01 * mean and min(loads.values()) > 0.95 * mean
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def encoding():
    ranks = bpe.ranks_of(bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_row(own, doc, text):
    ids = own.encode_ordinary(text or "")
    sha = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), own.decode_bytes(ids))]
    return (doc, len(ids), *sha)


def test_bpe(spark, sf):
    own = encoding()
    want = {token_row(own, d["doc_id"], d["text"]) for d in brute.documents(sf)}
    assert {tuple(r) for r in run(spark, sf, "op10_bpe")} == want


def plain_bpe(ranks, word):
    """Ids of a word: the leftmost pair of least rank is merged until there is none."""
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, 10**9), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 10**9:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


@pytest.mark.parametrize("seed", range(6))
def test_bpe_of_made_vocabularies(seed):
    """Ranks in any order, so that merged tokens often make tokens of lesser rank."""
    rng = random.Random(seed)
    tokens = [bytes([b]) for b in range(256)]
    for _ in range(150):
        made = b"".join(rng.choices(tokens[-60:] if rng.random() < 0.6 else [b"a", b"b", b"c"], k=2))
        if made not in tokens and len(made) < 9:
            tokens.append(made)
    made = {bytes(t) for t in tokens[256:]} | {bytes(rng.choices(b"abc", k=rng.randrange(2, 5))) for _ in range(60)}
    order = sorted(made, key=lambda t: (len(t) * (seed % 2), rng.random()))
    ranks = {t: i for i, t in enumerate([bytes([b]) for b in range(256)] + order)}
    words = list({"".join(rng.choices("abc", k=rng.randrange(1, 30))) for _ in range(400)})
    data = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
    got = bpe.Coder(data, r"\S+").encode(words)
    for word, ids in zip(words, got, strict=True):
        whole = ranks.get(word.encode())
        assert ids.tolist() == ([whole] if whole is not None else plain_bpe(ranks, word.encode()))


def test_bpe_remembers(monkeypatch):
    """Half a million words that come round again are contracted once."""
    coder = bpe.Coder(bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")), r"\S+")
    contracted = []
    monkeypatch.setattr(coder, "_contract", lambda raw: contracted.append(len(raw)) or [b""] * len(raw))
    batches = [" ".join(f"z{i:07}" for i in range(a, a + 50_000)) for a in range(0, 500_000, 50_000)]
    for text in batches + batches:
        coder.encode([text])
    assert sum(contracted) == 500_000


def test_bpe_decodes():
    """All bytes, texts without tokens in any place, ids that the vocabulary lacks."""
    coder = bpe.Coder(bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")), r"\S+")
    every = np.array([coder.ranks[bytes([b])] for b in range(256)], np.int32)
    none = np.empty(0, np.int32)
    strange = np.array([-1, 2**31 - 1, coder.ranks[b"a"], 2**31 - 1], np.int32)
    back = every[::-1].copy()
    got = coder.decode([none, every, none, strange, back, none])
    assert got == [b"", bytes(range(256)), b"", b"a", bytes(range(255, -1, -1)), b""]
    assert coder.decode([]) == [] and coder.decode([none]) == [b""]


def test_bpe_rounds(monkeypatch):
    """A round contracts all that is sure, not one rank of a word."""
    monkeypatch.setattr(bpe, "ROWS", 0)  # four rounds a query
    coder = bpe.Coder(bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")), r"\S+")

    class Counted:
        db, queries = coder.db, 0

        def __getattr__(self, name):
            return getattr(self.db, name)

        def execute(self, sql):
            self.queries += 1
            return self.db.execute(sql)

    coder.db = Counted()
    text = "counterrevolutionaryinstitutionalizationmisunderstandingsextraordinarilyphotosynthesiscommunication"
    (ids,) = coder.encode([text])
    assert ids.tolist() == plain_bpe(coder.ranks, text.encode())
    assert coder.db.queries <= 10


def test_pipeline(spark, sf):
    docs = sorted(brute.documents(sf), key=lambda d: d["doc_id"])
    docs = [d for d in docs if any(c.isalpha() for c in d["text"])]
    kept_ids = leaders([d["text"] for d in docs])  # Jaccard of five-word shingles, as in test_alike
    docs = [d for i, d in enumerate(docs) if i in kept_ids]
    kept = brute.kept_bytes([d["text"] for d in docs])
    rows = [(d["doc_id"], d["source"], k.decode("utf-8", "ignore")) for d, (k, _, _) in zip(docs, kept)]
    own, want = encoding(), Counter()
    for doc, text, low, high in brute.mixed(rows):
        words = brute.WORD.findall(text)
        want[token_row(own, doc, text if high - low == len(words) else " ".join(words[low:high]))] += 1
    got = Counter(tuple(r) for r in run(spark, sf, "pipeline"))
    assert got == want


def test_stages(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "repeated_passages", "mixed_sources", "tokenized",
    ]
    assert corpus_pipeline.ORACLE_SQL is None
