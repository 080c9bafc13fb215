"""Edge cases of each operator, and the paths that small tables do not take."""

import gzip
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brisa.llm import bpe, components, langid, mixing, quality, shards, simhash, suffixes, tokens, warc, winnow
from tests.llm import brute

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def texts(df):
    return [r.text for r in df.select("text").collect()]


# -- quality


def test_quality_odd(odd, none):
    table, model = quality.judged(odd, keep=["doc_id", "text", "score"])
    rows = table.collect()
    assert Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == Counter(
        map(brute.base_figures, texts(odd))
    )
    assert {"score", "kept", "posterior"} <= set(table.columns)
    assert not any(r.kept for r in rows if not r.text)
    empty, model = quality.judged(none)
    assert empty.count() == 0 and model["prior"] == pytest.approx(quality.START)


def test_em_finds_accuracies(spark):
    random.seed(3)
    drop_good, drop_bad = (0.02, 0.05, 0.05, 0.1), (0.9, 0.8, 0.7, 0.8)
    seen = Counter()
    for _ in range(20_000):
        bad = random.random() < 0.3
        chance = drop_bad if bad else drop_good
        seen[tuple(0 if random.random() < 0.2 else -1 if random.random() < c else 1 for c in chance)] += 1
    rows = spark.createDataFrame([(list(v), n) for v, n in seen.items()], "votes array<int>, n long")
    model = quality.fit(rows, 4)
    assert model["prior"] == pytest.approx(0.7, abs=0.02)
    assert model["good"][0::2] == pytest.approx(drop_good, abs=0.02)
    assert model["bad"][0::2] == pytest.approx(drop_bad, abs=0.03)


# -- simhash


def test_golay_decodes_three_errors():
    table = simhash.decoder()
    data = np.arange(4096)
    sizes = np.bincount(table, minlength=4096)
    assert (sizes == 2048).all() and len(data) == 4096


@pytest.mark.parametrize("bits", range(5))
def test_keys_meet(bits):
    rng = random.Random(bits)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for i in rng.sample(range(64), bits):
            b ^= 1 << i
        k, owner = simhash.fuzzy_keys(np.array([a, b], np.uint64))
        assert set(k[owner == np.uint64(a)]) & set(k[owner == np.uint64(b)])


def near_family(n=400):
    rng = random.Random(5)
    out = set()
    for centre in (0, rng.getrandbits(64), 2**64 - 1):
        while len(out) % n != n - 1:
            f = centre
            for i in rng.sample(range(64), rng.choice((1, 2, 3, 4, 7))):
                f ^= 1 << i
            out.add(f)
        out.add(centre)
    return sorted(out)


@pytest.mark.parametrize("block", [8_192, 16])
def test_links_connect(spark, sf, block):
    fps = near_family()
    df = spark.createDataFrame([(f - (f >> 63 << 64),) for f in fps], "fp long")
    links = simhash.near_links(df, block=block)
    found = {r.node: r.component for r in components.components(links).collect()}
    got = Counter(found.get(f - (f >> 63 << 64), f - (f >> 63 << 64)) for f in fps)
    want = Counter(brute.components(fps))
    assert sorted(got.values()) == sorted(want.values())
    pairs = [(r.u % 2**64, r.v % 2**64) for r in links.collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in pairs)


def test_components_of_a_path_and_no_links(spark, sf):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(90, 80), (80, 90), (7, 7)], "u long, v long")
    found = {r.node: r.component for r in components.components(links).collect()}
    assert found == {**{i: 0 for i in range(51)}, 80: 80, 90: 80}
    assert components.components(links.where("false")).count() == 0


def test_simhash_odd(odd, none):
    rows = simhash.groups(odd).collect()
    fps = {(r.doc_id, r.fp % 2**64) for r in rows}
    assert fps == {(r.doc_id, brute.simhash(r.text)) for r in odd.collect()} and len(rows) == odd.count()
    empty = [r for r in rows if r.fp == 0]
    assert {r.component_id for r in empty} == {2}
    assert simhash.groups(none).count() == 0
    lead = simhash.leaders(odd)
    assert lead.columns == odd.columns
    assert lead.count() == len({r.component for r in rows})


# -- winnowing


def test_winnow_guarantee_and_ties():
    rng = random.Random(1)
    letters = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    shared = letters(winnow.K + winnow.WINDOW - 1)
    a, b = letters(300) + shared + letters(200), letters(77) + shared + letters(500)
    (ha, pa), (hb, pb) = winnow.winnow(a), winnow.winnow(b)
    both = {(int(h), int(p) - 300) for h, p in zip(ha, pa)} & {(int(h), int(p) - 77) for h, p in zip(hb, pb)}
    assert any(0 <= p < winnow.WINDOW for _, p in both)
    _, p = winnow.winnow("a" * 200)
    assert p.tolist() == list(range(winnow.WINDOW - 1, 200 - winnow.K + 1))


def test_winnow_blocks(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice("ab cé🙂") for _ in range(3_000))
    h, p = winnow.winnow(text)
    monkeypatch.setattr(winnow, "_BLOCK", 100)
    h2, p2 = winnow.winnow(text)
    assert (h == h2).all() and (p == p2).all()


def test_fingerprints_odd(odd, none):
    rows = winnow.fingerprints(odd.withColumn("fp_hashes", F.lit(1)))
    assert rows.count() == odd.count() and set(odd.columns) < set(rows.columns)
    assert [r for r in rows.collect() if not r.text and r.fp_hashes] == []
    assert winnow.edit_likeness(odd).count() == odd.count()
    assert winnow.edit_likeness(none).count() == 0
    one = winnow.edit_likeness(odd.where("doc_id = 7")).collect()[0]
    assert one.near_next == 1.0


def test_next_row_across_parts(spark, sf, monkeypatch):
    monkeypatch.setattr(winnow, "PART_BYTES", 400)
    rows = [(None if i == 3 else i // 2, f"text {i} " * (i % 7), i) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, x int").repartition(7)
    parts, n = winnow.in_order(df, "doc_id", "text")
    assert n > 3
    marks = {r.text: r.mark for r in parts.select("text", "mark").collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, marks[r[1]]))
    got = Counter((r.doc_id, r.edited_sha256) for r in winnow.edit_likeness(df).collect())
    want = Counter()
    for (d, t, _), (_, after, _) in zip(order, order[1:] + order[:1]):
        want[d, hashlib.sha256(winnow.edited(t, after).encode()).hexdigest()] += 1
    assert got == want


# -- suffixes


def test_named_suffixes_blocks(monkeypatch):
    rng = random.Random(4)
    data = bytes(rng.choice(b"abcd ") for _ in range(5_000)) + b"z" * 900
    whole = np.concatenate(suffixes.suffix_rows(1, 2, data))
    starts = sorted((int(r["x"]) - int(a)) for r in whole for a in range(r["alo"], r["ahi"] + 1))
    assert starts == list(range(len(data) - 199))
    monkeypatch.setattr(suffixes, "_BLOCK", 700)
    assert (np.concatenate(suffixes.suffix_rows(1, 2, data)) == whole).all()


def test_multikey_quicksort():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5, 30_000).astype(np.uint64), rng.integers(0, 1000, 30_000).astype(np.uint64)
    order = suffixes.multikey_quicksort([a, b], small=50)
    assert sorted(order.tolist()) == list(range(30_000))
    assert (np.diff(a[order].astype(np.int64) * 1000 + b[order].astype(np.int64)) >= 0).all()


def passages(n=40):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 9)))
    line = lambda k: " ".join(word() for _ in range(k))
    shared = [line(60), line(38), line(45), "x" * 450, line(20)]
    rows = []
    for i in range(n):
        parts = [line(rng.randint(0, 30)), rng.choice(shared), line(rng.randint(0, 5)), rng.choice(shared), line(3)]
        rows.append((i, " ".join(parts)))
    return rows + [(n, rows[0][1]), (n + 1, "short"), (n + 2, None), (n + 3, rows[1][1] + rows[1][1])]


@pytest.mark.parametrize("bucket, class_", [(250_000, 16_384), (60, 16_384), (60, 3)])
def test_repeats(spark, sf, bucket, class_):
    rows = passages()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in suffixes.without_repeats(df, bucket=bucket, class_=class_).collect()}
    for (doc, _), (kept, removed, spans) in zip(rows, brute.kept_bytes([t for _, t in rows])):
        r = got[doc]
        assert (bytes(r.kept), r.removed_bytes, r.removed_spans) == (kept, removed, spans)


def test_repeats_odd(odd, none):
    got = suffixes.without_repeats(odd)
    want = Counter(brute.kept_bytes([r.text for r in odd.collect()]))
    assert Counter((bytes(r["kept"]), r.removed_bytes, r.removed_spans) for r in got.collect()) == want
    assert suffixes.without_repeats(none).count() == 0


# -- WARC


def test_warc_odd(spark, odd, none, tmp_path):
    pages = odd.selectExpr("doc_id AS page_id", "'http://x/?q=\n' || source AS url", "text AS html", "fp")
    pages = pages.unionByName(pages.where("page_id = 1").selectExpr("20L AS page_id", "url", "html", "fp"))
    warc.write_warc(warc.page_records(pages), f"{tmp_path}/a")
    back = warc.read_warc(spark, f"{tmp_path}/a")
    key = warc.page_key("record_id").alias("page_id")
    rows = back.select("*", key).collect()
    assert len(rows) == odd.count() + 1
    by = {r.page_id: r for r in rows}
    assert (by[5].record_type, by[5].refers_to, by[5].payload) == ("revisit", "urn:page:1", None)
    assert by[5].payload_bytes == by[1].payload_bytes == len(by[1].payload)
    assert by[7].payload == texts(odd.where("doc_id = 7"))[0].encode()
    assert by[1].payload_digest == warc.base32(hashlib.sha1(by[1].payload).digest())
    plain = lambda d: sorted((r.record_id, r.payload or b"", r.payload_bytes) for r in d.collect())
    warc.write_warc(warc.page_records(pages), f"{tmp_path}/u", compression="none")
    assert plain(warc.read_warc(spark, f"{tmp_path}/u")) == plain(back)
    files = [f for f in (tmp_path / "a").iterdir() if f.name.endswith(".warc.gz")]
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert whole.count(b"WARC/1.1\r\n") == len(rows)  # other readers see one stream
    heads = warc.read_warc(spark, f"{tmp_path}/a", payload=False).where("record_type = 'response'")
    assert heads.count() == sum(r.record_type == "response" for r in rows)
    warc.write_warc(warc.page_records(pages, least=10**6), f"{tmp_path}/b")
    assert warc.read_warc(spark, f"{tmp_path}/b").where("record_type = 'revisit'").count() == 0
    warc.write_warc(warc.page_records(pages.where("false")), f"{tmp_path}/c")
    assert warc.read_warc(spark, f"{tmp_path}/c").count() == 0


def test_warc_predicates_and_foreign_files(spark, sf, tmp_path):
    block = b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:x:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    data = b"".join(block % (t, i, len(p), p) for i, (t, p) in enumerate([(b"warcinfo", b"a: b"), (b"resource", b"xyz")]))
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "one.warc").write_bytes(data)
    (tmp_path / "f" / "two.warc.gz").write_bytes(gzip.compress(data))
    df = warc.read_warc(spark, str(tmp_path / "f")).where("record_type = 'resource'")
    assert "Filter (" not in df._jdf.queryExecution().executedPlan().toString()  # the source has taken it over
    assert [bytes(r.payload) for r in df.collect()] == [b"xyz", b"xyz"]
    light = warc.read_warc(spark, str(tmp_path / "f"), payload=False).where("record_id LIKE 'urn:x:1%'")
    assert [(r.payload, r.payload_bytes) for r in light.collect()] == [(None, 3)] * 2


def test_warc_tests_skip_payloads():
    """A record that fails on its headers is never read."""
    from pyspark.sql.datasource import EqualTo, In, Not

    row = {"record_type": "response", "target_uri": None}
    assert warc._header_test(EqualTo(("record_type",), "response"))(row)
    assert not warc._header_test(Not(EqualTo(("record_type",), "response")))(row)
    assert not warc._header_test(Not(In(("target_uri",), ("x",))))(row)
    assert warc._header_test(EqualTo(("payload_bytes",), 3)) is None


# -- language


def test_language_odd(odd, none):
    profiles = langid.fit(odd)
    assert set(profiles) <= {"en", "de", "la", "ja"}
    rows = langid.identify(odd, profiles).collect()
    assert len(rows) == odd.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert langid.fit(none) == {}
    assert {r.lang_pred for r in langid.identify(odd, {}).collect()} == {"und"}
    assert langid.identify(none, profiles).count() == 0


def test_many_grams_do_not_change_a_vector(monkeypatch):
    text = "".join(chr(97 + i % 26) + chr(97 + i * 7 % 26) for i in range(3_000))
    want = langid.vector(text)
    monkeypatch.setattr(langid, "_GRAMS", 3)
    langid._grams.clear()
    assert np.allclose(langid.vector(text), want)


# -- tokens


def test_tokens_odd(spark, odd, none):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    more = ["\n", " \n x", "a\n\nb", "▁▁x y", "<s> </s>", "  lead", "trail  ", "\x00\x01", "é🙂日本", "\t\r\n"]
    df = odd.select("doc_id", "text", "ids").unionByName(
        spark.createDataFrame([(100 + i, t, "e") for i, t in enumerate(more)], "doc_id long, text string, ids string")
    )
    rows = tokens.count_tokens(df, MODEL).collect()
    assert all(r.n_tokens == len(sp.encode(r.text or "")) for r in rows) and len(rows) == df.count()
    assert tokens.count_tokens(none, MODEL).count() == 0


# -- shards


def test_shards_odd(odd, none):
    df = odd.withColumn("size", F.octet_length("text").cast("long"))
    rows = shards.assign(df, ["doc_id", "text"], "size", 3).collect()
    assert len(rows) == odd.count()
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert shards.assign(none.withColumn("size", F.lit(1)), ["doc_id"], "size", 3).count() == 0


def test_one_key_for_a_third_of_the_rows(spark, sf):
    df = spark.range(3_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "1L AS size")
    counts = [r["count"] for r in shards.assign(df, ["k"], "size", 8).groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) <= 1.01 * 375 + 2 and min(counts) >= 360


def test_a_new_shard_moves_few():
    rng = random.Random(1)
    cells = [(10, c, rng.randint(900, 1100)) for c in range(shards.CELLS)]
    size = {(k, c): s for k, c, s in cells}
    owner = lambda n: {k: p[0][1] for k, p in shards.walk(cells, n, 0.05).items()}
    a, b = owner(8), owner(9)
    moved = sum(size[k] for k in a if a[k] != b[k]) / sum(size.values())
    assert moved < 0.35


# -- mixing


def test_targets_share_and_stop():
    goal = mixing.targets({"b": 100, "a": 1000, None: 10, "c": 0})
    assert list(goal.values()) and sum(goal.values()) == pytest.approx(1665)
    assert goal["b"] <= 200 and goal["a"] <= 2000 and goal[None] <= 20 and goal["c"] == 0


def test_mix_odd(odd, none):
    taken = mixing.taken_words(mixing.mix(odd, block=4)).collect()
    assert len(taken) == odd.count()
    rows = [(r.doc_id, r.source, r.text) for r in odd.collect()]
    want = Counter()
    for doc, text, low, high in brute.mixed(rows):
        want[doc] += high - low
    got = Counter()
    for r in taken:
        got[r.doc_id] += r.taken
        assert 0 <= r.taken <= 2 * r["size"]
    assert +got == +want
    assert mixing.taken_words(mixing.mix(none)).count() == 0
    out = mixing.mixed_texts(odd)
    assert out.columns == odd.columns and mixing.mixed_texts(none).count() == 0
    assert sum(len(brute.WORD.findall(r.text)) for r in out.collect()) == sum(want.values())


def test_schedule_is_even(spark, sf):
    sources = spark.createDataFrame([(0, 60_000), (1, 30_000), (2, 10_000)], "src int, words long")
    slots = sorted((r.slot, r.src, r.rank) for r in mixing.schedule(sources, block=10).collect())
    assert Counter(s for _, s, _ in slots) == {0: 6_000, 1: 3_000, 2: 1_000}
    for src in range(3):
        assert [r for _, s, r in slots if s == src] == list(range(sum(s == src for _, s, _ in slots)))
    share = Counter(s for _, s, _ in slots[:1_000])
    assert abs(share[0] - 600) < 10 and abs(share[2] - 100) < 10


# -- BPE


def test_bpe_odd(odd, none):
    import tiktoken

    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(RANKS), special_tokens={}
    )
    both = bpe.decoded(bpe.encoded(odd, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    rows = both.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert list(r.ids) == own.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encoded(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_words():
    import tiktoken

    coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(6)
    words = ["a" * 3_000, "ab" * 900, "日本" * 300, " " * 500, "<|endoftext|>", "x\x00"]
    words += ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 400))) for _ in range(200)]
    for text, ids in zip(words, coder.encode(words), strict=True):
        assert ids.tolist() == own.encode_ordinary(text)


# -- pipeline


def test_pipeline_odd(spark, odd, none, sf):
    for docs in (odd, none):
        docs = docs.select(*corpus_pipeline.COLUMNS)
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, sf), name)
            if name != "tokenized":
                assert docs.columns == corpus_pipeline.COLUMNS
        docs.collect()
