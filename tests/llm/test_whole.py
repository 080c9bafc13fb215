"""Nothing is cut: letters, languages, splitters, frequent pre-tokens."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from brisa.llm import langid, mixing, simhash, suffixes, tokens


def test_every_letter_has_a_vector(monkeypatch):
    han = [chr(0x4E00 + i) for i in range(2_000)]
    assert len({langid.vector(c * 3).tobytes() for c in han}) == len(han)
    assert np.array_equal(langid.vector("ÄBC"), langid.vector("äbc"))
    want = langid.vector("".join(han))
    for most in (1_000, 3_000):  # the store of letters overflows: in one text, then between texts
        monkeypatch.setattr(langid, "_LETTERS", most)
        monkeypatch.setattr(langid, "_known", None)
        langid._letters.clear()
        langid._grams.clear()
        langid.vector("".join(chr(0xAC00 + i) for i in range(2_000)))
        assert np.allclose(langid.vector("".join(han)), want)
    langid._letters.clear()
    langid._grams.clear()


def test_prediction_corrects_a_given_language(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wrong = F.when(F.col("doc_id") % 20 == 0, F.when(F.col("lang") == "en", "de").otherwise("en")).otherwise(F.col("lang"))
    given = {r.doc_id: (r.lang, r.wrong) for r in docs.select("doc_id", "lang", wrong.alias("wrong")).collect()}
    got = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, docs.withColumn("lang", wrong), sf).collect()}
    changed = [d for d in got if given[d][0] != given[d][1]]
    assert len(changed) > 5
    assert np.mean([got[d] == given[d][0] for d in changed]) > 0.9


def test_few_long_documents_have_splitters(spark, sf):
    rng = np.random.default_rng(4)
    rows = [(i, "".join(map(chr, rng.integers(97, 123, 400_000)))) for i in range(20)]
    base = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    base = suffixes._keys(base, "doc_id", "text").withColumn("__t", F.col("text").cast("binary"))
    found = suffixes.repeated_suffixes(base, bucket=20_000)
    sizes = [r.bucket for r in found.select("bucket").distinct().collect()]
    assert len(sizes) > 3


def test_frequent_pretokens_of_all_texts(spark, sf, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(tokens, "FREQUENT", 50)
    monkeypatch.setattr(tokens, "COUNTED", 4_000)
    texts = [" ".join(f"x{rng.randrange(10**6)}" for _ in range(20)) for _ in range(6_000)]
    texts[4_000] = "seldom " * 3_000  # frequent, and all in one text of many
    texts = [t + " often" for t in texts] + [None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    found = tokens.frequent_pretokens(df, "text")
    assert {"▁seldom", "▁often"} <= set(found) and len(found) <= 50
    assert tokens.frequent_pretokens(df.where("false"), "text") == []


def test_rows_that_differ_in_one_column_are_mixed_each(spark, sf):
    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "de", "s", 5), (1, "a b c", None, "s", 5), (2, "d e f", "en", "s", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = mixing.mixed_texts(df, share=1.0).collect()
    assert sorted((r.doc_id, str(r.lang)) for r in found) == [(1, "None"), (1, "de"), (1, "en"), (2, "en")]


def test_one_of_equal_texts_stays_whatever_the_order_of_reading(spark, sf):
    rows = [(1, "same words", lang, "s", n) for lang in ("en", "de", None) for n in (1, 2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {tuple(simhash.leaders(df.repartition(n).orderBy(F.rand(n))).collect()) for n in (1, 2, 3)}
    assert len(kept) == 1 and len(kept.pop()) == 1


def test_a_huge_pretoken_stays_out_of_the_table(spark, sf):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["x" * 300_000, "often " * 50 + "y" * 2_000, "y" * 2_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert max(map(len, tokens.frequent_pretokens(df, "text"))) <= tokens.LONGEST
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(df, path).collect()}
    assert got == {i: len(sp.encode(t)) for i, t in enumerate(texts)}
