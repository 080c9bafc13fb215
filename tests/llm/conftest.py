import pytest

from brisa.llm.text import settled

LONG = "lorem ipsum " * 4_000
TEXT = "The quick brown fox jumps over the lazy dog, and nobody minds it at all. "


@pytest.fixture(scope="session")
def sf(spark):
    settled(spark)
    return "/root/testdata/sf0.001"


@pytest.fixture
def odd(spark, sf):
    """Nulls in any column, empty and long texts, repeated rows and ids, odd characters,
    and columns whose names the operators use themselves."""
    rows = [
        (1, TEXT * 6, "en", "a", 1),
        (2, None, "en", "a", None),
        (3, "", None, "b", 3),
        (3, TEXT * 7 + "end", "en", None, 3),
        (None, "no id here but words enough", "de", "b", 4),
        (None, None, None, None, None),
        (5, TEXT * 6, "en", "a", 5),
        (6, "twice the same row", "en", "c", 6),
        (6, "twice the same row", "en", "c", 6),
        (7, LONG, "la", "c", 7),
        (8, " \t\n\x0b ", "en", "c", 8),
        (9, "日本語 🙂 naïve café x", "ja", "d", 9),
        (10, "12 34 !!! ...", None, "d", 10),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ("fp", "component", "mark", "size", "slot", "shard", "ids", "kept", "score", "n_words", "part", "key", "load")
    return df.selectExpr("*", *[f"'extra' AS {c}" for c in clash])


@pytest.fixture
def none(odd):
    return odd.where("false")
