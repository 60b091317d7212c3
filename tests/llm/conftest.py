


import pytest

from partledger.llm.common import prepare

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def corpus(spark):
    """The smallest documents table."""
    return prepare(spark).read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty and blank texts, repeated rows, one id with two texts, and a long text."""
    prepare(spark)
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(1, "one two three four five six seven", "en", "a"), (1, "one two three four five six seven", "en", "a"),
            (1, "another text of this id", "en", "a"), (2, None, None, None), (3, "", "en", "b"), (4, " \n\t ", None, "b"),
            (None, "no id here but words", "en", None), (None, None, None, None), (5, long, "en", "c"),
            (6, "zwölf Boxkämpfer <|endoftext|> 中文 ñ́ \x1c  x", "de", "c"), (7, "x" * 5000, "xx", "c")]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCS)


@pytest.fixture
def clashing(odd):
    """The same rows with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ["ids", "size", "key", "score", "lang_pred", "kept", "kept_text", "dropped", "n_words", "place", "slot", "block"]
    return odd.withColumns({n: F.lit("mine") for n in names})


@pytest.fixture
def none(spark):
    return prepare(spark).createDataFrame([], DOCS)


