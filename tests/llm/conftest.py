import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text[, lang[, source]]) rows, with columns of clashing names beside."""

    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        for name in ("id", "ids", "set", "place", "task", "row", "score", "n_lines", "words", "rank", "key"):
            df = df.withColumn(name, F.lit(name))
        return df

    return make


@pytest.fixture
def awkward():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", None), (None, "some text without an id", None, "b"),
        (None, None, None, None), (5, long, "en", "a"), (6, long, "en", "b"), (7, "x" * 20_000, "de", "a"),
        (8, "same row", "en", "a"), (8, "same row", "en", "a"), (9, "one", "de", "b"), (10, "é漢😀 \x00 end", "fr", "c"),
    ]
