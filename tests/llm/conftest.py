import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

WORDS = "the of and river stone cloud walks under bright window seven letters green harbour quiet morning paper engine north field".split()


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def awkward(documents):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows and other scripts."""
    long = " ".join(WORDS[i * i % len(WORDS)] + str(i % 97) for i in range(60_000))
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (5, "two words"),
        (6, "the quiet river\nwalks under the stone"),
        (6, "the quiet river\nwalks under the stone"),
        (7, "the quiet river\nwalks under the stone"),
        (8, long),
        (9, "déjà vu à la mañana, grün und weiß"),
        (10, "日本語 текст 🙂 emoji"),
        (None, "no id here"),
        (None, None),
        (-5, "a negative id", None),
        (2**62, "a large id", None),
        (11, "x" * 50_000),
    ]
    return documents(rows)
