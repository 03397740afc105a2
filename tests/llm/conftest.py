import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs_of(spark):
    """Documents from (id, text) pairs, with columns that clash with names the
    operators use inside."""
    def make(rows, clash=False):
        df = spark.createDataFrame([(i, t, "en", "a", None if t is None else len(t)) for i, t in rows], DOCS)
        if clash:
            from pyspark.sql import functions as F
            for c in ("cid", "n", "token", "words", "copy", "rate", "ids", "spans", "kept", "shuffle_key", "no"):
                df = df.withColumn(c, F.lit(c))
        return df
    return make


#: Null and empty texts, a null id, repeated rows, white space, a long text.
EDGES = [(1, None), (2, ""), (None, "some words here"), (3, "same text twice " * 20), (3, "same text twice " * 20),
         (4, " \t\n\x0b\x0c\r "), (5, "word " * 30_000), (6, "x" * 50_000), (7, "Zoë ▁ 日本語 🙂 \x00 tail\n")]


@pytest.fixture
def edges():
    return list(EDGES)
