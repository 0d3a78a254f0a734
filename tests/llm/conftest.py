import pytest
from pyspark.sql import types as T

from postloom.llm.common import ship_code

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators use inside, or return; inputs may bring them along.
EXTRA = ("size", "copies", "row", "node", "key", "id", "unit", "removed", "found", "lang_pred", "score", "rank", "rate", "source_size")


@pytest.fixture(scope="session")
def shipped(spark):
    ship_code(spark)
    return spark


@pytest.fixture(scope="session")
def documents(shipped):
    """A function from rows (doc_id, text, lang, source) to a documents table with clashing extra columns."""

    def make(rows):
        rows = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]
        frame = shipped.createDataFrame(rows, DOCUMENTS)
        for name in EXTRA:
            frame = frame.withColumn(name, frame["source"])
        return frame

    return make


@pytest.fixture(scope="session")
def odd_documents(documents):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    long = " ".join(f"{words[i % 10]}{i % 977}" for i in range(60_000))
    rows = [
        (1, "The same short text. And one more sentence of it here.", "en", "a"),
        (1, "The same short text. And one more sentence of it here.", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, "b"),
        (None, "no id but a text that is like no other in this table", "de", None),
        (None, None, None, None),
        (4, " \t\n ", "en", "b"),
        (5, "12345 !!! 678", "de", "c"),
        (6, long, "en", "a"),
        (7, "word", "de", None),
        (8, "the same  SHORT text.\tAnd one more sentence of it here.", "en", "c"),
        (9, "x" * 5_000, "fr", "c"),
    ]
    return documents(rows)


@pytest.fixture(scope="session")
def empty_documents(documents, shipped):
    return documents([(0, "x", "x", "x")]).where("false")


@pytest.fixture(scope="session")
def embeddings(shipped):
    schema = T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
        T.StructField("key", T.StringType()), T.StructField("cls", T.StringType()), T.StructField("vector", T.StringType()),
    ])
    return lambda rows: shipped.createDataFrame([(*r, "k", "c", "v") for r in rows], schema)
