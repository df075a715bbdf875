import random

import pytest
from pyspark.sql import types as T

from loanlens.llm.storage import ship_package

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    T.StructField("uid", T.StringType()), T.StructField("row", T.IntegerType()), T.StructField("n", T.StringType()),
    T.StructField("size", T.StringType()), T.StructField("score", T.StringType()), T.StructField("node", T.StringType())])


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" + "aeiou"[rng.randrange(5)] * rng.randrange(1, 3) for _ in range(n)]


def make_documents(spark, texts, ids=None):
    """A documents frame with awkward extra columns."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, ["en", "de", None][k % 3], ["a", "b", None, "ß", "Z"][k % 5], len(t or ""), "u", 1, "n", "s", "x", "y")
            for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empties, white space, ties, repeats, odd characters and one long text."""
    rng = random.Random(7)
    base = " ".join(words(rng, 60))
    near = base.split()
    near[30] = "changed"
    return [None, "", " ", "\n\n", "one", "two words", "a b c d", base, base, base.upper(), " ".join(near),
            "  lead and trail  ", "tab\tand\x0bvertical", "don't we'll 12,5 é ñ 你好  x​", "<|endoftext|> x",
            "a\n\nb", "x \ny", "\x01\x02 odd", " ".join(words(rng, 30000)), "..., !!! ???", "Ends with stop.\nNext, line.",
            "z" * 5000]


@pytest.fixture
def odd_documents(spark, odd_texts):
    ids = list(range(len(odd_texts)))
    ids[3], ids[8] = None, ids[7]  # a null id, and one row twice
    return make_documents(spark, odd_texts, ids)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
