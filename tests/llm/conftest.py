import random

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

# Columns whose names the operators use inside.
CLASHING = ("size", "kept", "k", "place", "bucket", "target", "n", "uid", "fp", "row", "before", "n_words")

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
    + [T.StructField(c, T.StringType()) for c in CLASHING]
)


def words(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice("ab ba cd dc ef fe gh hg ij ji kl lk mn nm".split()) + str(pick.randrange(40)) for _ in range(n))


def odd_rows():
    """Null and empty texts, null keys, ties, repeated rows and one very long text."""
    texts = [
        (1, words(1, 120), "en", "a"),
        (2, words(2, 90), "en", "a"),
        (3, words(3, 200), "de", "b"),
        (4, None, "en", "a"),
        (5, "", "en", None),
        (6, " \t\n ", None, "b"),
        (7, words(1, 120), "en", "b"),
        (8, words(4, 60_000), "en", "a"),
        (9, "one two", "de", "b"),
        (9, "one two", "de", "b"),
        (10, words(5, 80) + " # * |\nline x\nline x\n", None, None),
        (None, words(6, 70), "en", "a"),
        (11, "zwölf Ärzte, ½ ² Σας x \U0001f600 ﬁ", "de", ""),
    ]
    return [
        (i, t, lang, source, None if t is None else len(t), *["x"] * len(CLASHING))
        for i, t, lang, source in texts
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows as a table."""
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    """An empty table."""
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def queries():
    import __spark_entry__

    return __spark_entry__.queries()
