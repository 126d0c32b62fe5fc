import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        # names that the operators use inside
        T.StructField("row", T.StringType()), T.StructField("key", T.IntegerType()), T.StructField("hash", T.LongType()), T.StructField("mark", T.StringType()), T.StructField("id", T.StringType()),
    ]
)


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "Ändern", "été", "über", "and", "x1", "Zeit", "niño", "day"]) + rng.choice(["", "", ".", "\n", "  "]) for _ in range(n))


def document(i, text, source="s"):
    return (i, text, "en", source, None if text is None else len(text), "r", 1, 7, "m", "i")


@pytest.fixture(scope="session")
def nasty(spark):
    """Null ids and texts, empty and very long texts, copies, ties, repeated rows and clashing names."""
    rng = random.Random(5)
    base = [words(rng, rng.randint(1, 120)) for _ in range(40)]
    rows = [document(i, t, rng.choice(["a", "b", "é", None])) for i, t in enumerate(base)]
    rows += [document(100 + i, base[i % 5].replace(" ", "  "), "a") for i in range(12)]  # copies with other white space
    rows += [document(200 + i, base[7], "hot") for i in range(60)]  # a large group
    rows += [document(300, words(rng, 40_000), "long"), document(301, "", "a"), document(302, " \t\n", "a"), document(303, None, None), document(None, base[3], "a"), document(None, None, "b")]
    rows += [document(5, base[5], "a"), document(5, base[5], "a"), document(6, "another text under a known id", "b")]  # repeated ids
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
