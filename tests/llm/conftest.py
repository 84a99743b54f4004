import random

import pytest

#: Names that the operators use inside.
CLASHES = ("__id", "__tag", "__top", "__text", "__row", "__host", "__lines", "__spans", "__parts", "key", "a.b")


@pytest.fixture(scope="session")
def odd_rows():
    """Rows that every text operator must take: nulls, empties, long texts, ties, repeats."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    long = " ".join(rng.choice(words) for _ in range(6000))
    shared = " ".join(f"s{i}" for i in range(70))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long), (6, long), (7, shared), (8, "lead " + shared + " tail"), (8, "lead " + shared + " tail"), (None, shared), (None, None), (9, "long " * 250_000 + "end of it")]
    rows += [(20 + i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 150)))) for i in range(25)]
    rows += [(60 + i, "x" * rng.randrange(0, 700) + "é漢🙂") for i in range(6)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The same as a table with extra columns whose names clash with the operators' own, inner ones too."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(odd_rows, "doc_id long, text string").repartition(5)
    return docs.withColumns({"source": F.lit("src"), "n_words": F.lit(1), "score": F.lit(0.5), "bucket": F.lit("b"), "doc": F.lit("d"), "n": F.lit(2), "id": F.lit(3), "node": F.lit(4), "blob": F.lit(None).cast("binary")}).withColumns({c: F.lit("mine") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
