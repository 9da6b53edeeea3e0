"""Rows with every odd case, as fixtures that the test modules import."""

import random

import pytest
from pyspark.sql import functions as F


def prose(n, seed, size=400):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(size)]
    return " ".join(rng.choice(vocab) for _ in range(n))


LONG = prose(220, 1)
#: Nulls in id and text, empty and blank texts, copies, a repeated row, near copies, letters beyond ASCII, long texts, a huge word.
EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, LONG), (6, LONG.upper().replace(" ", "\n")), (7, LONG), (7, LONG),
    (8, LONG.replace(LONG.split()[100], "changed", 1)), (9, prose(80, 2) + " " + " ".join(LONG.split()[40:120]) + " end"),
    (10, "Éa ñb 漢字 ß " * 30), (11, prose(30000, 3, 3000)), (12, "x" * 1_200_000 + " tail words here now then"),
    (13, " ".join(["same"] * 300)), (14, " ".join(["same"] * 120)), (15, "123 456 !!"), (None, LONG), (None, None),
]


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows in three partitions, with columns whose names clash with the operators' own."""
    df = spark.createDataFrame(EDGE, "doc_id long, text string").repartition(3)
    for name in ("h", "key", "at", "bucket", "cls", "place", "a.b", "__key", "n"):
        df = df.withColumn(name, F.lit(name))
    return df.withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="session")
def none(edge):
    return edge.limit(0)
