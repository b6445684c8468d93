from __future__ import annotations

import random

import pytest

PIECES = [
    "the", "of", "Straße", "naïve", "日本", "🎉", "é", "́", "\t", "\n", "  ", " ", "x1", "3.14", "don't", "▁", "\x85", "A" * 70,
    "<|endoftext|>", "mail@a.example.com", "10.0.0.1", "+1 (555) 123-4567", "4111 1111 1111 1111", "###", "ſİ",
]


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, very long and mixed texts; equal rows."""
    rng = random.Random(11)
    texts = [None, "", " ", "\n\n", "one", " " * 5000 + "end", "ab" * 20_000, "the of " * 3000]
    texts += ["".join(rng.choice(PIECES) + rng.choice(["", " "]) for _ in range(rng.randint(1, 60))) for _ in range(250)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(5, texts[5]), (None, "no id here")]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(odd_texts, "doc_id long, text string").repartition(3)
    return docs.withColumn("kept", F.lit("own")).withColumn("n_words", F.lit(-1)).withColumn("length", F.lit(None).cast("string"))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
