"""Small tables: awkward rows that every operator must take, and plain word lists to build texts from."""

from __future__ import annotations

import random

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

#: Columns that operators also use for their own results or inside.
CLASHES = ("doc", "word", "words", "score", "fp", "size", "target", "taken", "block", "key", "row", "value", "label", "q", "h", "shard")

ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def vocabulary(n: int, seed: int = 7) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(2, 8))) for _ in range(n)]


def texts(n: int, words: int, vocab: list[str], seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    return [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, words))) for _ in range(n)]


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, a very long text, ties, repeated rows."""
    vocab = vocabulary(300)
    long = " ".join(random.Random(5).choices(vocab, k=40_000) + ["again"] * 20_000)
    plain = " ".join(random.Random(6).choices(vocab, k=80)) + "."
    return [
        (1, plain, "en", "a", len(plain)),
        (2, plain, "en", "a", len(plain)),  # a copy
        (3, None, "en", "a", None),
        (4, "", "en", None, 0),
        (5, " \t\n\x0b\x0c\r ", None, "b", 6),
        (6, long, "en", "b", len(long)),
        (7, "é" * 5000, "fr", "b", 5000),
        (8, "one", None, None, None),
        (9, "12345 67890 !!! ???", "en", "c", 19),
        (9, "12345 67890 !!! ???", "en", "c", 19),  # a repeated row
        (None, plain, "en", "a", len(plain)),
        (None, None, None, None, None),
    ]


def documents(spark, rows, clashes: bool = False):
    df = spark.createDataFrame(rows, DOCUMENTS)
    if clashes:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("clash").alias(c) for c in CLASHES])
    return df
