import os
import pathlib
import random

import pytest

ROOT = str(pathlib.Path(__file__).resolve().parents[2])


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_library(spark):
    environment = spark.sparkContext.environment
    environment["PYTHONPATH"] = os.pathsep.join([ROOT, environment.get("PYTHONPATH", "")])


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `drop` string, shard string, tokens string, part int, size int"


def rows_of(texts, source=lambda i: f"s{i % 3}"):
    """Rows of documents with extra columns whose names the operators use themselves."""
    return [(i, t, "en", source(i), None if t is None else len(t), "x", "y", "z", 7, 3) for i, t in texts]


def awkward():
    """Null, empty, blank and very long texts, ties, repeated rows, null ids and sources."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(400)}" for _ in range(4000)]
    text = " ".join(words[:60])
    texts = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one two"), (5, "one two"), (6, text), (7, text), (7, text),
        (8, text.upper()), (9, " ".join(words * 20)), (10, " ".join([*words[:58], "new", "end"])), (None, text),
        (None, None), (11, "x" * 30_000), (12, "é▁\x00 \U0001f600 \r\n" * 5), (13, "same line in many documents\nb"),
        (14, " Same line IN many documents \nc"), (15, "a\nsame line in many documents"), (16, "\n\n\n"),
        (17, "a@b.co 1.2.3.4 or +1 (308) 555-0351 or 4012888888881881 and 555-0351"),
    ]
    return rows_of(texts, lambda i: None if i == 4 else f"s{(i or 0) % 3}")


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
