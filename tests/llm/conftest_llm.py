import random

import pytest

LONG = " ".join(random.Random(5).choices(["alpha", "beta", "gamma", "delta", "épsilon", "zeta,", "eta."], k=4000))
SCHEMA = "doc_id long, text string, key string, name string, n int, id long, shard int, spans string"


def near(text: str) -> str:
    words = text.split()
    words[7] = "changed"
    return " ".join(words)


BASE = " ".join(random.Random(6).choices([f"w{k}" for k in range(400)], k=120))
EDGES = [
    (0, None), (1, ""), (2, "a"), (3, LONG), (3, "other text with the same id"), (4, BASE), (5, BASE), (6, near(BASE)), (7, BASE), (7, BASE), (None, "no id at all"), (8, "a"),
    (9, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" mail me@x1.example.com or (499) 555-6503, 152.143.123.131'), (10, "Mr Paul Smith met Mrs Anna Smith. Mr Paul Smith left."), (11, "   \n "), (12, "x\x1cy <|endoftext|> İstanbul ǅ 漢字 ́z"),
]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame([(i, t, "k", "n", 1, 2, 3, "s") for i, t in EDGES], SCHEMA).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
