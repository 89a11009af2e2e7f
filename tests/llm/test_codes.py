"""Codes against Lloyd rounds that recount everything, in Python integers."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from compare import compare
from concilia.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, v int, code string, old string"


def brute(rows, rounds=4):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max((len(r[1]) for r in kept), default=0)
    width += -width % 4
    x = [[max(-(2**62), min(2**62, math.floor(Fraction(c) * 1024))) for c in r[1]] + [0] * (width - len(r[1])) for r in kept]
    d = width // 4
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, [*kept[k][1], *[0.0] * (width - len(kept[k][1]))]))[:256]
    parts = [[v[p * d : p * d + d] for v in x] for p in range(4)]
    books = [[part[k] for k in first] for part in parts]
    far = lambda a, b: sum((i - j) ** 2 for i, j in zip(a, b))

    def assign():
        return [[min((far(v, e), k) for k, e in enumerate(book)) for v in part] for part, book in zip(parts, books)]

    for _ in range(rounds):
        for part, book, got in zip(parts, books, assign()):
            mine = defaultdict(list)
            for v, (_, k) in zip(part, got):
                mine[k].append(v)
            for k, vs in mine.items():
                book[k] = [sum(c) // len(vs) for c in zip(*vs)]
    got = assign()
    error = [sum(g[k][0] for g in got) for k in range(len(kept))]
    by = defaultdict(int)
    for r, e in zip(kept, error):
        by[r[2]] += e
    fits = lambda n: n if n < 2**63 else None
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return [(r[0], "".join(f"{g[k][1]:02x}" for g in got), fits(error[k]), fits(by[r[2]]), digest) for k, r in enumerate(kept)]


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "c", "o") for r in rows], SCHEMA).repartition(3)
    found, books = codes.coded(df)
    digest = codes.digest_of(books)
    return Counter((r.vec_id, r.code, r.error, r.label_error, digest) for r in codes.by_label(found).collect())


def test_equals_full_recount(spark):
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(8)], 7 if k % 3 == 0 else rng.choice([1, None, 40 + k])) for k in range(900)]
    rows += [(5000 + k, rows[k % 5][1], 7) for k in range(300)]
    assert run(spark, rows) == Counter(brute(rows))


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e12, 1e200])
def test_odd_rows(spark, scale):
    rng = random.Random(4)
    made = lambda n: [rng.choice([-1, 1, 0.25]) * rng.random() * scale for _ in range(n)]
    rows = [(k % 40, made(5), None) for k in range(330)] + [(None, made(6), 1), (None, made(6), 1), (2**62, made(3), 2), (9, [], 3), (8, None, 3), (7, [1.0, None], 3), (6, [float("nan")], 3), (5, [float("-inf"), 1.0], 3)]
    rows += [(100, [0.0] * 6, 5), (101, [-0.00001] * 6, 5)] * 2
    assert run(spark, rows) == Counter(brute(rows))


def test_nothing(spark):
    assert run(spark, []) == Counter()
    assert run(spark, [(1, [], 1), (2, [], None)]) == Counter(brute([(1, [], 1), (2, [], None)]))


def test_only_changes_are_shuffled(spark):
    rng = random.Random(5)
    rows = [(k, [rng.random() for _ in range(4)], 1) for k in range(400)]
    df = spark.createDataFrame([(*r, 1, "c", "o") for r in rows], SCHEMA)
    state, books = codes.trained(*seeded(df), 4, rounds=3)
    again = codes.assigned(state, books, 4)
    assert again.where("old != new").count() == 0 and codes.deltas(again, 4).count() == 0


def seeded(df):
    from pyspark.sql import functions as F

    rows = [r.embedding for r in df.orderBy("vec_id").collect()]
    x = codes.whole(rows, 4)
    state = df.sparkSession.createDataFrame([(str(k), "1", bytes(codes.packed(x[k : k + 1])[0]), None, None, None) for k in range(len(rows))], codes.STATE)
    return state.select(*[F.col(c) for c in state.columns]), np.split(x[:256], 4, axis=1)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in codes.op13_codes_delta_lloyd(spark, sf).collect())
    assert got == Counter(brute(rows))


def test_equals_sql(spark):
    compare(spark, codes.op13_codes_delta_lloyd, codes.SQL["op13_codes_delta_lloyd"], "/root/testdata/sf0.01")
