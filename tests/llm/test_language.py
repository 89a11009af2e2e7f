"""Elias-Fano levels against lists, and scores against a model in a dictionary."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from concilia.llm import language
from concilia.llm.elias_fano import Sequence, Trie, mapped

SCHEMA = "doc_id long, text string, held boolean, batch long, words string, kind int"


@pytest.mark.parametrize("n, top", [(0, 1), (1, 0), (1, 2**40), (5, 3), (700, 900), (3000, 2**45), (5000, 40)])
def test_sequence(n, top):
    rng = np.random.default_rng(n)
    x = np.sort(rng.integers(0, top + 1, n))
    s = Sequence(Sequence.encoded(x))
    assert s.values(np.arange(n)).tolist() == x.tolist()
    ask = np.concatenate([x, x + 1, np.maximum(x - 1, 0), rng.integers(0, 2 * top + 9, 200), [0, 2**50]])
    start = rng.integers(0, n + 1, len(ask))
    want = np.maximum(np.searchsorted(x, ask), start)
    assert s.successor(ask, start).tolist() == want.tolist()


def test_trie():
    rng = random.Random(2)
    words = sorted(rng.sample(range(10**9), 300))
    contexts = sorted(rng.sample(range(300), 120))
    of = {v: sorted(rng.sample(range(300), rng.choice([0, 1, 3, 90]))) for v in contexts}
    pairs = [(v, w) for v in contexts for w in of[v]]
    cost = [rng.randrange(65536) for _ in pairs]
    backoff = [rng.randrange(65536) for _ in contexts]
    image = Trie.built(np.array(words), np.array(contexts), np.array(backoff), np.array([len(of[v]) for v in contexts]), np.array([w for _, w in pairs]), np.array(cost))
    trie = Trie(mapped(image))
    ask = [(a, b) for a in [*words, 7, 10**10] for b in rng.sample([*words, 8, 10**11], 40)] + [(words[v], words[w]) for v, w in pairs]
    got = trie.looked_up(*map(np.array, zip(*ask)))
    known, weights = dict(zip([(words[v], words[w]) for v, w in pairs], cost)), dict(zip([words[v] for v in contexts], backoff))
    assert [(c, bool(s), b) for c, s, b in zip(*got)] == [(known.get(x, 0), x in known, weights.get(x[0], 0)) for x in ask]


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def brute(rows):
    """The model of the docstring, with exact probabilities."""
    c, pairs = Counter(), Counter()
    for _, text, held in rows:
        if not held:
            ws = tokens(text)
            c.update(ws)
            pairs.update(zip([None, *ws[:-1]], ws))
    n = sum(c.values())
    z = n + len(c) + 1
    for i, text, held in rows:
        ws, base, score = tokens(text), 0.0, 0.0
        for v, w in zip([None, *ws[:-1]], ws):
            p, m = (c[w] + 1) / z, language.MASS * c[v] ** language.GROWTH
            base += math.log10(p)
            score += math.log10((pairs[v, w] + m * p) / (c[v] + m)) if c[v] else math.log10(p)
        yield i, bool(held), len(ws), sum(c[w] > 0 for w in ws), n, base, score


def check(got, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    want = sorted(brute(rows), key=key)
    got = sorted(map(tuple, got), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert w[6] - 2.01 * w[2] / language.UNIT <= g[6] <= w[6] + 1e-9  # costs are rounded up


def made(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    return [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(60))), k % 7 == 2) for k in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_dictionary(spark, monkeypatch, small):
    if small:  # many batches and shards, and contexts dealt to several of these
        monkeypatch.setattr(language, "BATCH", 3000)
        monkeypatch.setattr(language, "SHARD", 150)
        monkeypatch.setattr(language, "PIECE", 40)
        monkeypatch.setattr(language, "BUCKET", 30)
    rows = made(300, 1) + [(400, None, False), (401, "", True), (402, "a  B c\x0bA É\t\n", False), (403, "ÀA àa É é İ", True), (404, "x" * 5000, False), (404, "one " * 700, True), (None, "w1 w2", None), (None, "w1 w2", None), (2**62 + 1, "w1\x1cw2 w3", False)]
    df = spark.createDataFrame([(*r, 1, "w", 2) for r in rows], SCHEMA).repartition(3)
    check(language.scored(df).collect(), rows)


def test_no_training_rows_and_nothing(spark):
    rows = [(k, "a b", True) for k in range(3)]
    check(language.scored(spark.createDataFrame([(*r, 1, "w", 2) for r in rows], SCHEMA)).collect(), rows)
    assert language.scored(spark.createDataFrame([], SCHEMA)).count() == 0


def test_probabilities_add_to_one_at_most(spark):
    rows = made(200, 3)
    words = sorted({w for _, t, h in rows if not h for w in tokens(t) if w})
    asked = [(1000, " ".join(f"w3 {w}" for w in [*words, "unknown"]) + " w3", True)]  # every word after w3, an unknown one, the end
    df = spark.createDataFrame([(str(i), t.encode(), h) for i, t, h in rows + asked], "doc_id string, text binary, held boolean")
    pairs, total, types = language.pairs_of(df)
    shard = language.Pairs([r.body for r in pairs.where("kind = 1").collect()], total, types)
    after = np.bincount(shard.v, minlength=len(shard.words)).argmax()  # w3 has every word after it
    mine = shard.v == after
    assert mine.sum() == types + 1
    assert 0.99 < (10.0 ** (-shard.cost()[mine] / language.UNIT)).sum() <= 1


def test_beats_the_base_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = language.op12_lm_trie(spark, sf).collect()
    docs = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(got, docs)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > 0.9 * sum(r.base_score for r in out)


def test_models_are_written_by_shard(spark, monkeypatch):
    monkeypatch.setattr(language, "SHARD", 800)
    rows = spark.createDataFrame([(str(k), t.encode(), h) for k, t, h in made(120, 5)], "doc_id string, text binary, held boolean")
    pairs, total, types = language.pairs_of(rows)
    images = language.models(pairs, total, types).collect()
    want = Counter((v, w) for _, t, h in made(120, 5) if not h for v, w in zip([None, *tokens(t)[:-1]], tokens(t)))
    assert len(images) > 2 and sum(Trie(mapped(bytes(r.image))).successors.n for r in images) == len(want)
    assert total == sum(want.values())
