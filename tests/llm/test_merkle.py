"""The manifest against the definition, level by level, in plain Python."""

import random
import zlib
from collections import Counter
from hashlib import sha256

import pytest

from compare import compare
from concilia.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, idx long"


def h(parts) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text) -> str:
    return h("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (*row[:4], text))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(out[-1][k : k + 16]) for k in range(0, len(out[-1]), 16)])
    return out


def steps(levels, at):
    """(left, right) siblings of node ``at`` on each level."""
    out = []
    for level in levels[:-1]:
        run = at - at % 16
        out.append(("".join(level[run:at]), "".join(level[at + 1 : run + 16])))
        at //= 16
    return out


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(b"" if r[1] is None else b"1" + r[1].encode(), []).append(r)
    trees = []
    for s in sorted(by):
        mine = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4])))
        trees.append((mine, levels_of([leaf_of(r, r[4]) for r in mine])))
    top = levels_of([t[-1][0] for _, t in trees])
    root = top[-1][0] if rows else None
    for k, (mine, tree) in enumerate(trees):
        for at, r in enumerate(mine):
            path = steps(tree, at) + steps(top, k)
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = text.translate(str.maketrans(merkle.UPPER, merkle.LOWER))
            node = leaf_of(r, text)
            for left, right in path:
                node = h([left, node, right])
            yield (r[0], tree[0][at], tree[-1][0], root, h(x for step in path for x in step), node, node == root)


def made(n, sources, seed):
    rng = random.Random(seed)
    return [(k * 3, sources[rng.randrange(len(sources))] if k % 3 else sources[0], rng.choice(["en", None]), rng.choice([k, None]), rng.choice(["Über Straße", "plain", "", None, "x" * 5000 + "A", "İI"]), "t", 1) for k in range(n)]


@pytest.mark.parametrize("n, sources, each", [(700, ["hot", "b", None, "é", ""], 40), (1, ["only"], 9), (16, ["only"], 5), (17, ["only"], 3), (300, ["only"], 11), (90, [f"s{k}" for k in range(40)], 7)])
def test_equals_definition(spark, monkeypatch, n, sources, each):
    monkeypatch.setattr(merkle.indexed, "__defaults__", (each,))
    rows = made(n, sources, n)
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(map(tuple, got)) == Counter(brute(rows))


def test_ties_nulls_and_nothing(spark, monkeypatch):
    monkeypatch.setattr(merkle.indexed, "__defaults__", (5,))
    rows = [(None, None, None, None, None, "t", 1)] * 3 + [(7, "a", "en", 1, t, "t", 1) for t in ("B", "A", "C", "B2")] + [(2**63 - 1, "a", None, 2, "Z", "t", 1)]
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(map(tuple, got)) == Counter(brute(rows))
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("start", [0, 1, 15, 16, 250, 256])
def test_peaks_emit_every_completed_node_once(start):
    """Completed parents carry; edges stay open; a node's children are all closed by it or all open."""
    leaves = [(k, h([str(k)])) for k in range(start, start + 600)]
    found = list(merkle.peaks(iter(leaves), start))
    assert len({(lv, i) for lv, i, _, _ in found}) == len(found)
    digests = {(lv, i): d for lv, i, d, _ in found} | {(0, i): d for i, d in leaves}
    for lv, i, d, _ in found:
        if lv:
            assert d == h(digests[lv - 1, c] for c in range(16 * i, 16 * i + 16))
    assert sum(o for *_, o in found) <= 30 * 4


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r[x] for x in merkle.FIELDS) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert Counter(map(tuple, merkle.op11_merkle_manifest(spark, sf).collect())) == Counter(brute(rows))


def test_equals_sql(spark):
    compare(spark, merkle.op11_merkle_manifest, merkle.SQL["op11_merkle_manifest"], "/root/testdata/sf0.01")
