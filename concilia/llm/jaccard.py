"""Jaccard join of documents on word shingles, with Bayesian pruning of candidates.

Documents with the same set of shingles are one class. MinHash values are compared incrementally, a
few at a time: with a uniform prior, the posterior probability that the similarity reaches the
threshold, given m matches of n, is a binomial tail; pairs for which it falls below TOLERANCE are
dropped, and the rest are verified exactly on the shingle sets.

1. Classes that share a band of MinHash values meet in a bucket. Buckets with the same members are
   one. Tasks compare the first values of a bucket's pairs, with rows enough to tell which pairs
   survive, and give a spanning forest of these.
2. The components of that forest hold every pair that survived and little else. Tasks compare all
   their values and verify what is left exactly, and give counts of links and again a forest, never
   lists of pairs.

32 bands of 6 values miss a pair of similarity 0.8 with a probability of 6e-5. Large buckets and
components are cut into blocks (blocks.py).

Words are runs of non-blank characters in lower case. A text of fewer than SHINGLE words has one
shingle of all its words.

Defined cases: null and empty texts have no shingles; they are one class without links to others.
Repeated rows are members of their class; ids may be null; an empty table gives no rows; other
columns are ignored by ``join`` and kept by ``deduplicated``, whatever their names.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import block_pairs, inner_pairs, reached, runs, sharded
from .common import by_number, carried, components, cut, documents, name_of, text_key, unused

SHINGLE, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
BANDS, ROWS, SEED = 32, 6, 77
STEP = 8  # MinHash values compared at a time
FIRST = 64  # values that decide which pairs make a component
FIRST_BLOCK, FIRST_ROWS = 2000, 20_000
BLOCK, ROWS_EACH, SMALL = 400, 3_000, 32
CACHE_WORDS = 100_000


class Words(dict):
    """word -> 64-bit hash; emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


#: One bounded table of words a worker; tasks empty it when they end.
words_seen = _words = Words()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(1, len(h) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(min(size, len(h))):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(out)


def minhash(s: np.ndarray, n: int = BANDS * ROWS, seed: int = SEED) -> np.ndarray:
    """n MinHash values of 16 bits."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 2**63, n, dtype=np.uint64) | np.uint64(1)
    b = rng.integers(0, 2**63, n, dtype=np.uint64)
    best = np.full(n, np.iinfo(np.uint64).max)
    for at in range(0, len(s), 2048):
        best = np.minimum(best, (a[:, None] * s[None, at : at + 2048] + b[:, None]).min(axis=1))
    return (mixed(best) >> np.uint64(48)).astype("<u2")


def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """Fewest matches of n that keep P(similarity >= threshold) at the tolerance or above."""
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= tolerance:
            return m
    return n


def signatures(df: DataFrame, size: int) -> DataFrame:
    """For each row: doc_id, key (of the text), set (digest of its shingles), sig (null if there are none)."""

    def run(batches):
        for pdf in batches:
            rows = []
            for doc_id, key, text in zip(pdf.doc_id, pdf.key, pdf.text):
                s = shingles(text, size)
                rows.append((doc_id, key, xxhash.xxh128_digest(s.tobytes()), minhash(s).tobytes() if len(s) else None))
            yield pd.DataFrame(rows, columns=["doc_id", "key", "set", "sig"])
        _words.clear()

    return by_number(carried(df, text_key(F.col("text")).alias("key"), "text").mapInPandas(run, "doc_id string, key string, set binary, sig binary"))


def survivors(sig: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that no step of the comparison of MinHash values drops."""
    matches = np.zeros(len(i), dtype=np.int32)
    for n in range(STEP, sig.shape[1] + 1, STEP):
        matches += (sig[i, n - STEP : n] == sig[j, n - STEP : n]).sum(axis=1)
        keep = matches >= least_matches(n, threshold, tolerance)
        i, j, matches = i[keep], j[keep], matches[keep]
    return i, j


def overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of pairs of sets."""
    if len(i) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)], dtype=np.int64)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    new = np.cumsum(counts > 1) - 1  # only values of two sets or more matter
    keep = counts[inverse] > 1
    row, column = row[keep], new[inverse[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for at in range(0, int((counts > 1).sum()), 8192):
        a, b = np.searchsorted(column, [at, at + 8192])
        x = np.zeros((len(sets), 8192), dtype=np.float32)
        x[row[a:b], column[a:b] - at] = 1
        out += x @ x.T
    return out[i, j].astype(np.int64)


FOUND = "id long, n long, root long"


def stacked(sigs) -> np.ndarray:
    return np.stack([np.frombuffer(x, dtype="<u2") for x in sigs])


def spread(key: np.ndarray, small: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Where the run of each row ends, for runs of ``small`` rows at most, and the larger runs."""
    ends, large = np.arange(len(key)) + 1, []
    for a, b in runs(key):
        if b - a <= small:
            ends[a:b] = b
        else:
            large.append((a, b))
    return ends, large


def linked_first(units: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """id, root: a spanning forest of the pairs in a bucket whose first values keep them."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["band", "bi", "bj", "own", "id"], kind="stable")
        sig, own, ids = stacked(pdf.head_), pdf.own.to_numpy(), pdf.id.to_numpy()
        crossing = (pdf.bi != pdf.bj).to_numpy()
        ends, large = spread(pdf[["band", "bi", "bj"]].to_numpy(), SMALL)
        found = []
        for i, j in inner_pairs(ends, 200_000):
            keep = ~crossing[i] | (own[i] != own[j])
            found.append(survivors(sig, i[keep], j[keep], threshold, tolerance))
        for a, b in large:
            label = np.arange(b - a)
            for k in range(b - a - 1):  # a row is compared with those that it isn't linked with yet
                j = k + 1 + np.flatnonzero(label[k + 1 :] != label[k])
                if crossing[a]:
                    j = j[own[a + j] != own[a + k]]
                if len(j):
                    i, j = survivors(sig, np.full(len(j), a + k), a + j, threshold, tolerance)
                    if len(j):
                        label[np.isin(label, label[j - a])] = label[k]
                        found.append((i, j))
        i, j = (np.concatenate([f[n] for f in found]) for n in (0, 1)) if found else (np.empty(0, dtype=np.int64),) * 2
        there, place = np.unique(ids[np.concatenate([i, j])], return_inverse=True)
        root = there[reached(len(there), place[: len(i)], place[len(i) :])]
        return pd.DataFrame({"id": there, "root": root})[there != root]

    return units.groupBy("_shard").applyInPandas(run, "id long, root long")


def verified(units: DataFrame, size: int, threshold: float, tolerance: float) -> DataFrame:
    """id, n (weights of partners found here), root of the linked classes of each shard."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["component", "bi", "bj", "own", "id"], kind="stable")
        sig, own, ids, weight, texts = stacked(pdf.sig), pdf.own.to_numpy(), pdf.id.to_numpy(), pdf.w.to_numpy(), pdf.text.tolist()
        crossing = (pdf.bi != pdf.bj).to_numpy()
        ends, large = spread(pdf[["component", "bi", "bj"]].to_numpy(), SMALL)
        found = []

        def tell(pairs: list[tuple[np.ndarray, np.ndarray]]) -> None:
            """Those of the pairs whose sets are similar enough."""
            i, j = (np.concatenate([p[n] for p in pairs]) for n in (0, 1))
            if not len(i):  # all values of a large run can drop every pair that the first values kept
                return
            rows, place = np.unique(np.concatenate([i, j]), return_inverse=True)
            sets = [shingles(texts[k], size) for k in rows]
            n = np.array([len(s) for s in sets], dtype=np.int64)
            a, b = place[: len(i)], place[len(i) :]
            both = overlaps(sets, a, b)
            keep = both >= threshold * (n[a] + n[b] - both) - 1e-9
            found.append((i[keep], j[keep]))

        for i, j in inner_pairs(ends, 200_000):
            keep = ~crossing[i] | (own[i] != own[j])
            kept = survivors(sig, i[keep], j[keep], threshold, tolerance)
            for at in range(0, len(kept[0]), 2_000):  # so that few sets are held at once
                tell([(kept[0][at : at + 2_000], kept[1][at : at + 2_000])])
        for a, b in large:
            pairs = []
            for k in range(a, b - 1):  # row by row, so memory stays linear in the block
                j = np.arange(k + 1, b)
                if crossing[a]:
                    j = j[own[j] != own[k]]
                if len(j):
                    pairs.append(survivors(sig, np.full(len(j), k), j, threshold, tolerance))
            if pairs:
                tell(pairs)
        _words.clear()
        i, j = (np.concatenate([f[n] for f in found]) for n in (0, 1)) if found else (np.empty(0, dtype=np.int64),) * 2
        there, place = np.unique(ids[np.concatenate([i, j])], return_inverse=True)
        i_, j_ = place[: len(i)], place[len(i) :]
        n = np.zeros(len(there))
        np.add.at(n, i_, weight[j])
        np.add.at(n, j_, weight[i])
        return pd.DataFrame({"id": there, "n": n.astype(np.int64), "root": there[reached(len(there), i_, j_)]})

    return units.groupBy("_shard").applyInPandas(run, FOUND)


def candidates(classes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """node, component of classes (id, sig) that share a band and the first values with another."""
    width = 2 * ROWS  # bytes of a band
    bands = F.array(*[F.xxhash64(F.lit(k), F.substring("sig", k * width + 1, width)) for k in range(BANDS)])
    banded = classes.where("sig is not null").select("id", F.explode(bands).alias("band"))
    sizes = banded.groupBy("band").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.sum(F.col("id").cast("double")).alias("s"), F.min("id").alias("least")).where("n > 1")
    # Of buckets with the same members one is enough.
    kept = cut(sizes.groupBy("n", "x", "s", "least").agg(F.min("band").alias("band")).select("band"))
    units = block_pairs(cut(banded.join(kept, "band", "left_semi")), ["band"], "id", FIRST_BLOCK)
    units = sharded(cut(units), ["band", "bi", "bj"], FIRST_ROWS)
    heads = classes.select("id", F.substring("sig", 1, 2 * FIRST).alias("head_"))
    forest = linked_first(units.join(heads, "id"), threshold, tolerance)
    return components(forest.select(F.col("id").alias("a"), F.col("root").alias("b")))


def join(df: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """For each row of df (doc_id, text): doc_id, key, class_id, n_links, group_id, kept.

    class_id is the smallest doc_id with the same shingles, n_links counts other rows of similarity
    at the threshold or above, group_id is the smallest doc_id reachable by links, and one row of
    each group is kept. Classes are ordered by their smallest (doc_id, text hash), so ids that
    clash do no harm.
    """
    rows = cut(signatures(df, size))
    classes = cut(rows.groupBy("set").agg(F.min(F.struct("doc_id", "key")).alias("first"), F.count("*").alias("w"), F.first("sig", True).alias("sig")).select("set", "w", "sig", "first.*"))
    classes = classes.withColumn("id", F.monotonically_increasing_id())  # of a written table, so it stays
    members = cut(classes.join(candidates(classes, threshold, tolerance), F.col("id") == F.col("node")).select("id", "component", "w", "sig", "doc_id", "key"))
    # Of repeated rows with one id and text, one is enough.
    named = members.select("id", "w", "sig", F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "key"))).alias("name"))
    work = named.join(df.select(name_of().alias("name"), "text"), "name").dropDuplicates(["id"]).drop("name")
    units = sharded(cut(block_pairs(members.select("id", "component"), ["component"], "id", BLOCK)), ["component", "bi", "bj"], ROWS_EACH)
    linked = cut(verified(units.join(work, "id"), size, threshold, tolerance))
    links = linked.groupBy("id").agg(F.sum("n").alias("n"))
    groups = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    group_of = classes.select("id", "set", "w", "doc_id", "key").join(links, "id", "left").join(groups, F.col("id") == F.col("node"), "left")
    group_of = group_of.select("set", "doc_id", "key", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "id").alias("grp"))
    leaders = group_of.groupBy("grp").agg(F.min(F.struct("doc_id", "key")).alias("leader"))
    by_class = cut(group_of.join(leaders, "grp").select("set", F.col("doc_id").alias("class_id"), "n_links", F.col("leader.doc_id").alias("group_id"), F.col("leader.key").alias("group_key")))
    kept = F.col("doc_id").eqNullSafe(F.col("group_id")) & (F.col("key") == F.col("group_key"))
    return rows.select("doc_id", "key", "set").join(by_class, "set").select("doc_id", "key", "class_id", "n_links", "group_id", kept.alias("kept"))


def deduplicated(df: DataFrame) -> DataFrame:
    """The rows of df that stay: one of each group. All columns are kept."""
    name = unused(df, "_name")
    kept = join(df).where("kept").select(F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "key"))).alias(name)).distinct()
    return df.withColumn(name, name_of()).join(kept, name, "left_semi").dropDuplicates([name]).drop(name)


def op7_jaccard_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(documents(spark, sf_dir)).drop("key")


QUERIES = {"op7_jaccard_bayes": op7_jaccard_bayes}
SQL: dict[str, str] = {}
