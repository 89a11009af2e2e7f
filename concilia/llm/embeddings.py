"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations, with multiprobe.

A hash function flips signs and applies the Walsh-Hadamard transform three times, then takes the
coordinate of largest magnitude with its sign. A table's bucket joins several such values; besides
its own bucket, a vector probes the buckets whose next-best coordinates come closest. Pairs in a
bucket (at least one of them by its own hash) are verified by cosine in double precision. Every pair
is counted once, in the first table and lowest bucket where both meet, so no list of pairs is
written or shuffled: tasks give counts and a spanning forest.

The number of values joined grows with the logarithm of the number of vectors, so buckets stay
small however many there are; tables and probes grow along, so that a pair at the threshold is
missed with a probability of 1e-4 or less (SCHEMES).

Identical vectors count as one with a weight. Large buckets are cut into blocks (blocks.py).

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with
nothing; vectors of different lengths don't link; repeated rows are rows of their own; rows without
vec_id take part, and a component has the smallest vec_id that is there, null if none; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import block_pairs, inner_pairs, reached, runs, sharded
from .common import components, cut

THRESHOLD, SEED = 0.95, 2024
#: Tables and probes by the number of hash values in a bucket's name. Measured on pairs at the threshold in 64
#: dimensions, a table finds a share of 0.949, 0.731, 0.633 and 0.561 of them.
SCHEMES = {1: (4, 2), 2: (8, 2), 3: (10, 4), 4: (12, 8)}
#: Vectors that a bucket may hold on average before its name gets another value.
BUCKET = 8
BLOCK, ROWS_EACH, SMALL = 1000, 20_000, 64


def hashes_for(n: int, d: int) -> int:
    """Hash values in a bucket's name for n vectors of padded dimension d."""
    return next((h for h in SCHEMES if BUCKET * (2 * d) ** h >= n), max(SCHEMES))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (their length a power of two), normalised."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def buckets(x: np.ndarray, of: int, seed: int = SEED) -> np.ndarray:
    """(rows, tables, 1 + probes): the own bucket of each unit vector in x, one of ``of`` in all, and the buckets it probes."""
    n, dims = x.shape
    d = 1 << max(1, (dims - 1).bit_length())
    hashes = hashes_for(of, d)
    tables, probes = SCHEMES[hashes]
    signs = np.random.default_rng([seed, dims]).choice([-1.0, 1.0], (tables, hashes, 3, d))
    padded = np.zeros((n, d))
    padded[:, :dims] = x
    out = np.empty((n, tables, 1 + probes), dtype=np.int64)
    each = np.arange(n)
    depth = min(3, d)
    for t in range(tables):
        best, lost = [], []
        for k in range(hashes):
            y = padded
            for r in range(3):
                y = hadamard(y * signs[t, k, r])
            size = np.abs(y)
            top = np.argsort(-size, axis=1)[:, :depth] if depth == d else np.take_along_axis(c := np.argpartition(-size, depth, axis=1)[:, :depth], np.argsort(-np.take_along_axis(size, c, 1), axis=1), 1)
            best.append(2 * top + (np.take_along_axis(y, top, 1) < 0))
            values = np.take_along_axis(size, top, 1)
            lost.append((values[:, :1] - values) ** 2)
        # Probes: every choice of ranks per hash, in order of the squared loss, as in multiprobe schemes.
        ranks = np.stack(np.meshgrid(*[range(depth)] * hashes, indexing="ij"), -1).reshape(-1, hashes)
        cost = sum(lost[k][:, ranks[:, k]] for k in range(hashes))
        pick = np.argsort(cost, axis=1, kind="stable")[:, : 1 + probes]
        code = np.zeros((n, pick.shape[1]), dtype=np.int64)
        for k in range(hashes):
            code = code * (2 * d) + best[k][each[:, None], ranks[pick, k]]
        out[:, t, : pick.shape[1]] = code
        out[:, t, pick.shape[1] :] = code[:, -1:]
    return out


def unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    # By a power of two, which is exact: squares of very large or small components would leave the range of a double.
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def entries(classes: DataFrame, of: int) -> DataFrame:
    """A row for each bucket that a class is in: dims, t, bucket, own_hash."""

    def run(batches):
        for pdf in batches:
            for dims, part in pdf.groupby(pdf.v.map(len)):
                code = buckets(unit(part.v), of)
                n, t, p = code.shape
                at, table, probe = np.indices(code.shape).reshape(3, -1)
                rows = pd.DataFrame({"id": part.id.to_numpy()[at], "t": table, "bucket": code.ravel(), "own_hash": probe == 0})
                # A repeated probe adds nothing; the own hash comes first and stays.
                rows = rows.drop_duplicates(["id", "t", "bucket"])
                yield rows.assign(dims=dims)[["id", "dims", "t", "bucket", "own_hash"]]

    return classes.select("id", "v").mapInPandas(run, "id long, dims int, t int, bucket long, own_hash boolean")


def counted(code: np.ndarray, i: np.ndarray, j: np.ndarray, t: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether each pair (i, j) is counted in its table and bucket: the first table, and its lowest bucket, where both meet."""
    out = np.empty(len(i), dtype=bool)
    never = np.iinfo(np.int64).max
    for at in range(0, len(out), 20_000):
        a, b = code[i[at : at + 20_000]], code[j[at : at + 20_000]]
        meet = np.full(a.shape[:2], never)
        for p in range(a.shape[2]):
            for x, y in ((a[:, :, 0], b[:, :, p]), (a[:, :, p], b[:, :, 0])):
                meet = np.minimum(meet, np.where(x == y, x, never))
        first = (meet < never).argmax(axis=1)
        out[at : at + 20_000] = (first == t[at : at + 20_000]) & (meet[np.arange(len(a)), first] == bucket[at : at + 20_000])
    return out


def close(x: np.ndarray, key: np.ndarray, own: np.ndarray, hashed: np.ndarray, ids: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows in one unit of work (key: dims, t, bucket, bi, bj) that are near enough."""
    spans = np.array(runs(key))
    size = spans[:, 1] - spans[:, 0]
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def tell(i: np.ndarray, j: np.ndarray) -> None:
        keep = (hashed[i] | hashed[j]) & (ids[i] != ids[j]) & ((key[i, 3] == key[i, 4]) | (own[i] != own[j]))
        found.append((i[keep], j[keep]))

    # Small units go together, pair by pair; large ones each by a product of matrices.
    small = size <= SMALL
    ends = np.arange(len(x)) + 1
    for a, b in spans[small & (size > 1)]:
        ends[a:b] = b
    for i, j in inner_pairs(ends, 50_000):
        near = np.einsum("ij,ij->i", x[i], x[j]) >= threshold
        tell(i[near], j[near])
    for a, b in spans[~small]:
        i, j = np.nonzero(np.triu(x[a:b] @ x[a:b].T >= threshold, 1))
        tell(i + a, j + a)
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (np.empty(0, dtype=np.int64),) * 2


def verified(units: DataFrame, threshold: float, of: int) -> DataFrame:
    """id, n (weights of partners counted here), root (smallest linked id) of the linked rows of each shard."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = ["dims", "t", "bucket", "bi", "bj"]
        out = []
        for _, part in pdf.sort_values([*keys, "own", "id"], kind="stable").groupby("dims"):
            key, own, hashed, ids, weight = part[keys].to_numpy(), part.own.to_numpy(), part.own_hash.to_numpy(), part.id.to_numpy(), part.w.to_numpy()
            x = unit(part.v)
            i, j = close(x, key, own, hashed, ids, threshold)
            if not len(i):
                continue
            there, place = np.unique(ids[np.concatenate([i, j])], return_inverse=True)
            at = np.zeros(len(there), dtype=np.int64)
            at[place] = np.concatenate([i, j])  # any row of each class
            i_, j_ = place[: len(i)], place[len(i) :]
            new = counted(buckets(x[at], of), i_, j_, key[i, 1], key[i, 2])
            n = np.zeros(len(there))
            np.add.at(n, i_[new], weight[j[new]])
            np.add.at(n, j_[new], weight[i[new]])
            out.append(pd.DataFrame({"id": there, "n": n.astype(np.int64), "root": there[reached(len(there), i_, j_)]}))
        return pd.concat(out) if out else pd.DataFrame({"id": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64")})

    return units.groupBy("_shard").applyInPandas(run, "id long, n long, root long")


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of df (vec_id: long, embedding: array of float or double)."""
    finite = F.col("embedding").isNotNull() & ~F.coalesce(F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))), F.lit(True)) & F.coalesce(F.exists("embedding", lambda v: v != 0), F.lit(False))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").withColumn("key", F.when(finite, F.md5(F.col("embedding").cast("string"))))
    valid = rows.where("key is not null")
    classes = cut(valid.groupBy("key").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("w"), F.first("embedding").alias("v")))
    classes = classes.withColumn("id", F.monotonically_increasing_id())  # of a written table, so it stays
    of, dims = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    found = cut(entries(classes, of))
    busy = found.groupBy("dims", "t", "bucket").agg(F.count("*").alias("_m"), F.max("own_hash").alias("_h")).where("_m > 1 and _h").drop("_m", "_h")
    units = block_pairs(found.join(busy, ["dims", "t", "bucket"], "left_semi"), ["dims", "t", "bucket"], "id", BLOCK)
    units = sharded(cut(units), ["dims", "t", "bucket", "bi", "bj"], max(2 * BLOCK, ROWS_EACH * 64 // max(64, dims or 0))).join(classes.select("id", "w", "v"), "id")
    linked = cut(verified(units, threshold, of))
    links = linked.groupBy("id").agg(F.sum("n").alias("n"))
    groups = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    by_class = classes.select("key", "id", "vec_id", "w").join(links, "id", "left").join(groups, F.col("id") == F.col("node"), "left").withColumn("grp", F.coalesce("component", "id"))
    least = by_class.groupBy("grp").agg(F.min("vec_id").alias("component"))
    by_class = by_class.drop("component").join(least, "grp").select("key", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component")
    out = rows.select("vec_id", "key").join(by_class, "key", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op1_embedding_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


QUERIES = {"op1_embedding_cross_polytope": op1_embedding_cross_polytope}
SQL: dict[str, str] = {}
