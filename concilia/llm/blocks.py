"""Groups of rows whose pairs are compared in tasks: large groups are cut into blocks, and every pair of blocks is a unit of work."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def block_pairs(rows: DataFrame, group: list[str], order: str, size: int) -> DataFrame:
    """Add bi, bj, own to rows of groups with two rows or more; a row is in unit (bi, bj) as part of block own.

    A group of n rows has m = ceil(n / size) blocks, and each of its rows goes to m units: no task
    holds more than about two blocks, however large the group.
    """
    sizes = cut(rows.groupBy(*group).agg(F.count("*").alias("_n")).where("_n > 1"))  # cut, so that Spark can split a large group's side of the join
    m = F.ceil(F.col("_n") / size).cast("int")
    dealt = rows.join(sizes, group).withColumn("own", F.pmod(F.xxhash64(order), m).cast("int"))
    units = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), m - 1)))
    return units.withColumn("bi", F.least("own", "_other")).withColumn("bj", F.greatest("own", "_other")).drop("_n", "_other")


def sharded(units: DataFrame, keys: list[str], rows_each: int) -> DataFrame:
    """Add _shard: units of work are dealt by hash, about rows_each rows to a shard."""
    n = max(1, -(-units.count() // rows_each))
    return units.withColumn("_shard", F.pmod(F.xxhash64(*keys), F.lit(n)))


def runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of each run of equal rows of a sorted 2-D array."""
    if not len(keys):
        return []
    at = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    return list(zip([0, *at.tolist()], [*at.tolist(), len(keys)]))


def roots(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix, the smallest index that it reaches."""
    return reached(len(near), *np.nonzero(near))


def reached(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes, the smallest index that it reaches by the edges (i, j): hooking and pointer jumping."""
    label = np.arange(n)
    while (apart := label[i] != label[j]).any():
        a, b = label[i[apart]], label[j[apart]]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label[label] != label).any():
            label = label[label]
    return label


def inner_pairs(ends: np.ndarray, most: int):
    """(i, j), i < j, of all rows in one run, about ``most`` pairs at a time; ends[i] is where the run of row i ends."""
    counts = ends - np.arange(len(ends)) - 1
    total = np.cumsum(counts)
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most)))
        n = counts[at:to]
        i = np.repeat(np.arange(at, to), n)
        if len(i):
            yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        at = to
