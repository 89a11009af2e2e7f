"""Relational rules of reconciliation: who wins among duplicates, how tables are matched, filled and compared."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def normalize_header(name: str) -> str:
    text = "".join(c for c in unicodedata.normalize("NFD", re.sub("[\"']", "", name)) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", text).strip().lower()


def resolve(df: DataFrame, candidates: list[str], optional: bool = False) -> Column:
    """The column of the first candidate that a header equals after normalisation."""
    headers: dict[str, str] = {}
    for c in df.columns:
        headers.setdefault(normalize_header(c), c)
    for name in map(normalize_header, candidates):
        if name in headers:
            return df[f"`{headers[name]}`"]
    if optional:
        return F.lit(None).cast("string")
    raise ValueError(f"none of {candidates} is a column; there are {df.columns}")


def ensure_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Append the missing columns, null."""
    there = {normalize_header(c) for c in df.columns}
    return df.withColumns({n: F.lit(None).cast("string") for n in names if normalize_header(n) not in there})


def keep(df: DataFrame, key: str, last: bool = True, order: str = "_row") -> DataFrame:
    """One row per non-null key: the last by order, or the first. Combined before the shuffle."""
    if set(df.columns) == {key, order}:  # numbers alone are combined by hash
        return df.where(F.col(key).isNotNull()).groupBy(key).agg((F.max if last else F.min)(order).alias(order))
    row = F.struct(*df.columns)
    pick = F.max_by(row, order) if last else F.min_by(row, order)
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(pick.alias("_w")).select("_w.*")


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Member rows of keys that occur more than once, with the number of repetitions."""
    n = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("repeticiones")).where("repeticiones > 1")
    return df.join(n, key)


def two_stage(source: DataFrame, target: DataFrame) -> DataFrame:
    """Add match: the target's row by exact key (last wins), else by pair key if the target has that pair once.

    Blank keys match each other. source and target have exact, pair and _row.
    """
    exact = target.groupBy("exact").agg(F.max("_row").alias("by_exact"))
    pair = target.groupBy("pair").agg(F.count("*").alias("_n"), F.min("_row").alias("by_pair")).where("_n = 1").drop("_n")
    return source.join(exact, "exact", "left").join(pair, "pair", "left").withColumn("match", F.coalesce("by_exact", "by_pair"))


def running_max(df: DataFrame, key: str, value: str, start: str, order: str = "_row", block: int = 1_000_000) -> DataFrame:
    """Add accepted: value is at least the largest seen so far for the key, or start.

    Rows of a key are dealt to blocks of ``block`` consecutive row numbers: a block starts from the maxima of those
    before it, so no task holds more of a key than one block, or one number for each of its blocks.
    """
    rows = df.withColumn("_block", F.floor(F.col(order) / block))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    tops = rows.groupBy(key, "_block").agg(F.max(value).alias("_top")).withColumn("_top", F.max("_top").over(before(key).orderBy("_block")))
    seen = F.max(value).over(before(key, "_block").orderBy(order))
    out = rows.withColumn("_seen", seen).join(tops, [key, "_block"], "left")
    return out.withColumn("accepted", F.col(value) >= F.greatest("_seen", "_top", start)).drop("_block", "_seen", "_top")


def full_outer(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str, str]) -> DataFrame:
    """Each key with the side it is on."""
    a, b = left.select(F.col(key).alias("a")).distinct(), right.select(F.col(key).alias("b")).distinct()
    side = F.when(F.col("b").isNull(), names[0]).when(F.col("a").isNull(), names[1]).otherwise(names[2])
    return a.join(b, F.col("a") == F.col("b"), "full_outer").select(F.coalesce("a", "b").alias(key), side.alias("side"))


def cell_pairs(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, col, l, r for each common column of the keys in both; the cells are unpivoted after the one join."""
    both = left.alias("l").join(right.alias("r"), key)
    cells = F.array(*[F.struct(F.lit(c).alias("col"), F.trim(F.coalesce(F.col(f"l.{c}").cast("string"), F.lit(""))).alias("l"), F.trim(F.coalesce(F.col(f"r.{c}").cast("string"), F.lit(""))).alias("r")) for c in columns])
    return both.select(key, F.explode(cells).alias("c")).select(key, "c.*")
