"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Spark's setting by which an execution's shuffle files go when it ends, in place of when the driver's garbage is collected.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder that the cluster names and read it back without lineage.

    Nothing reads the shuffle files of its execution after that, so they are removed at once.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    conf = df.sparkSession.conf
    before = conf.get(TIDY, "false")
    conf.set(TIDY, "true")
    try:
        return df.select("*").checkpoint()  # an execution of its own, which the setting holds for
    finally:
        conf.set(TIDY, before)


def carried(df: DataFrame, *columns: str) -> DataFrame:
    """doc_id as text, and columns: a long beside a null becomes a double in pandas, which loses its low bits."""
    return df.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), *columns)


def by_number(df: DataFrame) -> DataFrame:
    """The other way: doc_id as a long again."""
    return df.withColumn("doc_id", F.col("doc_id").cast("long"))


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", *more)


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null counts as empty."""
    return F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32)


def name_of(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits for a doc_id (null too) and a text."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("-")), text_key(F.col(text)))))


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def ranked(df: DataFrame, keys: list[str], order: list[str], out: str, rows_each: int = 4_000) -> DataFrame:
    """Number the rows of each key from 0 without gaps.

    The rows of a key are dealt to hash buckets, about ``rows_each`` of all rows to one, and sorted
    within each; bucket sizes give the offsets. No task sees all rows of a hot key, and no global
    window is used. ``order`` should identify rows; ties are numbered in any order, still without gaps.
    """
    salts = max(4, -(-df.count() // rows_each))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    by = [*keys, "_salt"]
    # Offsets in two steps, of about the square root of the number of buckets, so that no window sees all buckets.
    sizes = salted.groupBy(*by).agg(F.count("*").alias("_n")).withColumn("_block", (F.col("_salt") / math.isqrt(salts)).cast("int"))
    before = lambda key, order: Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inner = sizes.withColumn("_in", F.coalesce(F.sum("_n").over(before([*keys, "_block"], "_salt")), F.lit(0))).drop("_n")
    outer = sizes.groupBy(*keys, "_block").agg(F.sum("_n").alias("_n")).withColumn("_out", F.coalesce(F.sum("_n").over(before(keys, "_block")), F.lit(0))).drop("_n")
    base = inner.join(outer, [*keys, "_block"]).select(*by, (F.col("_in") + F.col("_out")).alias("_base"))
    own = salted.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)
    return own.join(base, by).withColumn(out, F.col("_base") + F.col("_rn")).drop("_salt", "_base", "_rn")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): returns (node, component), component the smallest id.

    Each round a node takes the smallest label among itself and its neighbours, and then the label
    of its label (pointer jumping), so chains shrink geometrically. Minima are combined before the
    shuffle. Ids may be long or string; nodes without edges are not returned.
    """
    both = edges.where("a is not null and b is not null and a != b").select("a", "b")
    both = cut(both.union(both.select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")))
    while True:  # labels only fall, so this ends
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("_near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("component").alias("_old"), F.least("component", "_near").alias("_mid"))
        jump = labels.select(F.col("node").alias("_mid"), F.col("component").alias("_far"))
        new = cut(step.join(jump, "_mid", "left").select("node", "_old", F.least("_mid", F.coalesce("_far", "_mid")).alias("component")))
        labels = new.select("node", "component")
        if new.where("_old != component").isEmpty():
            return labels
