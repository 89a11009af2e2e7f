"""Written steps: what several later steps read is computed once, and its lineage ends there.

A step is written column by column and compressed, in the checkpoint folder that the cluster names. Its files go when nothing
refers to it any more, as those of a checkpoint do, or at once when the step that it served is written (``settled``).
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame

#: Spark's setting by which an execution's shuffle files go when it ends, in place of when the driver's garbage is collected.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPLIT, OPEN = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
#: Bytes of a row group, which a task holds while it writes.
GROUP = 32 << 20

#: Folders of the steps that serve the one that is being made.
_serving: ContextVar[list[str] | None] = ContextVar("serving", default=None)


def folder(df: DataFrame) -> str:
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if named is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


class _Set:
    """Settings of a session for a while."""

    def __init__(self, spark, **values: str):
        self.conf, self.values = spark.conf, values

    def __enter__(self):
        self.before = {k: self.conf.get(k, None) for k in self.values}
        for k, v in self.values.items():
            self.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.before.items():
            self.conf.unset(k) if v is None else self.conf.set(k, v)


def cut(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder and read it back without lineage, in as many partitions as were written.

    Nothing reads the shuffle files of its execution after that, so they are removed at once.
    """
    spark, top = df.sparkSession, folder(df)
    sc = spark.sparkContext._jsc.sc()
    number = sc.newRddId()  # the folder of a checkpoint of that number, which the cleaner knows how to remove
    path = f"{top}/rdd-{number}"
    with _Set(spark, **{TIDY: "true"}):
        df.write.option("parquet.block.size", GROUP).parquet(path, compression="zstd")
    with _Set(spark, **{OPEN: spark.conf.get(SPLIT)}):  # a file for each partition
        back = spark.read.schema(df.schema).parquet(path)._jdf
        rows = back.queryExecution().toRdd()
    if (cleaner := sc.cleaner()).isDefined():
        cleaner.get().registerRDDCheckpointDataForCleanup(rows, number)
    if (serving := _serving.get()) is not None:
        serving.append(path)
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, back.schema(), False), spark)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """cut(make()); the steps that make() cut serve nothing else, so their files go at once."""
    token = _serving.set([])
    try:
        df = make()
        own = _serving.get()
    finally:
        _serving.reset(token)
    out = cut(df)
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for path in map(jvm.org.apache.hadoop.fs.Path, own):
        path.getFileSystem(conf).delete(path, True)
    return out
