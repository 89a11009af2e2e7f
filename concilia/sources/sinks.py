"""Whole tables, replaced at once: a run writes beside the present table and a marker names what is current.

A marker is renamed into place, so a reader sees the old table or the new one. A run that is repeated
under its name after it was committed changes nothing; one that died before that is written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CURRENT = "_CURRENT"


class Table:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, path
        self.paths = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.paths(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.paths(f"{self.root}/{name}")

    def current(self) -> str | None:
        """The run whose rows are the table, null before the first."""
        if not self.fs.exists(self.at(CURRENT)):
            return None
        stream = self.fs.open(self.at(CURRENT))
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def read(self) -> DataFrame:
        if (run := self.current()) is None:
            raise LookupError(f"{self.root} has no table yet")
        return self.spark.read.parquet(f"{self.root}/{run}")

    def stage(self, df: DataFrame, run: str, *by: str) -> None:
        """Write the rows of a run, partitioned by columns: several tables in one pass."""
        df.write.mode("overwrite").partitionBy(*by).parquet(f"{self.root}/{run}")

    def commit(self, run: str) -> None:
        """Make a staged run the table."""
        if not self.fs.exists(self.at(f"{run}/_SUCCESS")):
            raise LookupError(f"run {run} of {self.root} is not complete")
        new = self.at(f"{CURRENT}.{run}")
        stream = self.fs.create(new, True)
        try:
            stream.writeUTF(run)
        finally:
            stream.close()
        options = self.spark._jvm.java.lang.reflect.Array.newInstance(self.spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        self.spark._jvm.java.lang.reflect.Array.set(options, 0, getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE)
        self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.getFileSystem(self.spark._jsc.hadoopConfiguration()).getUri(), self.spark._jsc.hadoopConfiguration()).rename(new, self.at(CURRENT), options)

    def replace(self, df: DataFrame, run: str, *by: str) -> bool:
        """Make df the table, as run ``run``. False if that run is the table already."""
        if self.current() == run:
            return False
        self.stage(df, run, *by)
        self.commit(run)
        return True
