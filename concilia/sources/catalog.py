"""Tables by name in several catalogs: folders of parquet tables, looked at by metadata only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


class Catalogs:
    """Named catalogs; a table is the first of its candidate names that a catalog holds."""

    def __init__(self, spark: SparkSession, **roots: str):
        self.spark, self.roots = spark, roots

    def path(self, catalog: str, *names: str) -> str:
        if catalog not in self.roots:
            raise KeyError(f"no catalog {catalog}; there are {sorted(self.roots)}")
        for name in names:
            if exists(self.spark, found := f"{self.roots[catalog]}/{name}.parquet"):
                return found
        raise LookupError(f"catalog {catalog} has no table named {' | '.join(names)}")

    def table(self, catalog: str, *names: str) -> DataFrame:
        return self.spark.read.parquet(self.path(catalog, *names))
