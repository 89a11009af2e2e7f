"""Reports of titled blocks: every line has its number, found without bringing a block into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stage import cut

EMPTY = "— sin diferencias —"


def numbered(df: DataFrame, order: str, out: str) -> DataFrame:
    """df with ``out``, the place of each row by ``order`` from 0, gapless: range partitions are sorted by themselves, and sizes of those before give the offset."""
    dealt = cut(df.repartitionByRange(F.col(order)).withColumn("_part", F.spark_partition_id()))
    starts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each partition
    starts = starts.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return dealt.withColumn("_place", place).join(F.broadcast(starts), "_part").withColumn(out, F.col("_start") + F.col("_place")).drop("_part", "_place", "_start")


def first_place_last_value(df: DataFrame, key: str, order: str = "_row") -> DataFrame:
    """One row for each key: the values of its last row, and ``_first``, the number of its first, which is where it stands."""
    ends = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("_first"), F.max(order).alias(order))
    return df.join(ends, [key, order])


def told(cells: list[Column]) -> Column:
    return F.concat_ws("\t", *[F.coalesce(x.cast("string"), F.lit("")) for x in cells])


def laid_out(spark, summary: list[tuple[str, int]], blocks: list[tuple[str, list[str], DataFrame, list[Column]]]) -> DataFrame:
    """block, line, clase, texto of a report: the summary, then each block (title, header, rows with _first, cells), two lines apart; an empty block has a placeholder."""
    fixed = [(0, 1, "cabecera", "Métrica\tValor")] + [(0, 2 + k, "fila", f"{name}\t{n}") for k, (name, n) in enumerate(summary)]
    line, out = len(fixed) + 2, None
    for k, (title, header, rows, cells) in enumerate(blocks, 1):
        fixed.append((k, line, "título", title))
        placed = numbered(rows, "_first", "_at")
        n = rows.count()
        fixed.append((k, line + 1, "cabecera", "\t".join(header)) if n else (k, line + 1, "vacío", EMPTY))
        body = placed.select(F.lit(k).alias("block"), (F.col("_at") + line + 2).cast("long").alias("line"), F.lit("fila").alias("clase"), told(cells).alias("texto"))
        out = body if out is None else out.unionByName(body)
        line += 1 + (n + 2 if n else 2)
    return out.unionByName(spark.createDataFrame(fixed, "block int, line long, clase string, texto string"))
