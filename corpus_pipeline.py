"""The corpus pipeline: STAGES in order, each applied to all that its predecessor kept.

Quality classifier (rejected documents go), n-gram Jaccard join (one document of each group stays),
suffix-array dedup (repeated passages go), surrogates for personal data, packing. All stages but the
last return the columns of documents; n_chars follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concilia.llm import jaccard, packing, pii, quality, suffixes

#: Words of a passage whose repetition counts: over fifty, however short they are.
PASSAGE = 51


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.accepted(docs, labels)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicated(docs)


def counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns) if "n_chars" in columns else docs.select(*columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return counted(suffixes.cleaned(docs, least_words=PASSAGE), docs.columns)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return counted(pii.rewritten(docs, entities=None), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("jaccard_join", jaccard_join),
    ("suffix_array_dedup", suffix_dedup),
    ("pii_surrogates", surrogates),
    ("packing", pack),
]

#: Model training, signatures and suffix arrays have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        df = stage(spark, df, sf_dir)
    return df
