"""Sinks: replacing a document's rows, latest-wins upserts, JSON artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def replace_partitions(df: DataFrame, path: str, bucket: str) -> None:
    """Writes ``df`` so that only the buckets it holds are replaced; other buckets of the table stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(bucket).parquet(path)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of both, of each key the one with the greatest ``order`` (the new one on a tie)."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(order), F.desc("__new"))
    return both.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r", "__new")


def append_unseen(table: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """``table`` and those rows of ``more`` whose key it does not hold."""
    return table.unionByName(more.join(table.select(key), key, "left_anti"), allowMissingColumns=True)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a line."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
