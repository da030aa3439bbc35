"""Embedding store: Parquet rows with an ``array<float>`` vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_embeddings(
    vectors: DataFrame, path: str, partition_by: str | None = "split", mode: str = "errorifexists"
) -> None:
    """Items without a vector are not stored."""
    rows = vectors.filter(F.size("embedding") > 0)
    writer = rows.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.size("embedding") > 0)
