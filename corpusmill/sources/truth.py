"""Ground-truth store and sweep results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.operators.splits import upsert

TRUTH = "item_id string, label string, source string, species string, reject_reason string, seq bigint"


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRUTH).parquet(path)


def add_labels(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Ground truth in which the last write of each item wins."""
    return upsert(existing, incoming, ["item_id"], "seq")


def write_ground_truth(truth: DataFrame, path: str, mode: str = "errorifexists") -> None:
    truth.write.mode(mode).parquet(path)


def write_sweep(swept: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Sweep rows (one per threshold) as JSON lines, best f1 first."""
    swept.coalesce(1).sortWithinPartitions(swept["f1"].desc(), "min_composite").write.mode(mode).json(path)
