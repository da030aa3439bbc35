"""Incremental reports: only items that arrived since the last run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.constants import CATEGORIES
from corpusmill.operators.vectors import zero_shot


def vector_stream(spark: SparkSession, path: str, schema, name: str | None = None) -> DataFrame:
    """New Parquet files below ``path`` as a stream.

    With a ``name`` it is the table of that name there, one file or a folder of
    part files. The name goes in as a glob, which unlike a plain path may be either.
    """
    reader = spark.readStream.schema(schema)
    return reader.parquet(f"{path.rstrip('/')}/{{{name}}}" if name else path)


def stream_report(
    stream: DataFrame,
    prototypes: DataFrame,
    path: str,
    checkpoint: str,
    margin: float = 0.005,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Classify what is new and append it to the report at ``path``.

    The checkpoint remembers the finished files, which is what resuming means.
    A batch writes its own ``batch=<id>`` folder and overwrites it when it is
    replayed, so a lost executor or driver never doubles rows. ``enrich`` adds
    columns (quality scores) to each batch. Centroid-based signals need whole
    labels and are left to the batch report.
    """

    prototypes = prototypes.sparkSession.createDataFrame(prototypes.toArrow(), prototypes.schema)  # one per category

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = zero_shot(batch, prototypes, CATEGORIES, margin=margin).drop("embedding")
        rows = enrich(rows) if enrich else rows
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.parquet(path).drop("batch")


def finished_labels(report: DataFrame, label: str = "label") -> DataFrame:
    return report.groupBy(label).agg(F.count(F.lit(1)).alias("items"))
