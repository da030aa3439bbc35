"""Stateless decoding of a stream of logits."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusmill.operators.evaluation import top_k


def stream_top_k(
    stream: DataFrame,
    label_map: DataFrame,
    path: str,
    checkpoint: str,
    meta: DataFrame | None = None,
    k: int = 5,
) -> DataFrame:
    """Decode every arriving item to its k likeliest classes, into Parquet.

    The same column expressions as the batch operator; no state is kept.
    """
    query = (
        top_k(stream, label_map, meta, k)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.parquet(path)
