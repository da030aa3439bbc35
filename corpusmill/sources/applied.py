"""A verdict applied in one pass and published in two steps.

Kept and rejected rows are written by one job, side by side as partitions of a
run folder of their own; their totals are observed in that job. Only when it
has ended does a row in the ``published`` log name the run. A failed run leaves
a folder that no reader looks at, and the last published one in place.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "sequence bigint, run string, kept bigint, removed bigint"


def published_runs(spark: SparkSession, path: str) -> DataFrame:
    """The log ``(sequence, run, kept, removed)``, empty before the first run."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{path}/published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def _last(spark: SparkSession, path: str) -> Row | None:
    return published_runs(spark, path).orderBy(F.desc("sequence"), F.desc("run")).first()


def publish(verdicts: DataFrame, path: str) -> tuple[int, int]:
    """Write the verdicts (with a ``removed`` column) as a new run and publish it: ``(kept, removed)`` totals.

    One writer at a time; a null ``removed`` counts as kept.
    """
    spark, run = verdicts.sparkSession, uuid.uuid4().hex
    gone = F.coalesce(F.col("removed"), F.lit(False))
    totals = Observation()
    (
        verdicts.withColumn("side", F.when(gone, "rejected").otherwise("kept"))
        .observe(totals, F.count_if(~gone).alias("kept"), F.count_if(gone).alias("removed"))
        .write.partitionBy("side").parquet(f"{path}/runs/{run}")
    )
    found = totals.get
    kept, removed = found.get("kept") or 0, found.get("removed") or 0
    before = _last(spark, path)
    entry = spark.createDataFrame([(before["sequence"] + 1 if before else 0, run, kept, removed)], LOG_SCHEMA)
    entry.coalesce(1).write.mode("append").parquet(f"{path}/published")
    return kept, removed


def read_published(spark: SparkSession, path: str, side: str | None = None) -> DataFrame:
    """Rows of the last published run with their ``side``; one side reads only its own files."""
    last = _last(spark, path)
    if last is None:
        raise ValueError(f"nothing has been published below {path}")
    if side is not None and last["kept" if side == "kept" else "removed"] == 0:
        return spark.read.parquet(f"{path}/runs/{last['run']}").filter(F.lit(False))
    rows = spark.read.parquet(f"{path}/runs/{last['run']}")
    return rows if side is None else rows.filter(F.col("side") == side)
