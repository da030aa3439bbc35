"""Streaming queries over the embedding file."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusmill.functions.constants import CATEGORIES
from corpusmill.operators import vectors as VO
from corpusmill.plans.lineage import ensure_checkpoint_dir
from corpusmill.streaming import moments as M
from corpusmill.streaming.incremental import stream_report, vector_stream
from corpusmill.streaming.live import stream_top_k
from corpusmill.workloads import evaluation as EW
from corpusmill.workloads import vectors as VW
from corpusmill.workloads.tables import table


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/streams-{uuid.uuid4().hex}"


def _stream(spark, sf_dir):
    schema = table(spark, sf_dir, "embeddings").schema
    return vector_stream(spark, sf_dir, schema, "embeddings.parquet").withColumnRenamed("vec_id", "item_id")


def streamed_categories(spark, sf_dir):
    folder = _folder(spark)
    rows = stream_report(
        _stream(spark, sf_dir), VW.prototypes(VW.vectors(spark, sf_dir)), f"{folder}/report", f"{folder}/state"
    )
    return rows.select(
        "item_id", "label", "category", "confidence",
        *[F.col("scores")[c].alias(f"p_{c}") for c in CATEGORIES],
    )


def streamed_top_classes(spark, sf_dir):
    folder = _folder(spark)
    stream = _stream(spark, sf_dir)
    logits = (
        stream.select("item_id", VO.class_scores(stream, VO.centroids(VW.vectors(spark, sf_dir))).alias("_s"))
        .select("item_id", F.transform("_s", lambda x: x * EW.SCALE).alias("logits"))
    )
    rows = stream_top_k(
        logits, EW._label_map(spark, sf_dir), f"{folder}/decoded", f"{folder}/state", EW._meta(spark, sf_dir)
    )
    return rows.withColumn("probability", F.round("probability", 6))


def _followed(spark, sf_dir):
    """All vectors, and the limits of their labels after they came in several batches."""
    folder, vecs = _folder(spark), VW.vectors(spark, sf_dir)
    part = F.pmod(F.xxhash64("item_id"), F.lit(3)).cast("int")
    vecs.withColumn("part", part).write.partitionBy("part").parquet(f"{folder}/arrived")
    arrived = spark.read.parquet(f"{folder}/arrived")
    each = max(1, len(arrived.inputFiles()) // 3)
    stream = spark.readStream.schema(arrived.schema).option("maxFilesPerTrigger", each).parquet(f"{folder}/arrived")
    return vecs, M.follow(stream.drop("part"), f"{folder}/followed", f"{folder}/progress", margin=0.02)


def streamed_outliers(spark, sf_dir):
    return M.outliers_by_state(*_followed(spark, sf_dir))


def streamed_mislabels(spark, sf_dir):
    vecs, known = _followed(spark, sf_dir)
    return VO.mislabeled(vecs, margin=0.02, cents=known.select("label", "n", "centroid"))


QUERIES = {f.__name__: f for f in (streamed_categories, streamed_top_classes, streamed_outliers, streamed_mislabels)}

ORACLES = {
    "streamed_categories": VW.ORACLES["zero_shot_categories"],
    "streamed_outliers": VW.ORACLES["label_outliers"],
    "streamed_mislabels": VW.ORACLES["mislabel_candidates"],
    "streamed_top_classes": EW.ORACLES["top_classes"],
}
