"""COCO tables and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusmill.plans.lineage import written
from corpusmill.plans.ranking import range_rank
from corpusmill.plans.running import running

# The single category of the export.
CATEGORY = (1, "bird", "animal")


def coco_export(items: DataFrame, detections: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(images, annotations, categories), numbered from 1 inside each label.

    Images are numbered by file name, annotations by image and detection order;
    images without detections are listed, unreadable ones as 0 x 0. Only images
    are ranked: an annotation's number is its place inside its image after the
    detections of all earlier images, a running sum over the image numbers.
    Detections are read three times (for counts, their sums and the rows), so
    they are written once, as are the counts.
    """
    detections = written(detections.select("label", "name", "det_idx", "bbox", "score"))
    images = range_rank(
        items.select("label", "name", "width", "height"), ["label"], [F.col("name")], "id"
    )
    found = detections.groupBy("label", "name").agg(F.count(F.lit(1)).alias("_n"))
    counted = written(images.select("label", "name", F.col("id").alias("image_id")).join(found, ["label", "name"]))
    earlier = running(counted, ["label"], "image_id", {"_before": ("sum", F.col("_n"), False)})
    inside = W.partitionBy("label", "name").orderBy("det_idx")
    numbered = detections.join(
        earlier.select("label", "name", "image_id", "_before"), ["label", "name"]
    ).withColumn("id", (F.coalesce("_before", F.lit(0)) + F.row_number().over(inside)).cast("bigint"))
    annotations = numbered.select(
        "label",
        "id",
        "image_id",
        F.lit(CATEGORY[0]).alias("category_id"),
        F.array(*[F.col(f"bbox.{c}") for c in "xywh"]).alias("bbox"),
        (F.col("bbox.w") * F.col("bbox.h")).alias("area"),
        "score",
        F.lit(0).alias("iscrowd"),
    )
    categories = items.sparkSession.range(1).select(
        F.lit(CATEGORY[0]).alias("id"), F.lit(CATEGORY[1]).alias("name"),
        F.lit(CATEGORY[2]).alias("supercategory"),
    )
    return (
        images.select("label", "id", F.col("name").alias("file_name"), "width", "height"),
        annotations,
        categories,
    )


def write_coco(tables: tuple[DataFrame, DataFrame, DataFrame], path: str, mode: str = "errorifexists") -> None:
    """The three lists as JSON lines, images and annotations in label folders."""
    for name, rows in zip(("images", "annotations", "categories"), tables):
        writer = rows.write.mode(mode)
        (writer.partitionBy("label") if "label" in rows.columns else writer).json(f"{path}/{name}")
