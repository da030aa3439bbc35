"""Annotation files: one JSON object ``name -> {bbox, score} | null`` per label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.plans.sizing import join_small
from corpusmill.sources.corpus import path_columns

ENTRY = "map<string,struct<bbox:array<double>,score:double,retry_threshold:double>>"
ENTRIES_PER_OBJECT = 20_000


def _rows(objects: DataFrame, keys: Sequence[str]) -> DataFrame:
    entries = objects.select(*keys, F.explode(F.from_json("value", ENTRY)).alias("name", "_e"))
    box = F.struct(*[F.col("_e.bbox")[i].alias(c) for i, c in enumerate("xywh")])
    return entries.select(
        *keys,
        "name",
        F.when(F.col("_e.bbox").isNotNull(), box).alias("bbox"),
        F.col("_e.score").alias("score"),
        F.col("_e.retry_threshold").alias("retry_threshold"),
    )


def read_annotations(
    spark: SparkSession, root: str, with_split: bool = True, file_name: str = "annotations.json"
) -> DataFrame:
    """Rows of every annotation file below ``root``; no file means no rows.

    A null entry (nothing detected) becomes a row with a null ``bbox``.
    """
    files = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", file_name)
        .text(root, wholetext=True)
        .select("value", F.col("_metadata.file_path").alias("_file"))
    )
    columns = path_columns(F.col("_file"), with_split)
    keys = ["split", "label"] if with_split else ["label"]
    return _rows(files.select("value", *[columns[k].alias(k) for k in keys]), keys)


def write_annotations(
    annotations: DataFrame,
    path: str,
    keys: Sequence[str] = ("split", "label"),
    per_object: int = ENTRIES_PER_OBJECT,
    mode: str = "errorifexists",
) -> None:
    """JSON objects under ``key=value`` folders, the last key being ``part``.

    Every label is cut into parts of about ``per_object`` entries, a small one
    into part 0 alone, so the layout is the same at every size and no task
    gathers a whole label.
    """
    keys = list(keys)
    shards = annotations.groupBy(*keys).agg(
        F.ceil(F.count(F.lit(1)) / per_object).cast("int").alias("_shards")
    )
    box = F.array(*[F.col(f"bbox.{c}") for c in "xywh"])
    retry = F.col("retry_threshold") if "retry_threshold" in annotations.columns else F.lit(None)
    entry = F.when(
        F.col("bbox").isNotNull(),
        F.struct(box.alias("bbox"), F.col("score"), retry.cast("double").alias("retry_threshold")),
    )
    objects = (
        join_small(annotations, shards, keys)
        .withColumn("part", F.pmod(F.xxhash64("name"), F.col("_shards")))
        .groupBy(*keys, "part")
        .agg(F.map_from_entries(F.collect_list(F.struct(F.col("name"), entry.alias("e")))).alias("_m"))
    )
    rows = objects.select(*keys, "part", F.to_json("_m", {"ignoreNullFields": "false"}).alias("value"))
    rows.write.mode(mode).partitionBy(*keys, "part").text(path)


def read_written_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Rows of what :func:`write_annotations` wrote, keys from the folder names."""
    objects = spark.read.text(path)
    return _rows(objects, [c for c in objects.columns if c not in ("value", "part")])


def write_missing(annotations: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``label/name`` lines of the items in which nothing was detected."""
    missing = annotations.filter(F.col("bbox").isNull())
    missing.select(F.concat_ws("/", "label", "name").alias("value")).write.mode(mode).text(path)
