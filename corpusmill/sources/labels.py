"""Label maps and label metadata: JSON objects keyed by label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.sources.documents import write_document

META_FIELDS = ("scientific_name", "family", "english_name", "french_name")


def _document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", schema)).alias("label", "_v"))


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    return _document(spark, path, "map<string,int>").select("label", F.col("_v").alias("idx"))


def write_label_map(label_map: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_document(label_map.select("label", "idx"), F.col("idx"), path, mode)


def read_label_metadata(spark: SparkSession, path: str) -> DataFrame:
    fields = ",".join(f"{c}:string" for c in ("slug", *META_FIELDS))
    return _document(spark, path, f"map<string,struct<{fields}>>").select(
        "label", *[F.col(f"_v.{c}").alias(c) for c in META_FIELDS]
    )


def write_label_metadata(meta: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rows = meta.select("label", *META_FIELDS)
    value = F.struct(F.col("label").alias("slug"), *META_FIELDS)
    write_document(rows, value, path, mode)
