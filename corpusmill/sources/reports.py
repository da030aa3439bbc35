"""Quality reports: flat tables first, nested JSON objects for exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from corpusmill.plans.sizing import join_small

QUALITY = ("detection_score", "bbox_pct", "sharpness", "composite_score")
_QUALITY = ",".join(f"{c}:double" for c in QUALITY)
NESTED = (
    "summary map<string,bigint>, "
    "images map<string,struct<category:string,confidence:double,scores:map<string,double>,"
    f"quality:struct<{_QUALITY}>>>, "
    "outliers map<string,struct<distance:double,is_outlier:boolean>>, "
    "duplicates array<struct<kept:string,removed:string,similarity:double>>"
)
ENTRIES_PER_OBJECT = 20_000


def write_report(
    path: str, items: DataFrame, summary: DataFrame, duplicates: DataFrame | None = None, mode: str = "errorifexists"
) -> None:
    """The flat report: items, summary and duplicates as Parquet tables."""
    items.write.mode(mode).parquet(f"{path}/items")
    summary.write.mode(mode).parquet(f"{path}/summary")
    if duplicates is not None:
        duplicates.write.mode(mode).parquet(f"{path}/duplicates")


def read_report(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The flat report; a report without duplicates has an empty table of them."""
    found = {name: spark.read.parquet(f"{path}/{name}") for name in ("items", "summary")}
    try:
        found["duplicates"] = spark.read.parquet(f"{path}/duplicates")
    except AnalysisException:
        found["duplicates"] = spark.createDataFrame(
            [], "label string, kept string, removed string, similarity double"
        )
    return {**found, "items": with_quality(found["items"])}


def with_quality(items: DataFrame) -> DataFrame:
    """Quality columns of older reports, which lack them, read as 0."""
    missing = {c: F.lit(0.0) for c in QUALITY if c not in items.columns}
    filled = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in QUALITY if c in items.columns}
    return items.withColumns({**missing, **filled})


def nested_report(
    items: DataFrame,
    summary: DataFrame,
    duplicates: DataFrame | None = None,
    per_object: int = ENTRIES_PER_OBJECT,
) -> DataFrame:
    """``(label, part, summary, images, outliers, duplicates)`` objects.

    Every label is cut into parts of about ``per_object`` items, a small one
    into part 0 alone; each part carries the label's summary. The layout is the
    same at every size.
    """
    sizes = summary.select("label", F.ceil(F.col("total") / per_object).cast("int").alias("_parts"))
    counts = [c for c in summary.columns if c != "label"]
    keyed = join_small(items, sizes, ["label"]).withColumn(
        "part", F.pmod(F.xxhash64("item_id"), F.greatest("_parts", F.lit(1))).cast("int")
    )
    name = F.col("item_id").cast("string").alias("name")
    image = F.struct("category", "confidence", "scores", F.struct(*QUALITY).alias("quality"))
    outlier = F.struct("distance", "is_outlier")
    objects = keyed.groupBy("label", "part").agg(
        F.map_from_entries(F.collect_list(F.struct(name, image.alias("v")))).alias("images"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("distance").isNotNull(), F.struct(name, outlier.alias("v"))))
        ).alias("outliers"),
    )
    numbers = F.map_from_arrays(
        F.array(*[F.lit(c) for c in counts]), F.array(*[F.col(c).cast("bigint") for c in counts])
    )
    whole = join_small(objects, summary.select("label", numbers.alias("summary")), ["label"])
    if duplicates is None:
        return whole
    records = (
        join_small(duplicates, sizes, ["label"])
        .withColumn("part", F.pmod(F.xxhash64("removed"), F.greatest("_parts", F.lit(1))).cast("int"))
        .groupBy("label", "part")
        .agg(F.collect_list(F.struct(F.col("kept").cast("string").alias("kept"),
                                     F.col("removed").cast("string").alias("removed"),
                                     "similarity")).alias("duplicates"))
    )
    return whole.join(records, ["label", "part"], "left")


def read_nested_report(spark: SparkSession, path: str, lines: bool = True) -> dict[str, DataFrame]:
    """Flat tables from nested objects; absent keys are tolerated.

    ``lines=True`` reads one object per line with its ``label``; otherwise each
    file is one object and its name is the label.
    """
    if lines:
        objects = spark.read.schema(f"label string, {NESTED}").json(path)
    else:
        label = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)
        objects = spark.read.schema(NESTED).option("multiLine", True).json(path).select(
            label.alias("label"), "*"
        )
    images = objects.select("label", F.explode("images").alias("item_id", "_i"))
    outliers = objects.select("label", F.explode("outliers").alias("item_id", "_o"))
    items = images.join(outliers, ["label", "item_id"], "left").select(
        "label", "item_id", "_i.category", "_i.confidence", "_i.scores",
        *[F.coalesce(F.col(f"_i.quality.{c}"), F.lit(0.0)).alias(c) for c in QUALITY],
        "_o.distance", F.coalesce("_o.is_outlier", F.lit(False)).alias("is_outlier"),
    )
    return {
        "items": items,
        "duplicates": objects.select("label", F.inline("duplicates")),
        "summary": objects.select("label", "summary").groupBy("label").agg(F.first("summary").alias("summary")),
    }
