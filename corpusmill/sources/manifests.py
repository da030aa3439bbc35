"""Transfer manifests: one row per label with its photo list."""

from __future__ import annotations

import datetime
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.sources.documents import write_document

PHOTOS = "array<struct<source:string,photo_id:bigint,extension:string>>"
ROW = (
    "label string, existing bigint, needed bigint, found_primary bigint, found_fallback bigint, "
    f"photos {PHOTOS}"
)
DOCUMENT = (
    "struct<created:string,target:int,species:map<string,struct<scientific_name:string,existing:bigint,"
    "needed:bigint,found_europe:bigint,found_worldwide:bigint,"
    "photos:array<struct<photo_id:bigint,extension:string,source:string>>>>>"
)
COLUMNS = ("label", "existing", "needed", "found_primary", "found_fallback", "photos")


def write_manifest(manifest: DataFrame, path: str, target: int, mode: str = "errorifexists") -> None:
    """JSON lines, one per label, stamped with the target and the creation time."""
    manifest.select(
        *COLUMNS, F.lit(target).alias("target"), F.current_timestamp().alias("created")
    ).write.mode(mode).json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{ROW}, target int, created timestamp").json(path)


def read_manifest_document(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a manifest kept as one nested JSON object."""
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", DOCUMENT).alias("d"))
    rows = text.select("d.target", F.explode("d.species").alias("label", "s"))
    photos = F.transform("s.photos", lambda p: F.struct(p["source"], p["photo_id"], p["extension"]))
    return rows.select(
        "label", "s.scientific_name", "s.existing", "s.needed",
        F.col("s.found_europe").alias("found_primary"),
        F.col("s.found_worldwide").alias("found_fallback"),
        photos.cast(PHOTOS).alias("photos"), "target",
    )


def write_manifest_document(manifest: DataFrame, path: str, target: int, mode: str = "errorifexists") -> None:
    """The manifest as one nested JSON object, which :func:`read_manifest_document` reads."""
    name = F.col("scientific_name") if "scientific_name" in manifest.columns else F.lit(None).cast("string")
    photos = F.transform("photos", lambda p: F.struct(p["photo_id"], p["extension"], p["source"]))
    value = F.struct(
        name.alias("scientific_name"), "existing", "needed", F.col("found_primary").alias("found_europe"),
        F.col("found_fallback").alias("found_worldwide"), photos.alias("photos"),
    )
    created = datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds")
    head = json.dumps({"created": created, "target": target})[:-1] + ', "species": {'
    write_document(manifest, value, path, mode, head, "}}")


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to ``path`` came to its end."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def plan_or_resume(spark: SparkSession, path: str, plan: Callable[[], DataFrame], target: int) -> DataFrame:
    """The manifest at ``path`` if one was written to its end, else a new plan, written first."""
    if not finished(spark, path):
        write_manifest(plan(), path, target, "overwrite")
    return read_manifest(spark, path)
