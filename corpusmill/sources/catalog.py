"""Observation catalogue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "taxa": "taxon_id bigint, name string, rank string, ancestry string, active boolean",
    "observations": "observation_uuid string, taxon_id bigint, latitude double, longitude double, "
    "quality_grade string, observer_id bigint, observed_on date",
    "photos": "photo_id bigint, observation_uuid string, extension string, position int, "
    "width int, height int",
}


def read_catalog(
    spark: SparkSession, path: str, fmt: str = "parquet", **options: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(taxa, observations, photos) from ``{path}/{table}`` as parquet, csv, json or orc."""
    reader = spark.read.format(fmt).options(**options)
    return tuple(reader.schema(schema).load(f"{path}/{name}") for name, schema in SCHEMAS.items())


def read_catalog_jdbc(
    spark: SparkSession, url: str, partitions: int, photo_ids: tuple[int, int], **options: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same tables from a database; photos are read in ``photo_id`` ranges."""
    base = spark.read.format("jdbc").options(url=url, **options)
    low, high = photo_ids
    photos = base.options(
        dbtable="photos", partitionColumn="photo_id", lowerBound=str(low),
        upperBound=str(high), numPartitions=str(partitions),
    ).load()
    base = spark.read.format("jdbc").options(url=url, **options)
    return base.option("dbtable", "taxa").load(), base.option("dbtable", "observations").load(), photos
