"""Scanning item folders ``{root}/{split}/{label}/{file}``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.constants import SCORED_EXTENSIONS, SPLITS
from corpusmill.functions.text import has_extension
from corpusmill.sources.headers import size_columns


def _decoded(path: Column) -> Column:
    plain = F.try_url_decode(F.regexp_replace(path, r"\+", "%2B"))
    return F.coalesce(plain, path)


def path_columns(path: Column, with_split: bool = True) -> dict[str, Column]:
    """split, label and name from the last parts of a path."""
    parts = F.split(_decoded(path), "/")
    columns = {"label": F.element_at(parts, -2), "name": F.element_at(parts, -1), "path": path}
    return {"split": F.element_at(parts, -3), **columns} if with_split else columns


def _filtered(rows: DataFrame, splits: Sequence[str] | None, extensions: Sequence[str]) -> DataFrame:
    kept = rows.filter(has_extension(F.col("name"), extensions))
    return kept if splits is None else kept.filter(F.col("split").isin(*splits))


def scan_items(
    spark: SparkSession,
    root: str,
    splits: Sequence[str] | None = SPLITS,
    extensions: Sequence[str] = SCORED_EXTENSIONS,
    with_split: bool = True,
) -> DataFrame:
    """Items by file listing; no file is opened.

    ``with_split=False`` reads ``{root}/{label}/{file}`` (staged corpora).
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    )
    rows = files.select(*[c.alias(k) for k, c in path_columns(F.col("path"), with_split).items()])
    return _filtered(rows, splits if with_split else None, extensions)


def probe_items(
    spark: SparkSession,
    root: str,
    splits: Sequence[str] | None = SPLITS,
    extensions: Sequence[str] = SCORED_EXTENSIONS,
    with_split: bool = True,
    keep_pixels: bool = False,
) -> DataFrame:
    """Items with width and height; unreadable ones have 0 x 0.

    Sizes come from the headers of the files. ``keep_pixels`` decodes them and
    keeps the ``image`` struct; formats that the JVM cannot decode (WebP) then count as unreadable.
    Spark's readers pass over empty files, so they are no items.
    """
    if not keep_pixels:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        rows = files.select(
            *[c.alias(k) for k, c in path_columns(F.col("path"), with_split).items()], "content", "length"
        )
        kept = _filtered(rows, splits if with_split else None, extensions)
        return kept.withColumns(size_columns(F.col("content"), F.col("length"))).drop("content", "length")
    images = (
        spark.read.format("image").option("dropInvalid", False)
        .option("recursiveFileLookup", True).load(root)
    )
    columns = path_columns(F.col("image.origin"), with_split)
    size = {c: F.greatest(F.col(f"image.{c}"), F.lit(0)) for c in ("width", "height")}
    rows = images.select(
        *[c.alias(k) for k, c in {**columns, **size}.items()], "image"
    )
    return _filtered(rows, splits if with_split else None, extensions)
