"""Photographic quality: crop sharpness and the composite score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.constants import BBOX_PCT_NORMALIZER, QUALITY_WEIGHTS, SHARPNESS_NORMALIZER
from corpusmill.functions.numeric import round_to

STACK_PIXELS = 1 << 21
COLUMNS = ("detection_score", "bbox_pct", "sharpness", "composite_score")


def laplacian_variances(gray: np.ndarray) -> np.ndarray:
    """Population variance of the 4-neighbour Laplacian of each image of a stack, mirrored borders."""
    padded = np.pad(gray.astype(np.float64), ((0, 0), (1, 1), (1, 1)), mode="reflect")
    centre = padded[:, 1:-1, 1:-1]
    response = (
        padded[:, :-2, 1:-1] + padded[:, 2:, 1:-1] + padded[:, 1:-1, :-2] + padded[:, 1:-1, 2:] - 4 * centre
    )
    return response.var(axis=(1, 2))


def laplacian_variance(gray: np.ndarray) -> float:
    return float(laplacian_variances(gray[None])[0])


def _crop(data: bytes, width: int, height: int, channels: int, box: Sequence[float]) -> np.ndarray | None:
    """The pixels of the box inside BGR bytes; None for an empty crop."""
    x, y, w, h = box
    x1, y1 = max(0, int(x)), max(0, int(y))
    x2, y2 = min(width, int(x + w)), min(height, int(y + h))
    if x2 <= x1 or y2 <= y1:
        return None
    return np.frombuffer(data, np.uint8).reshape(height, width, channels)[y1:y2, x1:x2]


def _gray(stack: np.ndarray) -> np.ndarray:
    """Gray values of a stack of crops (image, row, column, channel)."""
    if stack.shape[3] == 1:
        return stack[..., 0]
    blue, green, red = (stack[..., i].astype(np.float64) for i in range(3))
    return np.rint(0.299 * red + 0.587 * green + 0.114 * blue)


def crop_variance(data: bytes, width: int, height: int, channels: int, box: Sequence[float]) -> float:
    """Sharpness of the box inside BGR bytes; 0 for an empty crop."""
    crop = _crop(data, width, height, channels, box)
    return 0.0 if crop is None else laplacian_variance(_gray(crop[None])[0])


def crop_variances(images: pd.DataFrame, boxes: pd.DataFrame) -> np.ndarray:
    """Sharpness of every row: crops of one shape are one stack, of at most ``STACK_PIXELS`` pixels."""
    out = np.zeros(len(images))
    usable = (images["width"].fillna(0) > 0).to_numpy() & boxes.notna().all(axis=1).to_numpy()
    shapes: dict[tuple[int, ...], list[tuple[int, np.ndarray]]] = {}

    def measure(shape: tuple[int, ...]) -> None:
        at, crops = zip(*shapes.pop(shape), strict=True)
        out[list(at)] = laplacian_variances(_gray(np.stack(crops)))

    fields = zip(
        *(images[c] for c in ("data", "width", "height", "nChannels")),
        boxes[list("xywh")].to_numpy(float),
        usable,
        strict=True,
    )
    for row, (data, width, height, channels, box, good) in enumerate(fields):
        crop = _crop(data, int(width), int(height), int(channels), box) if good else None
        if crop is not None:
            shapes.setdefault(crop.shape, []).append((row, crop))
            if len(shapes[crop.shape]) * crop[..., 0].size >= STACK_PIXELS:
                measure(crop.shape)
    for shape in list(shapes):
        measure(shape)
    return out


@F.pandas_udf(T.DoubleType())
def _sharpness(images: pd.DataFrame, boxes: pd.DataFrame) -> pd.Series:
    return pd.Series(crop_variances(images, boxes), dtype="float64")


def crop_sharpness(image: str = "image", bbox: str = "bbox") -> Column:
    """Sharpness of the annotated crop of Spark ``image`` rows.

    Images are large: keep ``spark.sql.execution.arrow.maxRecordsPerBatch``
    small (tens) for this step.
    """
    fields = F.struct(*[F.col(f"{image}.{c}").alias(c) for c in ("height", "width", "nChannels", "data")])
    return _sharpness(fields, F.struct(*[F.col(f"{bbox}.{c}").cast("double").alias(c) for c in "xywh"]))


def composite_score(df: DataFrame, weights: Mapping[str, float] = QUALITY_WEIGHTS) -> DataFrame:
    """Add the four quality columns from ``bbox, score, width, height, sharpness``.

    A null box or an unreadable image scores 0 throughout; a missing detection
    score counts as 0. The composite uses unrounded values.
    """
    usable = F.col("bbox").isNotNull() & F.coalesce(F.col("width") > 0, F.lit(False))
    detection = F.coalesce(F.col("score"), F.lit(0.0)).cast("double")
    area = F.col("width") * F.col("height")
    pct = F.coalesce(F.try_divide(F.col("bbox.w") * F.col("bbox.h"), area) * 100, F.lit(0.0))
    sharp = F.coalesce(F.col("sharpness"), F.lit(0.0)).cast("double")
    composite = (
        F.lit(float(weights["detection_score"])) * F.least(detection, F.lit(1.0))
        + F.lit(float(weights["bbox_pct"])) * F.least(pct / BBOX_PCT_NORMALIZER, F.lit(1.0))
        + F.lit(float(weights["sharpness"])) * F.least(sharp / SHARPNESS_NORMALIZER, F.lit(1.0))
    )
    values = {
        "detection_score": round_to(detection, 4),
        "bbox_pct": round_to(pct, 4),
        "composite_score": round_to(composite, 4),
        "sharpness": round_to(sharp, 2),
    }
    return df.withColumns({c: F.when(usable, v).otherwise(0.0) for c, v in values.items()})


def score_items(
    items: DataFrame,
    annotations: DataFrame,
    weights: Mapping[str, float] = QUALITY_WEIGHTS,
    keys: Sequence[str] = ("label", "name"),
) -> DataFrame:
    """Quality of every item, annotated or not.

    ``items`` carries either a ``sharpness`` column or a Spark ``image`` struct.
    """
    joined = items.join(annotations.select(*keys, "bbox", "score"), list(keys), "left")
    if "sharpness" not in items.columns:
        joined = joined.withColumn("sharpness", crop_sharpness())
    kept = [c for c in items.columns if c not in COLUMNS and c != "image"]
    return composite_score(joined, weights).select(*kept, *COLUMNS)
