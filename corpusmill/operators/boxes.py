"""Bounding boxes and annotations.

Detections are ``(label, name, det_idx, x1, y1, x2, y2, score)``; annotations
``(label, name, bbox struct<x,y,w,h>, score, retry_threshold)`` with one row
per annotated item and a null ``bbox`` when nothing was detected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.constants import ANNOTATED_EXTENSIONS
from corpusmill.functions.hashing import shuffle_key
from corpusmill.functions.numeric import half_even, round_to
from corpusmill.functions.text import has_extension
from corpusmill.operators.splits import upsert
from corpusmill.plans.ranking import top_n
from corpusmill.plans.sizing import join_small

KEYS = ("label", "name")
STATUSES = {"accept": "accepted", "correct": "corrected", "reject": "rejected"}


def box_area():
    return F.col("bbox.w") * F.col("bbox.h")


# -- B1, B2 --------------------------------------------------------------------


def clip_boxes(
    detections: DataFrame,
    items: DataFrame,
    min_area_ratio: float = 0.01,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Boxes cut to the image as rounded [x, y, w, h]; empty and tiny ones go.

    The area test uses unrounded values. Ties round to even; scores keep four
    decimals.
    """
    sized = detections.join(items.select(*keys, "width", "height"), list(keys))
    x, y = F.greatest(F.lit(0.0), "x1"), F.greatest(F.lit(0.0), "y1")
    cut = sized.withColumns({"_x": x, "_y": y}).withColumns(
        {
            "_w": F.least("x2", F.col("width").cast("double")) - F.col("_x"),
            "_h": F.least("y2", F.col("height").cast("double")) - F.col("_y"),
        }
    )
    area = F.col("width") * F.col("height")
    tiny = F.coalesce(F.try_divide(F.col("_w") * F.col("_h"), area) < min_area_ratio, F.lit(False))
    box = F.struct(*[half_even(F.col(f"_{c}")).alias(c) for c in "xywh"])
    return cut.filter((F.col("_w") > 0) & (F.col("_h") > 0) & ~tiny).select(
        *keys, "det_idx", box.alias("bbox"), round_to(F.col("score"), 4).alias("score"), "width", "height"
    )


def best_detection(
    clipped: DataFrame,
    items: DataFrame | None = None,
    max_ratio: float = 0.5,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """The main subject of each item: ``(*keys, bbox, score)``.

    The largest box of at most half the image, else the best score; an unknown
    image size leaves the score to decide; ties go to the first detection.
    One aggregation picks it. With ``items``, all their columns are kept and
    items without a detection get a null box.
    """
    area = F.col("width") * F.col("height")
    fits = F.coalesce(F.try_divide(box_area(), area) <= max_ratio, F.lit(False))
    place = F.struct(
        fits.alias("fits"),
        F.when(fits, box_area().cast("double")).otherwise(F.col("score")).alias("by"),
        (-F.col("det_idx")).alias("first"),
    )
    best = clipped.groupBy(*keys).agg(F.max_by(F.struct("bbox", "score"), place).alias("_d"))
    best = best.select(*keys, "_d.bbox", "_d.score")
    return best if items is None else items.join(best, list(keys), "left")


# -- B3 - B6 -------------------------------------------------------------------


def annotation_rollup(annotations: DataFrame, label: str = "label") -> DataFrame:
    """Items, detected items and their percentage per label and in total (null label)."""
    per_label = annotations.groupBy(label).agg(
        F.count(F.lit(1)).alias("_n"), F.count(F.col("bbox")).alias("_d")
    )
    detected, items = F.col("detected"), F.col("items")
    none = F.lit(None).cast(annotations.schema[label].dataType).alias(label)
    total = per_label.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("items"), F.coalesce(F.sum("_d"), F.lit(0)).alias("detected")
    )
    return (
        per_label.select(label, F.col("_n").alias("items"), F.col("_d").alias("detected"))
        .unionByName(total.select(none, "items", "detected"))
        .withColumn("pct", F.when(items > 0, round_to(detected / items * 100, 1)).otherwise(0.0))
    )


def pending(df: DataFrame, done: DataFrame, keys: Sequence[str] = ("label",), force: bool = False) -> DataFrame:
    """Rows whose key is not done yet (all rows with ``force``)."""
    if force:
        return df
    return join_small(df, done.select(*keys).distinct(), keys, "left_anti")


def missing_detections(annotations: DataFrame) -> DataFrame:
    """Annotated items in which nothing was detected."""
    return annotations.filter(F.col("bbox").isNull())


def retry_merge(
    annotations: DataFrame,
    retried: DataFrame,
    threshold: float,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Fill missing detections from a second pass; existing ones are never touched.

    ``retried`` is ``(*keys, bbox, score)`` from the lower threshold. Recovered
    rows carry it in ``retry_threshold``.
    """
    second = retried.filter(F.col("bbox").isNotNull()).select(
        *keys, F.col("bbox").alias("_bbox"), F.col("score").alias("_score")
    )
    known = F.col("bbox").isNotNull()
    recovered = ~known & F.col("_bbox").isNotNull()
    earlier = (
        F.col("retry_threshold") if "retry_threshold" in annotations.columns
        else F.lit(None).cast("double")
    )
    return annotations.join(second, list(keys), "left").select(
        *keys,
        F.coalesce("bbox", "_bbox").alias("bbox"),
        F.when(known, F.col("score")).otherwise(F.col("_score")).alias("score"),
        F.when(recovered, F.lit(float(threshold))).otherwise(earlier).alias("retry_threshold"),
        recovered.alias("recovered"),
    )


def retry_stats(merged: DataFrame) -> DataFrame:
    """One row: retried, recovered, still missing (over the output of retry_merge)."""
    return merged.agg(
        F.count_if(F.col("recovered") | F.col("bbox").isNull()).alias("retried"),
        F.count_if("recovered").alias("recovered"),
        F.count_if(F.col("bbox").isNull()).alias("still_missing"),
    )


# -- B7 - B10 ------------------------------------------------------------------


def review_sample(
    annotations: DataFrame,
    items: DataFrame,
    n_detected: int = 10,
    n_missing: int = 10,
    seed: int = 42,
) -> DataFrame:
    """Per label up to n detected and n missing items, pseudo-random.

    Picks that turn out unreadable are dropped, not replaced.
    """
    marked = annotations.withColumn("missing", F.col("bbox").isNull()).withColumn(
        "_quota", F.when(F.col("missing"), n_missing).otherwise(n_detected)
    )
    order = [shuffle_key(F.col("name"), seed), F.col("name")]
    picks = top_n(marked, ["label", "missing"], order, max(n_detected, n_missing), "_quota")
    readable = items.filter(F.col("width") > 0).select("label", "name")
    return join_small(readable, picks.drop("_quota"), ["label", "name"])


def first_n(
    items: DataFrame,
    n: int = 10,
    group: Sequence[str] = ("label",),
    extensions: Sequence[str] | None = ANNOTATED_EXTENSIONS,
) -> DataFrame:
    """The first n items of each group by name."""
    rows = items if extensions is None else items.filter(has_extension(F.col("name"), extensions))
    return top_n(rows, group, [F.col("name")], n)


def random_labels(df: DataFrame, k: int, seed: int = 42, label: str = "label") -> DataFrame:
    """Rows of k pseudo-random labels."""
    chosen = df.select(label).distinct().orderBy(shuffle_key(F.col(label), seed), label).limit(k)
    return join_small(df, chosen, [label], "left_semi")


def validation_queue(items: DataFrame, validated: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Up to n pseudo-random items per label that nobody validated yet."""
    todo = items.join(validated.select("label", "name"), ["label", "name"], "left_anti")
    return top_n(todo, ["label"], [shuffle_key(F.col("name"), seed), F.col("name")], n)


# -- B11 - B13 -----------------------------------------------------------------


def apply_decisions(validated: DataFrame, decisions: DataFrame) -> DataFrame:
    """Upsert accept / correct / reject decisions; skips write nothing.

    ``decisions`` is ``(label, name, action, bbox, seq)``; the highest ``seq``
    of an item wins. A rejected item has no box.
    """
    status = F.coalesce(*[F.when(F.col("action") == a, F.lit(s)) for a, s in STATUSES.items()])
    incoming = decisions.filter(F.col("action").isin(*STATUSES)).select(
        "label",
        "name",
        F.when(F.col("action") != "reject", F.col("bbox")).alias("bbox"),
        status.alias("status"),
        "seq",
    )
    before = validated.select("label", "name", "bbox", "status").withColumn(
        "seq", F.lit(None).cast(decisions.schema["seq"].dataType)
    )
    return upsert(before, incoming, ["label", "name"], "seq").drop("seq")


def validation_stats(validated: DataFrame) -> DataFrame:
    """One row: validated items, of them corrected and rejected."""
    return validated.agg(
        F.count(F.lit(1)).alias("total_validated"),
        F.count_if(F.col("status") == "corrected").alias("total_corrected"),
        F.count_if(F.col("status") == "rejected").alias("total_rejected"),
    )


def normalise_drag(df: DataFrame, min_side: int = 5) -> DataFrame:
    """Two dragged corners as a rounded box inside the image; small drags go.

    Reads ``x1, y1, x2, y2, width, height`` and adds ``bbox``.
    """
    left = F.greatest(F.lit(0.0), F.least("x1", "x2"))
    top = F.greatest(F.lit(0.0), F.least("y1", "y2"))
    sides = df.withColumns({"_x": left, "_y": top}).withColumns(
        {
            "_w": F.least(F.abs(F.col("x2") - F.col("x1")), F.col("width") - F.col("_x")),
            "_h": F.least(F.abs(F.col("y2") - F.col("y1")), F.col("height") - F.col("_y")),
        }
    )
    box = F.struct(*[half_even(F.col(f"_{c}")).alias(c) for c in "xywh"])
    return (
        sides.filter((F.col("_w") >= min_side) & (F.col("_h") >= min_side))
        .withColumn("bbox", box)
        .drop("_x", "_y", "_w", "_h")
    )


# -- B14, B15 ------------------------------------------------------------------


def annotation_qa(clipped: DataFrame, expected: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per rule: ``rule, value, passed``.

    Rules: at least 70 % of the items with subjects detected, no box above 95 %
    or below 1 % of its image, mean score above 0.6. ``expected`` is
    ``(*keys, width, height, subjects)``.
    """
    ratio = F.try_divide(box_area(), F.col("width") * F.col("height"))
    per_item = clipped.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(ratio > 0.95).alias("_giant"),
        F.count_if(ratio < 0.01).alias("_micro"),
        F.sum("score").alias("_score"),
    )
    positive = F.col("subjects") > 0
    whole = expected.select(*keys, "subjects").join(per_item, list(keys), "left").agg(
        F.try_divide(F.count_if(positive & (F.col("_n") > 0)), F.count_if(positive)).alias("rate"),
        F.coalesce(F.sum("_giant"), F.lit(0)).cast("double").alias("giant"),
        F.coalesce(F.sum("_micro"), F.lit(0)).cast("double").alias("micro"),
        F.try_divide(F.sum("_score"), F.sum("_n")).alias("mean"),
    )
    rules = (
        ("detection_rate", "rate", F.col("rate") >= 0.70),
        ("giant_boxes", "giant", F.col("giant") == 0),
        ("micro_boxes", "micro", F.col("micro") == 0),
        ("mean_score", "mean", F.col("mean") > 0.6),
    )
    rows = F.array(
        *[F.struct(F.lit(name).alias("rule"), round_to(F.col(c), 4).alias("value"),
                   F.coalesce(ok, F.lit(False)).alias("passed")) for name, c, ok in rules]
    )
    return whole.select(F.explode(rows).alias("_r")).select("_r.*")


def small_boxes(
    annotations: DataFrame, items: DataFrame, min_pct: float = 5.0, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Keys of items whose box covers strictly less than ``min_pct`` of the image.

    Items without a detection and unreadable images are never flagged.
    """
    sized = annotations.filter(F.col("bbox").isNotNull()).select(*keys, "bbox").join(
        items.select(*keys, "width", "height"), list(keys)
    )
    area = F.col("width") * F.col("height")
    return sized.filter(F.try_divide(box_area(), area) * 100 < min_pct).select(*keys)
