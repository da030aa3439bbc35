"""Keep/reject verdicts: removal reasons, caps, statistics, label pruning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.constants import DEFAULT_REJECT
from corpusmill.operators.catalog import dense_label_map
from corpusmill.operators.vectors import category_summary
from corpusmill.plans.ranking import top_n
from corpusmill.plans.sizing import join_small

KEYS = ("label", "item_id")
REASONS = ("category", "outlier", "duplicate", "mislabel", "small_box")
OVER_CAP = "over_cap"


def verdict(
    items: DataFrame,
    classified: DataFrame | None = None,
    outliers: DataFrame | None = None,
    duplicates: DataFrame | None = None,
    mislabels: DataFrame | None = None,
    small_boxes: DataFrame | None = None,
    reject_categories: Sequence[str] = DEFAULT_REJECT,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Items with ``reasons`` (fixed order) and ``removed``.

    Every signal is optional and reduced to its flagged keys; the flags are
    merged in one aggregation and joined to the items once, on a key with one
    row per item, so no label-sized group forms.
    """
    *group, item = keys
    flagged = []
    if classified is not None:
        flagged.append(("category", classified.filter(F.col("category").isin(*reject_categories))))
    if outliers is not None:
        flagged.append(("outlier", outliers.filter("is_outlier")))
    if duplicates is not None:
        named = duplicates.select(*group, F.col("removed").alias(item))
        flagged.append(("duplicate", named))
    if mislabels is not None:
        flagged.append(("mislabel", mislabels.filter("suspected")))
    if small_boxes is not None:
        flagged.append(("small_box", small_boxes))
    if not flagged:
        return items.withColumns(
            {"reasons": F.array().cast("array<string>"), "removed": F.lit(False)}
        )
    union: DataFrame | None = None
    for reason, rows in flagged:
        part = rows.select(*keys, F.lit(reason).alias("_reason"))
        union = part if union is None else union.unionByName(part)
    flags = union.groupBy(*keys).agg(
        *[F.max(F.col("_reason") == reason).alias(f"_{reason}") for reason in REASONS]
    )
    reasons = F.array_compact(
        F.array(*[F.when(F.col(f"_{reason}"), F.lit(reason)) for reason in REASONS])
    )
    return (
        items.join(flags, list(keys), "left")
        .withColumn("reasons", reasons)
        .withColumn("removed", F.size("reasons") > 0)
        .drop(*[f"_{reason}" for reason in REASONS])
    )


def cap_per_label(
    verdicts: DataFrame,
    n: int,
    score: str = "composite_score",
    sequence: Sequence[str] = (),
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Mark survivors beyond the n best of each label as removed (``over_cap``).

    Only the n-th best row of each label is computed; every row is then
    compared with that cutoff, so labels are never sorted as a whole.
    ``sequence`` names the report order used for ties, before the item id.
    """
    *group, item = keys
    if n <= 0:
        return verdicts
    value = F.coalesce(F.col(score), F.lit(0.0))
    ties = [*sequence, item]
    place = F.struct((-value).alias("_s"), *[F.col(c) for c in ties])
    survivors = verdicts.filter(~F.col("removed")).select(*group, *ties, F.col(score))
    cutoff = (
        top_n(survivors, group, [-value, *[F.col(c) for c in ties]], n)
        .filter(F.col("rn") == n)
        .select(*group, place.alias("_cutoff"))
    )
    over = ~F.col("removed") & F.coalesce(place > F.col("_cutoff"), F.lit(False))
    return (
        join_small(verdicts, cutoff, group, "left")
        .withColumn("_over", over)
        .withColumn(
            "reasons",
            F.when(F.col("_over"), F.array_append("reasons", F.lit(OVER_CAP))).otherwise(F.col("reasons")),
        )
        .withColumn("removed", F.col("removed") | F.col("_over"))
        .drop("_over", "_cutoff")
    )


def partition(verdicts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) tables; nothing is moved or deleted."""
    return verdicts.filter(~F.col("removed")), verdicts.filter("removed")


def verdict_stats(verdicts: DataFrame, group: Sequence[str] = ("label",)) -> DataFrame:
    """Removed and kept items per group and in total (null group columns)."""
    per_group = verdicts.groupBy(*group).agg(
        F.count_if("removed").alias("_removed"), F.count_if(~F.col("removed")).alias("_kept")
    )
    sums = [F.sum("_removed").alias("removed"), F.sum("_kept").alias("kept")]
    total = per_group.agg(*sums).select(
        *[F.lit(None).cast(verdicts.schema[c].dataType).alias(c) for c in group], "removed", "kept"
    )
    return per_group.groupBy(*group).agg(*sums).unionByName(total)


def emptied_labels(
    verdicts: DataFrame,
    label: str = "label",
    split: str | None = None,
    drop_when: str = "any_split",
) -> DataFrame:
    """Labels left without items: in any split (the default) or in all of them."""
    if split is None or drop_when == "all_splits":
        per_label = verdicts.groupBy(label).agg(F.bool_and("removed").alias("_empty"))
    else:
        per_label = (
            verdicts.groupBy(split, label).agg(F.bool_and("removed").alias("_part"))
            .groupBy(label).agg(F.bool_or("_part").alias("_empty"))
        )
    return per_label.filter("_empty").select(label)


def reindex_label_map(label_map: DataFrame, emptied: DataFrame, label: str = "label") -> DataFrame:
    """Drop emptied labels and number the others alphabetically from 0."""
    left = label_map.select(label).join(emptied.select(label), label, "left_anti")
    return dense_label_map(left, label)


def prune_metadata(meta: DataFrame, emptied: DataFrame, label: str = "label") -> DataFrame:
    return meta.join(emptied.select(label), label, "left_anti")


def apply_dataset(
    verdicts: DataFrame,
    label_map: DataFrame,
    meta: DataFrame,
    drop_when: str = "any_split",
    label: str = "label",
    split: str = "split",
) -> dict[str, DataFrame]:
    """Verdict of all splits at once: kept, rejected, stats, label map, metadata."""
    kept, rejected = partition(verdicts)
    emptied = emptied_labels(verdicts, label, split, drop_when)
    return {
        "kept": kept,
        "rejected": rejected,
        "stats": verdict_stats(verdicts, (split, label)),
        "label_map": reindex_label_map(label_map, emptied, label),
        "metadata": prune_metadata(meta, emptied, label),
    }


def quality_report(
    items: DataFrame,
    classified: DataFrame,
    outliers: DataFrame,
    scored: DataFrame | None = None,
    duplicates: DataFrame | None = None,
    done: DataFrame | None = None,
    keys: Sequence[str] = KEYS,
) -> tuple[DataFrame, DataFrame]:
    """Flat report: ``(report items, report summary)`` of labels not yet ``done``.

    Report items carry category, confidence, outlier distance and flag and,
    when ``scored`` is given, the four quality columns.
    """
    *group, _ = keys
    todo = items if done is None else join_small(items, done.select(*group).distinct(), group, "left_anti")
    report = (
        todo.select(*keys)
        .join(classified.select(*keys, "category", "confidence", "scores"), list(keys))
        .join(outliers.select(*keys, "distance", "is_outlier"), list(keys), "left")
    )
    if scored is not None:
        quality = ("detection_score", "bbox_pct", "sharpness", "composite_score")
        report = report.join(scored.select(*keys, *quality), list(keys), "left").withColumns(
            {c: F.coalesce(F.col(c), F.lit(0.0)) for c in quality}
        )
    summary = category_summary(report, group=group)
    flagged = report.groupBy(*group).agg(
        F.count_if(F.coalesce("is_outlier", F.lit(False))).alias("outliers")
    )
    summary = summary.join(flagged, group)
    if duplicates is not None:
        records = duplicates.groupBy(*group).agg(
            F.count(F.lit(1)).alias("duplicates"),
            F.count_distinct("removed").alias("distinct_removed"),
        )
        summary = summary.join(records, group, "left").na.fill(0, ["duplicates", "distinct_removed"])
    return report, summary


def removed_by_reason(verdicts: DataFrame) -> DataFrame:
    """Items per removal reason; an item with two reasons counts for both."""
    return (
        verdicts.select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("items"))
    )

