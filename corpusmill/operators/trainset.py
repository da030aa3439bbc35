"""Training-set preparation: samples, label maps, class balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.hashing import key_int, shuffle_key
from corpusmill.operators.catalog import dense_label_map
from corpusmill.plans.ranking import hash_rank
from corpusmill.plans.sizing import join_small, small_table


def samples(
    items: DataFrame,
    label_map: DataFrame,
    annotations: DataFrame,
    keys: Sequence[str] = ("label", "name"),
) -> DataFrame:
    """Items of known labels with the label index and the box, if annotated."""
    known = join_small(items, label_map.select("label", "idx"), ["label"])
    return known.join(annotations.select(*keys, "bbox"), list(keys), "left").withColumnRenamed(
        "idx", "label_idx"
    )


def unknown_labels(items: DataFrame, label_map: DataFrame) -> DataFrame:
    """Labels of items that the label map does not hold, with their item count."""
    counts = items.groupBy("label").agg(F.count(F.lit(1)).alias("items"))
    return counts.join(label_map.select("label"), "label", "left_anti")


def validate_label_map(label_map: DataFrame) -> DataFrame:
    """One row: size, distinct indices, range, and whether 0..n-1 is covered once."""
    return label_map.agg(
        F.count(F.lit(1)).alias("labels"),
        F.count_distinct("idx").alias("distinct_indices"),
        F.min("idx").alias("min_index"),
        F.max("idx").alias("max_index"),
    ).withColumn(
        "valid",
        (F.col("labels") > 0)
        & (F.col("distinct_indices") == F.col("labels"))
        & (F.col("min_index") == 0)
        & (F.col("max_index") == F.col("labels") - 1),
    )


def label_map_problems(label_map: DataFrame) -> DataFrame:
    """``(idx, problem)`` rows: ``duplicate`` indices and ``missing`` ones in 0..n-1."""
    counts = label_map.groupBy(F.col("idx").cast("bigint").alias("idx")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    repeated = counts.filter("_n > 1").select("idx", F.lit("duplicate").alias("problem"))
    expected = label_map.sparkSession.range(label_map.count()).withColumnRenamed("id", "idx")
    missing = expected.join(counts, "idx", "left_anti").withColumn("problem", F.lit("missing"))
    return repeated.unionByName(missing)


def class_weights(samples_df: DataFrame, label_map: DataFrame) -> DataFrame:
    """1/count per label of the map, 0 for labels without samples."""
    counts = samples_df.groupBy("label").agg(F.count(F.lit(1)).alias("items"))
    return label_map.join(counts, "label", "left").select(
        "label",
        "idx",
        F.coalesce("items", F.lit(0)).alias("items"),
        F.coalesce(1 / F.col("items"), F.lit(0.0)).alias("weight"),
    )


def balanced_resample(
    samples_df: DataFrame,
    draws: DataFrame | None = None,
    seed: int = 42,
    label: str = "label",
    item: str = "item_id",
) -> DataFrame:
    """Draws with replacement, weighted by 1/count of the class.

    Such a weight means: a class uniformly, then one of its items uniformly.
    Each draw hashes to a class number and a rank and finds its item by an equi
    join on both. ``draws`` has one ``draw_id`` per draw; by default there are
    as many draws as samples.
    """
    if draws is None:
        draws = samples_df.select(F.col(item).alias("draw_id"))
    ranked = hash_rank(samples_df, [label], item, seed, "_rank", "_size")
    sizes, _ = small_table(samples_df.groupBy(label).agg(F.count(F.lit(1)).alias("_size")))
    classes = dense_label_map(sizes, label).join(sizes, label)
    n_classes = max(1, classes.count())
    key = shuffle_key(F.concat(F.lit("draw:"), F.col("draw_id").cast("string")), seed)
    placed = draws.select("draw_id", key.alias("_key")).select(
        "draw_id",
        F.pmod(key_int(F.col("_key")), F.lit(n_classes)).cast("int").alias("idx"),
        key_int(F.col("_key"), 9, 15).alias("_h"),
    )
    asked = join_small(placed, classes, ["idx"]).select(
        "draw_id", label, (F.pmod("_h", "_size") + 1).alias("_rank")
    )
    return asked.join(ranked.drop("_size"), [label, "_rank"]).drop("_rank")


def calibration_sample(
    samples_df: DataFrame, n: int = 200, seed: int = 42, item: str = "item_id"
) -> DataFrame:
    """At most n pseudo-random samples of the whole set."""
    return samples_df.orderBy(shuffle_key(F.col(item), seed), item).limit(n)


def coverage(items: DataFrame, label_map: DataFrame) -> DataFrame:
    """Per split: items, labels with items, labels in the map."""
    known = join_small(items, label_map.select("label"), ["label"])
    per_label = known.groupBy("split", "label").agg(F.count(F.lit(1)).alias("_n"))
    n_labels = label_map.agg(F.count(F.lit(1)).alias("labels_in_map"))
    return per_label.groupBy("split").agg(
        F.sum("_n").alias("items"), F.count(F.lit(1)).alias("labels_with_items")
    ).withColumn("labels_in_map", n_labels.scalar())


def corrupt_accounting(items: DataFrame, group: Sequence[str] = ("label",)) -> DataFrame:
    """Readable and unreadable (width <= 0) items per group."""
    broken = F.coalesce(F.col("width") <= 0, F.lit(True))
    return items.groupBy(*group).agg(
        F.count_if(~broken).alias("readable"), F.count_if(broken).alias("corrupted")
    )


def readable(items: DataFrame) -> DataFrame:
    return items.filter(F.col("width") > 0)
