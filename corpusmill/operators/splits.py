"""Stratified splits, split reports and corpus merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusmill.functions.constants import SPLITS
from corpusmill.functions.numeric import half_even, round_to
from corpusmill.plans.ranking import hash_rank

TRAIN, VALIDATION, TEST = SPLITS


def _cuts(n: Column, train: float, val: float) -> tuple[Column, Column]:
    """Validation and test sizes shared by the ``dataset`` and ``merge`` rules."""
    n_val = F.greatest(F.lit(1), half_even(n * F.lit(float(val))))
    n_test = F.greatest(F.lit(1), half_even(n * F.lit(1 - train - val)))
    short = n - n_val - n_test < 1
    small_val = F.greatest(F.lit(1), F.floor((n - 1) / 2))
    small_test = F.greatest(F.lit(1), n - 1 - small_val)
    return (
        F.when(short, small_val).otherwise(n_val),
        F.when(short, small_test).otherwise(n_test),
    )


def split_of(rank: Column, n: Column, rule: str, train: float = 0.8, val: float = 0.1) -> Column:
    """Split name of the rank-th (from 1) of n shuffled items under a rule."""
    if rule == "dataset":
        n_val, n_test = _cuts(n, train, val)
        return (
            F.when(rank <= n_val, VALIDATION)
            .when(rank <= n_val + n_test, TEST)
            .otherwise(TRAIN)
        )
    if rule == "merge":
        n_val, n_test = _cuts(n, train, val)
        n_train = F.when(n <= 2, F.lit(1)).otherwise(n - n_val - n_test)
        return (
            F.when(rank <= n_train, TRAIN)
            .when(rank <= n_train + n_val, VALIDATION)
            .otherwise(TEST)
        )
    if rule == "samples":
        n_train = F.greatest(F.lit(1), half_even(n * F.lit(float(train))))
        n_val = F.greatest(
            F.when(n < 2, F.lit(0)).otherwise(F.lit(1)), half_even(n * F.lit(float(val)))
        )
        n_val = F.when(n_train + n_val > n, F.greatest(F.lit(0), n - n_train)).otherwise(n_val)
        return (
            F.when(rank <= n_train, TRAIN)
            .when(rank <= n_train + n_val, VALIDATION)
            .otherwise(TEST)
        )
    raise ValueError(f"unknown rule {rule!r}")


def assign_splits(
    items: DataFrame,
    rule: str = "dataset",
    train: float = 0.8,
    val: float = 0.1,
    seed: int = 42,
    group: Sequence[str] = ("label",),
    item: str = "item_id",
) -> DataFrame:
    """Items with a ``split`` column, stratified per group and stable per seed."""
    ranked = hash_rank(items.drop("split"), group, item, seed, "_rn", "_n")
    return ranked.withColumn(
        "split", split_of(F.col("_rn"), F.col("_n"), rule, train, val)
    ).drop("_rn", "_n")


def existing_splits(items: DataFrame) -> DataFrame:
    """Validation and test splits that hold items already."""
    return items.filter(F.col("split").isin(VALIDATION, TEST)).select("split").distinct()


def assert_unsplit(items: DataFrame) -> DataFrame:
    """The items themselves; an error when a validation or test split exists."""
    if not existing_splits(items).isEmpty():
        raise FileExistsError("the corpus is split already")
    return items


def split_report(items: DataFrame) -> DataFrame:
    """Items and percentage (whole number) per split."""
    whole = W.partitionBy(F.lit(0))
    counts = items.groupBy("split").agg(F.count(F.lit(1)).alias("items"))
    return counts.withColumn(
        "pct", round_to(F.col("items") * 100 / F.sum("items").over(whole), 0)
    )


def split_sizes(items: DataFrame, group: Sequence[str] = ("label",)) -> DataFrame:
    """Per group: total and one count per split (the dry-run statistics)."""
    return items.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("split") == s).alias(s) for s in SPLITS],
    )


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Union in which the incoming row replaces an existing one of the same key.

    Among incoming rows of one key the highest ``order`` wins, then the largest
    row. A hash aggregation on the key, so nothing is sorted per label.
    """
    columns = existing.columns
    rest = [c for c in columns if c not in keys]
    rank = F.col(order) if order else F.lit(0)
    both = existing.select(
        *columns, F.struct(F.lit(0).alias("s"), rank.alias("o")).alias("_at")
    ).unionByName(
        incoming.select(*columns, F.struct(F.lit(1).alias("s"), rank.alias("o")).alias("_at"))
    )
    if not rest:
        return both.select(*keys).distinct()
    picked = both.groupBy(*keys).agg(F.max(F.struct("_at", *rest)).alias("_row"))
    return picked.select(*keys, "_row.*").drop("_at").select(*columns)


def merge_corpus(
    corpus: DataFrame,
    corpus_annotations: DataFrame,
    staged: DataFrame,
    staged_annotations: DataFrame,
    train: float = 0.8,
    val: float = 0.1,
    seed: int = 42,
    item: str = "name",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Give staged items a split and merge them: (items, annotations, statistics).

    Items are ``(split, label, name)`` plus columns, annotations
    ``(split, label, name, ...)``; staged tables have no split. An incoming
    annotation overrides the existing one of the same split, label and name.
    """
    placed = assign_splits(staged, "merge", train, val, seed, ("label",), item)
    return _merge_placed(corpus, corpus_annotations, placed, staged_annotations, item)


def merge_rejected(
    rejected: DataFrame,
    rejected_annotations: DataFrame,
    staged: DataFrame,
    staged_annotations: DataFrame,
    item: str = "name",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged rejects all go to the train split of the rejected corpus."""
    placed = staged.withColumn("split", F.lit(TRAIN))
    return _merge_placed(rejected, rejected_annotations, placed, staged_annotations, item)


def _merge_placed(corpus, annotations, placed, staged_annotations, item):
    keys = ["split", "label", item]
    incoming = placed.select(*keys).join(staged_annotations, ["label", item])
    return (
        upsert(corpus, placed.select(*corpus.columns), keys),
        upsert(annotations, incoming.select(*annotations.columns), keys),
        split_sizes(placed),
    )


def empty_labels(labels: DataFrame, staged: DataFrame, label: str = "label") -> DataFrame:
    """Labels without a staged item left."""
    return labels.select(label).distinct().join(staged.select(label), label, "left_anti")


def labels_with_items(staged: DataFrame, label: str = "label") -> DataFrame:
    return staged.groupBy(label).agg(F.count(F.lit(1)).alias("items"))


def split_overlaps(items: DataFrame, keys: Sequence[str] = ("label", "item_id")) -> DataFrame:
    """Items that appear in more than one split (must be empty)."""
    return (
        items.groupBy(*keys)
        .agg(F.min("split").alias("_lo"), F.max("split").alias("_hi"))
        .filter(F.col("_lo") != F.col("_hi"))
        .select(*keys)
    )


def lost_items(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("label", "item_id")) -> DataFrame:
    """Items present before and missing after (must be empty)."""
    return before.select(*keys).join(after.select(*keys), list(keys), "left_anti")

