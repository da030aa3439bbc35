"""Calibration against human labels: sampling, metrics, threshold sweep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.constants import BORDERLINE_CENTER, DEFAULT_THRESHOLD, SWEEP_THRESHOLDS
from corpusmill.functions.hashing import shuffle_key
from corpusmill.functions.numeric import f1_score, ratio, round_to
from corpusmill.plans.ranking import range_rank, top_n
from corpusmill.plans.running import running
from corpusmill.plans.sizing import join_small

KEPT = "kept"
REJECTED = "rejected"


def scored_pool(kept: DataFrame, rejected: DataFrame) -> DataFrame:
    """Kept and rejected items with their scores and a ``source`` column."""
    return kept.withColumn("source", F.lit(KEPT)).unionByName(
        rejected.withColumn("source", F.lit(REJECTED)), allowMissingColumns=True
    )


def restrict_labels(pool: DataFrame, labels: DataFrame | Sequence[str], label: str = "label") -> DataFrame:
    """Rows of the given labels (a list or a table of labels)."""
    if isinstance(labels, DataFrame):
        return join_small(pool, labels.select(label).distinct(), [label], "left_semi")
    return pool.filter(F.col(label).isin(*labels))


def stratified_sample(
    pool: DataFrame,
    n: int = 5,
    mode: str = "random",
    labels: DataFrame | Sequence[str] | None = None,
    seed: int = 42,
    label: str = "label",
    item: str = "item_id",
    score: str = "composite_score",
) -> DataFrame:
    """n items per label: ``random``, ``borderline``, ``worst_kept`` or ``best_rejected``."""
    rows = pool if labels is None else restrict_labels(pool, labels, label)
    value = F.col(score)
    if mode == "random":
        order = [shuffle_key(F.col(item), seed)]
    elif mode == "borderline":
        order = [F.abs(value - BORDERLINE_CENTER)]
    elif mode == "worst_kept":
        rows, order = rows.filter(F.col("source") == KEPT), [value]
    elif mode == "best_rejected":
        rows, order = rows.filter(F.col("source") == REJECTED), [-value]
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return top_n(rows, [label], [*order, F.col("source"), F.col(item)], n)


def review_queue(
    samples: DataFrame,
    ground_truth: DataFrame,
    page_size: int = 12,
    order: Sequence[str] = ("label", "rn"),
    item: str = "item_id",
) -> DataFrame:
    """Samples not labelled yet, numbered and cut into pages (from 0)."""
    todo = samples.join(ground_truth.select(item), item, "left_anti")
    numbered = range_rank(todo, [], [F.col(c) for c in (*order, item)], rank="position")
    return numbered.withColumn("page", F.floor((F.col("position") - 1) / page_size))


def confusion_metrics(tp, fp, fn, tn):
    """Columns of the four counts with precision, recall and f1 (4 decimals)."""
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return {
        "precision": round_to(precision, 4),
        "recall": round_to(recall, 4),
        "f1": round_to(f1_score(precision, recall), 4),
    }


def filter_metrics(ground_truth: DataFrame) -> DataFrame:
    """One row: positive = kept, true = labelled good.

    ``false_positive_rate`` is fp/(fp+tp) and ``false_negative_rate`` is
    fn/(fn+tn): shares of the kept and of the rejected side.
    """
    kept, good = F.col("source") == KEPT, F.col("label") == "good"
    counts = ground_truth.agg(
        F.count_if(kept & good).alias("tp"),
        F.count_if(kept & ~good).alias("fp"),
        F.count_if(~kept & good).alias("fn"),
        F.count_if(~kept & ~good).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            **confusion_metrics(tp, fp, fn, tn),
            "false_positive_rate": round_to(ratio(fp, fp + tp), 4),
            "false_negative_rate": round_to(ratio(fn, fn + tn), 4),
        }
    )


def metrics_by_reason(ground_truth: DataFrame, reason: str = "reject_reason") -> DataFrame:
    """Rejected items with a reason: totals, wrongly and rightly rejected."""
    good = F.col("label") == "good"
    return (
        ground_truth.filter((F.col("source") == REJECTED) & F.col(reason).isNotNull())
        .groupBy(reason)
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(good).alias("false_negative_count"),
            F.count_if(~good).alias("true_negative_count"),
        )
    )


def attach_scores(
    ground_truth: DataFrame,
    scores: DataFrame,
    keys: Sequence[str] = ("item_id",),
    score: str = "composite_score",
) -> DataFrame:
    """Ground truth with the score of each key; 0 when there is none.

    The scores are cut down to the labelled keys first, so a small ground truth
    never makes the whole score table shuffle.
    """
    wanted = join_small(
        scores.select(*keys, score), ground_truth.select(*keys).distinct(), keys, "left_semi"
    )
    return ground_truth.join(wanted, list(keys), "left").withColumn(
        score, F.coalesce(F.col(score), F.lit(0.0))
    )


def sweep(
    scored: DataFrame,
    thresholds: Sequence[float] = SWEEP_THRESHOLDS,
    score: str = "composite_score",
) -> DataFrame:
    """Metrics of "keep when score >= t" for each threshold, best f1 first.

    One pass reduces the items to a histogram over the threshold intervals;
    the thresholds are evaluated on its few rows, whatever their number.
    """
    cuts = sorted(thresholds)
    reached = sum((F.col(score) >= t).cast("int") for t in cuts)
    histogram = scored.groupBy(reached.alias("_reached")).agg(
        F.count_if(F.col("label") == "good").alias("_good"),
        F.count_if(F.col("label") != "good").alias("_bad"),
    )
    steps = F.array(
        *[F.struct(F.lit(i + 1).alias("i"), F.lit(float(t)).alias("t")) for i, t in enumerate(cuts)]
    )
    kept = F.col("_reached") >= F.col("_step.i")
    counts = (
        histogram.withColumn("_step", F.explode(steps))
        .groupBy(F.col("_step.t").alias("min_composite"))
        .agg(
            F.sum(F.when(kept, F.col("_good")).otherwise(0)).alias("tp"),
            F.sum(F.when(kept, F.col("_bad")).otherwise(0)).alias("fp"),
            F.sum(F.when(kept, 0).otherwise(F.col("_good"))).alias("fn"),
            F.sum(F.when(kept, 0).otherwise(F.col("_bad"))).alias("tn"),
        )
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(confusion_metrics(tp, fp, fn, tn)).orderBy(
        F.col("f1").desc(), "min_composite"
    )


def threshold_curve(scored: DataFrame, score: str = "composite_score") -> DataFrame:
    """Metrics of "keep when score >= t" for every score t that occurs: the whole precision and recall curve.

    Items are added up by score; running sums over the ranked scores, in chunks, give the counts of all
    thresholds at once, so neither their number nor a frequent score matters. Items without a score count nowhere.
    """
    good, bad = F.count_if(F.col("label") == "good"), F.count_if(F.col("label") != "good")
    by_score = scored.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("min_composite"))
    ranked = range_rank(
        by_score.agg(good.alias("_good"), bad.alias("_bad")), [], [F.desc("min_composite")], "_rank"
    )
    total = ranked.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_good", "_bad")]).first()
    counts = running(ranked, [], "_rank", {"tp": ("sum", F.col("_good")), "fp": ("sum", F.col("_bad"))}).select(
        "min_composite", "tp", "fp", (total["_good"] - F.col("tp")).alias("fn"), (total["_bad"] - F.col("fp")).alias("tn")
    )
    precision, recall = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    rates = counts.withColumns({"precision": precision, "recall": recall})
    return rates.withColumn("f1", f1_score(F.col("precision"), F.col("recall")))


def recommend(swept: DataFrame, default: float = DEFAULT_THRESHOLD) -> DataFrame:
    """The best sweep row, or the default threshold with f1 0."""
    spark = swept.sparkSession
    fallback = spark.range(1).select(
        F.lit(1).alias("_order"), F.lit(default).alias("min_composite"), F.lit(0.0).alias("f1")
    )
    found = swept.select(F.lit(0).alias("_order"), "min_composite", "f1")
    return (
        found.unionByName(fallback)
        .orderBy("_order", F.col("f1").desc(), "min_composite")
        .limit(1)
        .drop("_order")
    )
