"""Evaluation of stored predictions and training histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.constants import ARCH_DISPLAY, ARCH_RANK
from corpusmill.functions.numeric import argmax, f1_score, log_sum_exp, ratio, round_to, softmax
from corpusmill.plans.running import running
from corpusmill.plans.sizing import join_small


def cross_entropy(logits: Column, truth: Column) -> Column:
    """-log softmax(logits)[truth], truth zero-based."""
    return log_sum_exp(logits) - F.element_at(logits, truth + 1)


# -- E1 - E3 -------------------------------------------------------------------


def accuracy_loss(logits: DataFrame, truth: str = "label_idx", column: str = "logits") -> DataFrame:
    """One row: items, correct, mean cross-entropy loss, accuracy."""
    scored = logits.select(
        cross_entropy(F.col(column), F.col(truth)).alias("_loss"),
        (argmax(F.col(column)) == F.col(truth)).alias("_ok"),
    )
    return scored.agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if("_ok").alias("correct"),
        F.avg("_loss").alias("loss"),
        F.avg(F.col("_ok").cast("double")).alias("accuracy"),
    )


def predictions(logits: DataFrame, truth: str = "label_idx", column: str = "logits") -> DataFrame:
    """``(truth, pred)`` with the first maximum as prediction."""
    return logits.select(F.col(truth).alias("truth"), argmax(F.col(column)).alias("pred"))


def confusion_matrix(preds: DataFrame) -> DataFrame:
    """Long form: ``(truth, pred, items)`` of the pairs that occur."""
    return preds.groupBy("truth", "pred").agg(F.count(F.lit(1)).alias("items"))


def confusion_table(matrix: DataFrame, classes: Sequence[int]) -> DataFrame:
    """Wide form: one row per truth, one column per given class."""
    return (
        matrix.groupBy("truth").pivot("pred", list(classes)).agg(F.sum("items")).na.fill(0)
    )


def classification_report(preds: DataFrame, label_map: DataFrame | None = None) -> DataFrame:
    """Precision, recall, f1 and support per class, with accuracy and averages.

    The items are read once, into the confusion matrix; every figure comes
    from its rows. Classes are those of truths and predictions; a class
    without a name in the map is ``class_{i}``; empty denominators give 0.
    """
    matrix = confusion_matrix(preds)
    sides = matrix.select(
        "items",
        F.explode(
            F.array(
                F.struct(F.col("truth").alias("c"), F.lit(1).alias("t"), F.lit(0).alias("p")),
                F.struct(F.col("pred").alias("c"), F.lit(0).alias("t"), F.lit(1).alias("p")),
            )
        ).alias("_s"),
        (F.col("truth") == F.col("pred")).cast("int").alias("_hit"),
    )
    per_class = sides.groupBy(F.col("_s.c").alias("class_idx")).agg(
        F.sum(F.col("items") * F.col("_s.t")).alias("support"),
        F.sum(F.col("items") * F.col("_s.p")).alias("_predicted"),
        F.sum(F.col("items") * F.col("_s.t") * F.col("_hit")).alias("_tp"),
    )
    precision = ratio(F.col("_tp"), F.col("_predicted"))
    recall = ratio(F.col("_tp"), F.col("support"))
    per_class = per_class.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1", f1_score(F.col("precision"), F.col("recall"))
    )
    numbered = F.concat(F.lit("class_"), F.col("class_idx").cast("string"))
    if label_map is None:
        named = per_class.withColumn("name", numbered)
    else:
        names = label_map.select(F.col("idx").alias("class_idx"), F.col("label").alias("_name"))
        named = per_class.join(names, "class_idx", "left").withColumn(
            "name", F.coalesce(F.col("_name").cast("string"), numbered)
        )
    columns = ("name", "precision", "recall", "f1", "support")
    scores = ("precision", "recall", "f1")
    accuracy = ratio(F.sum("_tp"), F.sum("support"))
    whole = per_class.agg(
        *[F.avg(c).alias(f"m_{c}") for c in scores],
        *[ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"w_{c}") for c in scores],
        accuracy.alias("_acc"),
        F.sum("support").alias("support"),
    )
    rows = F.array(
        F.struct(F.lit("accuracy").alias("name"), *[F.col("_acc").alias(c) for c in scores]),
        F.struct(F.lit("macro avg").alias("name"), *[F.col(f"m_{c}").alias(c) for c in scores]),
        F.struct(F.lit("weighted avg").alias("name"), *[F.col(f"w_{c}").alias(c) for c in scores]),
    )
    summary = whole.filter(F.col("support") > 0).select(F.explode(rows).alias("_r"), "support").select(
        "_r.*", "support"
    )
    return named.select(*columns).unionByName(summary.select(*columns)).withColumns(
        {c: round_to(F.col(c), 4) for c in scores}
    )


# -- E4 ------------------------------------------------------------------------


def item_losses(
    logits: DataFrame,
    keys: Sequence[str] = ("item_id",),
    truth: str = "label_idx",
    column: str = "logits",
) -> DataFrame:
    """Per item: loss, truth, prediction, confidence and correctness."""
    return logits.select(
        *keys,
        cross_entropy(F.col(column), F.col(truth)).alias("loss"),
        F.col(truth).alias("truth"),
        argmax(F.col(column)).alias("pred"),
        (1 / F.aggregate(
            F.zip_with(column, F.array_repeat(F.array_max(column), F.size(column)),
                       lambda x, peak: F.exp(x - peak)),
            F.lit(0.0), lambda a, x: a + x)).alias("confidence"),
        (argmax(F.col(column)) == F.col(truth)).alias("correct"),
    )


def loss_summary(losses: DataFrame, sigma_k: float = 3.0) -> DataFrame:
    """One row: items, mean and population std of the loss, threshold and how many lie above it."""
    limit = _loss_limit(losses, sigma_k)
    return losses.agg(
        F.count(F.lit(1)).alias("total_items"),
        F.avg("loss").alias("mean_loss"),
        F.stddev_pop("loss").alias("std_loss"),
        F.first(F.lit(float(sigma_k))).alias("sigma_k"),
        F.max(limit).alias("threshold"),
        F.count_if(F.col("loss") > limit).alias("problematic_count"),
    )


def _loss_limit(losses: DataFrame, sigma_k: float) -> Column:
    """The threshold as a scalar subquery."""
    return losses.select((F.avg("loss") + F.lit(float(sigma_k)) * F.stddev_pop("loss")).alias("_limit")).scalar()


def loss_outliers(losses: DataFrame, sigma_k: float = 3.0, keys: Sequence[str] = ("item_id",)) -> DataFrame:
    """Losses, highest first and then by key, with ``problematic`` = strictly above the threshold.

    Names are joined before (:func:`with_class_names`), so the order is the last step.
    """
    marked = losses.withColumn("problematic", F.col("loss") > _loss_limit(losses, sigma_k))
    return marked.orderBy(F.col("loss").desc(), *keys)


def with_class_names(df: DataFrame, label_map: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add a name for each index column, ``class_{i}`` when unknown."""
    for index, alias in columns.items():
        names = label_map.select(F.col("idx").alias(index), F.col("label").cast("string").alias("_name"))
        df = join_small(df, names, [index], "left").withColumn(
            alias, F.coalesce("_name", F.concat(F.lit("class_"), F.col(index).cast("string")))
        ).drop("_name")
    return df


# -- E6 - E8 -------------------------------------------------------------------


def top_k(
    logits: DataFrame,
    label_map: DataFrame,
    meta: DataFrame | None = None,
    k: int = 5,
    keys: Sequence[str] = ("item_id",),
    column: str = "logits",
) -> DataFrame:
    """The k likeliest classes per item: rank, class, probability, name, band.

    Sorting happens inside the row's array. A class that the map doesn't hold
    is ``class_{i}``. ``display_name`` falls back from the metadata name to the
    label; ``band`` of rank 1 is high above 60 %, medium above 30 %.
    """
    ranked = F.slice(
        F.array_sort(
            F.transform(F.col("_probs"), lambda p, i: F.struct((-p).alias("n"), i.alias("i")))
        ),
        1,
        k,
    )
    rows = (
        logits.select(*keys, softmax(F.col(column)).alias("_probs"))
        .select(*keys, F.posexplode(ranked).alias("_pos", "_top"))
        .select(
            *keys,
            (F.col("_pos") + 1).alias("rank"),
            F.col("_top.i").alias("idx"),
            (-F.col("_top.n")).alias("probability"),
        )
    )
    names = label_map.select("idx", F.col("label").cast("string").alias("label"))
    if meta is not None:
        display = meta.select(F.col("label").cast("string").alias("label"),
                              F.col("french_name").alias("_display"))
        names = names.join(display, "label", "left")
    else:
        names = names.withColumn("_display", F.lit(None).cast("string"))
    percent = F.col("probability") * 100
    band = (
        F.when((F.col("rank") == 1) & (percent > 60), "high")
        .when((F.col("rank") == 1) & (percent > 30), "medium")
        .otherwise("low")
    )
    label = F.coalesce("label", F.concat(F.lit("class_"), F.col("idx").cast("string")))
    return join_small(rows, names, ["idx"], "left").select(
        *keys, "rank", "idx", label.alias("label"), F.coalesce(F.col("_display"), label).alias("display_name"),
        "probability", band.alias("band"),
    )


def decimate_and_fill(
    frames: DataFrame,
    prediction: str = "prediction",
    every: int = 3,
    source: str = "source",
    frame: str = "frame",
) -> DataFrame:
    """Keep the prediction of every third frame and reuse it until the next.

    Frames may be missing and a prediction may be null: what is shown is the
    last one that was made, however many frames ago. It is carried as a running
    maximum of (frame, prediction), in chunks of frames.
    """
    marked = frames.withColumn("predicted", F.col(frame) % every == 0)
    known = F.col("predicted") & F.col(prediction).isNotNull()
    made = F.when(known, F.struct(F.when(known, F.col(frame)).alias(frame), F.col(prediction).alias(prediction)))
    return running(marked, [source], frame, {"_last": ("max", made)}).withColumn(
        "shown", F.col(f"_last.{prediction}")
    ).drop("_last")


def compare_models(
    best: DataFrame,
    models: Sequence[str],
    keys: Sequence[str] = ("item_id",),
    value: str = "label",
) -> DataFrame:
    """One row per item with a column per model and ``agree``."""
    wide = best.groupBy(*keys).agg(
        *[F.max(F.when(F.col("model") == m, F.col(value))).alias(m) for m in models]
    )
    same = F.lit(True)
    for other in models[1:]:
        same = same & F.col(models[0]).eqNullSafe(F.col(other))
    return wide.withColumn("agree", same)


# -- E9 - E11 ------------------------------------------------------------------


def best_checkpoint(
    checkpoints: DataFrame, rank: Sequence[str] = ARCH_RANK, last_runs: int | None = 4
) -> DataFrame:
    """Best architecture's checkpoint per run (unknown ones last), last runs only."""
    place = F.coalesce(
        *[F.when(F.col("arch") == a, F.lit(i)) for i, a in enumerate(rank)], F.lit(len(rank))
    )
    shown = F.coalesce(
        *[F.when(F.col("arch") == a, F.lit(name)) for a, name in ARCH_DISPLAY.items()], F.col("arch")
    )
    best = checkpoints.groupBy("run").agg(
        F.min(F.struct(place.alias("r"), F.col("path").alias("p"), F.col("arch").alias("a"),
                       shown.alias("d"))).alias("_b")
    ).select("run", F.col("_b.p").alias("path"), F.col("_b.a").alias("arch"),
             F.col("_b.d").alias("display"))
    return best if last_runs is None else best.orderBy(F.col("run").desc()).limit(last_runs)


def improvements(
    history: DataFrame, value: str = "val_loss", mode: str = "min", run: str = "run", epoch: str = "epoch"
) -> DataFrame:
    """Add ``improved`` and ``stale`` (epochs since the last strict improvement)."""
    steps = running(
        history, [run], epoch, {"_best": (mode, F.col(value), False), "_seq": ("sum", F.lit(1))}
    )
    better = F.col(value) < F.col("_best") if mode == "min" else F.col(value) > F.col("_best")
    flagged = steps.withColumn("improved", F.coalesce(better, F.lit(True)))
    last = running(
        flagged, [run], epoch, {"_last": ("max", F.when(F.col("improved"), F.col("_seq")))}
    )
    return last.withColumn("stale", F.col("_seq") - F.col("_last")).drop("_best", "_seq", "_last")


def early_stop(
    history: DataFrame,
    patience: int = 7,
    value: str = "val_loss",
    mode: str = "min",
    run: str = "run",
    epoch: str = "epoch",
) -> DataFrame:
    """Per run: the epoch training stops at (null if never) and the best epoch so far."""
    steps = improvements(history, value, mode, run, epoch)
    stops = steps.groupBy(run).agg(
        F.min(F.when(F.col("stale") >= patience, F.col(epoch))).alias("stop_epoch")
    )
    seen = join_small(steps, stops, [run]).filter(
        F.col("stop_epoch").isNull() | (F.col(epoch) <= F.col("stop_epoch"))
    )
    best = seen.filter("improved").groupBy(run).agg(F.max(epoch).alias("best_epoch"))
    return stops.join(best, run)


def best_epoch(
    history: DataFrame, value: str = "val_loss", run: str = "run", epoch: str = "epoch"
) -> DataFrame:
    """Last epoch that improves the running best: the first one at the minimum."""
    return history.groupBy(run).agg(
        F.min(F.struct(F.col(value).alias("v"), F.col(epoch).alias("e"))).alias("_b")
    ).select(run, F.col("_b.e").alias("best_epoch"), F.col("_b.v").alias("best_value"))
