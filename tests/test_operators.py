"""Hand-made tables for verdicts, calibration, splits, training sets, evaluation, boxes."""

import math

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import boxes, calibration, evaluation, splits, trainset, vectors, verdict


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def numbered(spark, sizes):
    data = [(label, f"{label}_{i:03d}") for label, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(data, "label string, item_id string")


# -- verdict ---------------------------------------------------------------------


def test_reasons_are_merged_in_order(spark):
    items = numbered(spark, {"a": 5})
    classified = items.withColumn("category", F.when(F.col("item_id") == "a_001", "dead_specimen").otherwise("good"))
    outliers = items.withColumn("is_outlier", F.col("item_id").isin("a_001", "a_002"))
    dups = spark.createDataFrame([("a", "a_000", "a_003"), ("a", "a_004", "a_003")], "label string, kept string, removed string")
    got = {r["item_id"]: (r["reasons"], r["removed"]) for r in verdict.verdict(items, classified, outliers, dups).collect()}
    assert got["a_001"] == (["category", "outlier"], True) and got["a_003"] == (["duplicate"], True)
    assert got["a_000"] == ([], False)
    assert verdict.verdict(items).filter("removed").count() == 0


def test_corrupted_is_kept_by_default(spark):
    items = numbered(spark, {"a": 1})
    classified = items.withColumn("category", F.lit("corrupted"))
    assert not verdict.verdict(items, classified).first()["removed"]
    assert verdict.verdict(items, classified, reject_categories=["corrupted"]).first()["removed"]


def test_cap_keeps_the_best_and_earlier_ties(spark):
    data = [("a", f"{i}", s, False) for i, s in enumerate([0.9, 0.7, 0.5, 0.3, 0.5])] + [("b", "z", None, False), ("a", "r", 1.0, True)]
    df = spark.createDataFrame(data, "label string, item_id string, composite_score double, removed boolean")
    df = df.withColumn("reasons", F.when(F.col("removed"), F.array(F.lit("category"))).otherwise(F.array().cast("array<string>")))
    got = {r["item_id"]: r["reasons"] for r in verdict.cap_per_label(df, 3).collect()}
    assert [i for i in "01234z" if not got[i]] == ["0", "1", "2", "z"]
    assert got["4"] == ["over_cap"] and got["r"] == ["category"]
    assert rows(verdict.verdict_stats(verdict.cap_per_label(df, 3))) == rows(
        spark.createDataFrame([("a", 3, 3), ("b", 0, 1), (None, 3, 4)], "l string, r long, k long"))


def test_emptied_labels_leave_map_and_metadata(spark):
    data = [("train", "a", "1", True), ("test", "a", "2", False), ("train", "b", "3", True), ("train", "c", "4", False)]
    df = spark.createDataFrame(data, "split string, label string, item_id string, removed boolean")
    label_map = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "label string, idx int")
    out = verdict.apply_dataset(df, label_map, label_map.select("label"))
    assert rows(out["label_map"]) == [("c", 0)] and rows(out["metadata"]) == [("c",)]
    kept = verdict.apply_dataset(df, label_map, label_map.select("label"), drop_when="all_splits")
    assert rows(kept["label_map"]) == [("a", 0), ("c", 1)]


# -- calibration -----------------------------------------------------------------


def truth(spark, data):
    return spark.createDataFrame(data, "item_id string, label string, source string, reject_reason string")


def test_confusion_square_and_reasons(spark):
    gt = truth(spark, [("1", "good", "kept", None), ("2", "bad", "kept", None), ("3", "good", "rejected", "blur"), ("4", "bad", "rejected", "blur")])
    m = calibration.filter_metrics(gt).first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (1, 1, 1, 1)
    assert m["precision"] == m["recall"] == m["f1"] == m["false_positive_rate"] == m["false_negative_rate"] == 0.5
    assert rows(calibration.metrics_by_reason(gt)) == [("blur", 2, 1, 1)]
    empty = calibration.filter_metrics(gt.filter("false")).first()
    assert empty["precision"] == empty["f1"] == 0.0


def test_sweep_orders_by_f1_then_threshold(spark):
    scored = spark.createDataFrame([("good", 0.5), ("good", 0.22), ("bad", 0.1), ("bad", 0.0)], "label string, composite_score double")
    got = calibration.sweep(scored).collect()
    assert [r["min_composite"] for r in got][:2] == [0.15, 0.2] and got[0]["f1"] == 1.0
    assert got[0]["tn"] == 2 and len(got) == 7
    assert calibration.recommend(calibration.sweep(scored)).first()["min_composite"] == 0.15
    assert tuple(calibration.recommend(calibration.sweep(scored.filter("false"))).first()) == (0.2, 0.0)


def test_threshold_curve_counts_every_score(spark):
    data = [("good" if i * 7 % 5 < 3 else "bad", (i * 13 % 23) / 10) for i in range(90)]
    scored = spark.createDataFrame([*data, ("good", None)], "label string, composite_score double")
    got = {r["min_composite"]: r for r in calibration.threshold_curve(scored).collect()}
    assert len(got) == 23
    for t, r in got.items():
        tp, fp = (sum(label == want and score >= t for label, score in data) for want in ("good", "bad"))
        fn, tn = (sum(label == want and score < t for label, score in data) for want in ("good", "bad"))
        assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (tp, fp, fn, tn)
        assert r["precision"] == tp / (tp + fp) and r["recall"] == tp / (tp + fn)
    assert calibration.threshold_curve(scored.filter("false")).count() == 0


def test_sampling_modes(spark):
    kept = numbered(spark, {"a": 5, "b": 5}).withColumn("composite_score", F.substring("item_id", 5, 1).cast("double") / 10)
    rejected = kept.withColumn("item_id", F.concat(F.lit("r"), "item_id"))
    pool = calibration.scored_pool(kept, rejected)
    pick = lambda mode, **k: rows(calibration.stratified_sample(pool, 2, mode, **k).select("item_id"))
    assert pick("worst_kept") == [("a_000",), ("a_001",), ("b_000",), ("b_001",)]
    assert pick("best_rejected", labels=["a"]) == [("ra_003",), ("ra_004",)]
    assert pick("borderline", labels=["b"]) == [("b_003",), ("rb_003",)]
    assert pick("random") == pick("random") and len(pick("random")) == 4
    with pytest.raises(ValueError):
        pick("other")


def test_review_pages(spark):
    sample = numbered(spark, {"a": 20, "b": 10}).withColumn("rn", F.lit(1))
    gt = spark.createDataFrame([("a_003",)], "item_id string")
    got = calibration.review_queue(sample, gt)
    assert got.count() == 29 and {r["page"]: r["count"] for r in got.groupBy("page").count().collect()} == {0: 12, 1: 12, 2: 5}


# -- splits ----------------------------------------------------------------------


# (train, validation, test) expected for a label of each size.
SPLITS = {
    "dataset": {1: (0, 1, 0), 2: (0, 1, 1), 3: (1, 1, 1), 4: (2, 1, 1), 5: (3, 1, 1), 10: (8, 1, 1), 15: (12, 2, 1), 20: (16, 2, 2), 25: (21, 2, 2), 50: (40, 5, 5), 100: (80, 10, 10)},
    "merge": {1: (1, 0, 0), 2: (1, 1, 0), 3: (1, 1, 1), 4: (2, 1, 1), 5: (3, 1, 1), 10: (8, 1, 1), 15: (12, 2, 1), 20: (16, 2, 2), 25: (21, 2, 2), 50: (40, 5, 5), 100: (80, 10, 10)},
    "samples": {1: (1, 0, 0), 2: (2, 0, 0), 3: (2, 1, 0), 4: (3, 1, 0), 5: (4, 1, 0), 10: (8, 1, 1), 15: (12, 2, 1), 20: (16, 2, 2), 25: (20, 2, 3), 50: (40, 5, 5), 100: (80, 10, 10)},
}


@pytest.mark.parametrize("rule", list(SPLITS))
def test_split_sizes_per_rule(spark, rule):
    want = SPLITS[rule]
    items = numbered(spark, {f"n{n:03d}": n for n in want})
    got = {int(r["label"][1:]): (r["train"], r["validation"], r["test"])
           for r in splits.split_sizes(splits.assign_splits(items, rule)).collect()}
    assert got == want


def test_split_is_disjoint_complete_and_stable(spark):
    items = numbered(spark, {"a": 50, "b": 7})
    done = splits.assign_splits(items)
    assert rows(done) == rows(splits.assign_splits(items.repartition(5)))
    assert rows(done) != rows(splits.assign_splits(items, seed=1))
    assert splits.split_overlaps(done).count() == 0 and splits.lost_items(items, done).count() == 0
    with pytest.raises(FileExistsError):
        splits.assert_unsplit(done)


def test_merge_overrides_annotations(spark):
    corpus = spark.createDataFrame([("train", "a", "x"), ("train", "b", "k")], "split string, label string, name string")
    old = spark.createDataFrame([("train", "a", "x", 0.1), ("train", "b", "k", 0.2)], "split string, label string, name string, score double")
    staged = spark.createDataFrame([("a", "x"), ("c", "n")], "label string, name string")
    new = spark.createDataFrame([("a", "x", 0.9), ("a", "gone", 0.9)], "label string, name string, score double")
    items, annotations, stats = splits.merge_corpus(corpus, old, staged, new)
    assert rows(items) == [("train", "a", "x"), ("train", "b", "k"), ("train", "c", "n")]
    assert rows(annotations) == [("train", "a", "x", 0.9), ("train", "b", "k", 0.2)]
    assert rows(stats) == [("a", 1, 1, 0, 0), ("c", 1, 1, 0, 0)]
    labels = spark.createDataFrame([("a",), ("z",)], "label string")
    assert rows(splits.empty_labels(labels, staged)) == [("z",)]


# -- training sets ---------------------------------------------------------------


def test_samples_weights_and_resample(spark):
    items = numbered(spark, {"a": 100, "b": 5, "u": 3}).withColumn("name", F.col("item_id"))
    label_map = spark.createDataFrame([("a", 0), ("b", 1), ("e", 2)], "label string, idx int")
    ann = spark.createDataFrame([("a", "a_000", 7)], "label string, name string, bbox int")
    got = trainset.samples(items, label_map, ann)
    assert got.count() == 105 and got.filter("bbox = 7").count() == 1
    assert rows(trainset.unknown_labels(items, label_map)) == [("u", 3)]
    assert rows(trainset.class_weights(got, label_map)) == [("a", 0, 100, 0.01), ("b", 1, 5, 0.2), ("e", 2, 0, 0.0)]
    draws = spark.range(2000).withColumnRenamed("id", "draw_id")
    drawn = trainset.balanced_resample(got, draws)
    share = {r["label"]: r["count"] for r in drawn.groupBy("label").count().collect()}
    assert sum(share.values()) == 2000 and abs(share["a"] - 1000) < 120
    assert drawn.filter("label = 'b'").select("item_id").distinct().count() == 5
    assert trainset.calibration_sample(items, 10).count() == 10


def test_label_map_validation(spark):
    good = spark.createDataFrame([("a", 0), ("b", 1)], "label string, idx int")
    bad = spark.createDataFrame([("a", 0), ("b", 3), ("c", 3)], "label string, idx int")
    assert trainset.validate_label_map(good).first()["valid"]
    assert not trainset.validate_label_map(bad).first()["valid"] and not trainset.validate_label_map(bad.filter("false")).first()["valid"]
    assert rows(trainset.label_map_problems(bad)) == [(1, "missing"), (2, "missing"), (3, "duplicate")]


# -- evaluation ------------------------------------------------------------------


def test_loss_ties_and_outliers(spark):
    df = spark.createDataFrame([("1", 0, [1.0, 1.0]), ("2", 1, [1000.0, 0.0]), ("3", 1, [0.0, 0.0])], "item_id string, label_idx int, logits array<double>")
    got = {r["item_id"]: r for r in evaluation.item_losses(df).collect()}
    assert got["1"]["pred"] == 0 and abs(got["1"]["loss"] - math.log(2)) < 1e-12 and got["2"]["loss"] == 1000.0
    acc = evaluation.accuracy_loss(df).first()
    assert (acc["items"], acc["correct"]) == (3, 1)
    flagged = evaluation.loss_outliers(evaluation.item_losses(df), 1.0).collect()
    assert [r["item_id"] for r in flagged if r["problematic"]] == ["2"] and flagged[0]["item_id"] == "2"


def test_report_with_absent_class(spark):
    preds = spark.createDataFrame([(0, 0), (0, 2), (1, 1)], "truth int, pred int")
    names = spark.createDataFrame([("zero", 0)], "label string, idx int")
    got = {r["name"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in evaluation.classification_report(preds, names).collect()}
    assert got["zero"] == (1.0, 0.5, 0.6667, 2) and got["class_2"] == (0.0, 0.0, 0.0, 0)
    assert got["accuracy"][0] == 0.6667 and got["macro avg"][2] == 0.5556 and got["weighted avg"][2] == 0.7778


def test_carry_forward(spark):
    df = spark.createDataFrame([("s", i, f"p{i}") for i in range(7)], "source string, frame int, prediction string")
    got = [r["shown"] for r in evaluation.decimate_and_fill(df).orderBy("frame").collect()]
    assert got == ["p0"] * 3 + ["p3"] * 3 + ["p6"]


# Losses per epoch, and the (stopping, best) epochs expected with a patience of three.
STOPS = {
    "a": ([5, 4, 4, 4, 3, 3, 3, 3, 1], 7, 4),
    "b": ([3, 2, 1], None, 2),
    "c": ([1, 1, 1, 1, 0], 3, 0),
    "d": ([2, 3, 1, 2, 2, 2], 5, 2),
}


def test_early_stop(spark):
    data = [(r, e, float(v)) for r, (losses, _, _) in STOPS.items() for e, v in enumerate(losses)]
    df = spark.createDataFrame(data, "run string, epoch int, val_loss double")
    got = {r["run"]: (r["stop_epoch"], r["best_epoch"]) for r in evaluation.early_stop(df, 3).collect()}
    assert got == {r: (stop, best) for r, (_, stop, best) in STOPS.items()}


def test_checkpoints_and_comparison(spark):
    ck = spark.createDataFrame([("1", "mobilenetv2", "p"), ("1", "vit_b_16", "q"), ("2", "new", "r"), ("3", "new", "s")], "run string, arch string, path string")
    got = evaluation.best_checkpoint(ck, last_runs=2)
    assert rows(got.select("run", "path")) == [("2", "r"), ("3", "s")]
    assert rows(evaluation.best_checkpoint(ck).filter("run = '1'").select("path", "display")) == [("q", "ViT-B/16")]
    many = spark.createDataFrame([("1", m, "x") for m in "abcdef"], "item_id string, model string, label string")
    assert rows(evaluation.compare_models(many, list("abcdef")).select("f", "agree")) == [("x", True)]


# -- boxes -----------------------------------------------------------------------


def test_clip_rounds_half_even_and_drops_tiny(spark):
    items = spark.createDataFrame([("a", "x", 100, 100)], "label string, name string, width int, height int")
    dets = spark.createDataFrame(
        [("a", "x", 0, -5.0, 2.5, 50.0, 110.0, 0.123456), ("a", "x", 1, 0.0, 0.0, 9.0, 9.0, 0.9), ("a", "x", 2, 120.0, 0.0, 130.0, 9.0, 0.9)],
        "label string, name string, det_idx int, x1 double, y1 double, x2 double, y2 double, score double",
    )
    got = boxes.clip_boxes(dets, items).collect()
    assert len(got) == 1 and tuple(got[0]["bbox"]) == (0, 2, 50, 98) and got[0]["score"] == 0.1235


ANN = "label string, name string, bbox struct<x:bigint,y:bigint,w:bigint,h:bigint>, score double"


def test_retry_never_touches_existing(spark):
    ann = spark.createDataFrame([("a", "1", (0, 0, 9, 9), 0.9), ("a", "2", None, None), ("a", "3", None, None)], ANN)
    again = spark.createDataFrame([("a", "1", (1, 1, 2, 2), 0.2), ("a", "2", (3, 3, 4, 4), 0.25)], ANN)
    merged = boxes.retry_merge(ann, again, 0.15)
    got = {r["name"]: (r["score"], r["retry_threshold"]) for r in merged.collect()}
    assert got == {"1": (0.9, None), "2": (0.25, 0.15), "3": (None, None)}
    assert tuple(boxes.retry_stats(merged).first()) == (2, 1, 1)
    roll = {r["label"]: (r["items"], r["detected"], r["pct"]) for r in boxes.annotation_rollup(ann).collect()}
    assert roll == {"a": (3, 1, 33.3), None: (3, 1, 33.3)}


def test_review_drops_unreadable_without_replacement(spark):
    ann = spark.createDataFrame([("a", f"{i:02d}", (0, 0, 1, 1) if i < 9 else None, 0.5) for i in range(12)], ANN)
    items = ann.select("label", "name", F.when(F.col("name") == "10", 0).otherwise(5).alias("width"))
    got = boxes.review_sample(ann, items, n_detected=4, n_missing=3)
    assert got.filter("NOT missing").count() == 4 and got.filter("missing").count() == 2


def test_decisions(spark):
    old = spark.createDataFrame([("a", "1", (0, 0, 1, 1), "accepted")], "label string, name string, bbox struct<x:bigint,y:bigint,w:bigint,h:bigint>, status string")
    dec = spark.createDataFrame(
        [("a", "1", "reject", (0, 0, 1, 1), 1), ("a", "2", "accept", (2, 2, 2, 2), 2), ("a", "2", "correct", (3, 3, 3, 3), 3), ("a", "3", "skip", None, 4)],
        "label string, name string, action string, bbox struct<x:bigint,y:bigint,w:bigint,h:bigint>, seq long",
    )
    done = boxes.apply_decisions(old, dec)
    assert {r["name"]: (r["status"], r["bbox"] and r["bbox"]["x"]) for r in done.collect()} == {"1": ("rejected", None), "2": ("corrected", 3)}
    assert tuple(boxes.validation_stats(done).first()) == (2, 1, 1)


def test_drag_and_small_boxes(spark):
    drags = spark.createDataFrame([(1, 60.5, 40.0, 10.5, 10.0, 50, 50), (2, 10.0, 10.0, 14.9, 40.0, 50, 50)], "id int, x1 double, y1 double, x2 double, y2 double, width int, height int")
    got = boxes.normalise_drag(drags).collect()
    assert [r["id"] for r in got] == [1] and tuple(got[0]["bbox"]) == (10, 10, 40, 30)
    ann = spark.createDataFrame([("a", "eq", (0, 0, 5, 10), 0.5), ("a", "lo", (0, 0, 4, 10), 0.5), ("a", "no", None, None), ("a", "un", (0, 0, 1, 1), 0.5)], ANN)
    items = ann.select("label", "name", F.when(F.col("name") == "un", 0).otherwise(10).alias("width"), F.lit(100).alias("height"))
    assert rows(boxes.small_boxes(ann, items)) == [("a", "lo")]


# -- gaps, unknown classes, empty input ----------------------------------------------


def test_carried_frames_with_gaps_and_nulls(spark):
    frames = spark.createDataFrame(
        [("s", f, f"p{f}") for f in (0, 1, 2, 4, 5, 7)] + [("s", 9, None), ("s", 10, "p10"), ("s", 12, "p12"), ("t", 1, "q1")],
        "source string, frame int, prediction string",
    )
    got = {(r["source"], r["frame"]): (r["shown"], r["predicted"]) for r in evaluation.decimate_and_fill(frames).collect()}
    assert [got["s", f][0] for f in (0, 1, 2, 4, 5, 7, 9, 10, 12)] == ["p0"] * 8 + ["p12"]
    assert got["s", 9][1] and not got["s", 4][1] and got["t", 1] == (None, False)


def test_top_k_keeps_classes_outside_the_map(spark):
    logits = spark.createDataFrame([("x", [0.1, 5.0, 0.2])], "item_id string, logits array<double>")
    names = spark.createDataFrame([(0, "a"), (2, "c")], "idx int, label string")
    got = [(r["rank"], r["label"], r["display_name"]) for r in evaluation.top_k(logits, names, k=3).orderBy("rank").collect()]
    assert got == [(1, "class_1", "class_1"), (2, "c", "c"), (3, "a", "a")]


def test_loss_summary_counts_problems(spark):
    losses = spark.createDataFrame([(str(i), 1.0) for i in range(9)] + [("z", 11.0)], "item_id string, loss double")
    row = evaluation.loss_summary(losses, 2.0).first()
    assert (row["total_items"], row["sigma_k"], row["problematic_count"]) == (10, 2.0, 1) and row["threshold"] == 8.0
    assert evaluation.loss_outliers(losses, 2.0).first()["item_id"] == "z"


def test_totals_of_empty_input(spark):
    found = spark.createDataFrame([("a", "x", False)], "label string, item_id string, suspected boolean")
    assert rows(vectors.mislabel_summary(found)) == [(None, 0)]
    annotations = spark.createDataFrame([], "label string, name string, bbox struct<x:int>")
    assert rows(boxes.annotation_rollup(annotations)) == [(None, 0, 0, 0.0)]


@pytest.mark.parametrize("max_bytes", [1, 200, 1 << 20])
def test_centroid_blocks_of_any_size(spark, max_bytes):
    vecs = spark.createDataFrame(
        [(f"l{i % 5}", i, [float((i * k) % 7 + 1) for k in (1, 2, 3)]) for i in range(40)],
        "label string, item_id int, embedding array<float>",
    )
    whole = {r["item_id"]: tuple(r) for r in vectors.mislabeled(vecs).collect()}
    assert {r["item_id"]: tuple(r) for r in vectors.mislabeled(vecs, max_bytes=max_bytes).collect()} == whole
    cents = vectors.centroids(vecs)
    scores = [
        {r["item_id"]: [round(x, 9) for x in r["s"]] for r in vecs.select("item_id", vectors.class_scores(vecs, cents, max_bytes=m).alias("s")).collect()}
        for m in (max_bytes, 1 << 24)
    ]
    assert scores[0] == scores[1] and len(scores[0][0]) == 5


def test_encoder_gets_what_setup_returns(spark):
    import numpy as np

    items = spark.createDataFrame([("a", 1, "xx")], "label string, item_id int, text string")
    done = vectors.encode(items, lambda state, texts: np.full((len(texts), 2), state), "text", setup=lambda: 7.0)
    assert list(done.first()["embedding"]) == [7.0, 7.0]
