"""Embedding operators on hand-made vectors and against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import vectors as O

SCHEMA = "label string, item_id string, embedding array<float>"


def frame(spark, data):
    return spark.createDataFrame([(l, i, [float(x) for x in v]) for l, i, v in data], SCHEMA)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def clustered(seed=0, labels=3, each=12, dim=16):
    rng = np.random.default_rng(seed)
    return [
        (f"l{k}", f"l{k}_{i:03d}", np.eye(dim)[k] + rng.normal(0, 0.12, dim))
        for k in range(labels) for i in range(each)
    ]


def test_centroid_is_mean_of_unit_vectors(spark):
    df = frame(spark, [("a", "1", [2, 0]), ("a", "2", [0, 5]), ("b", "3", [0, 3])])
    got = {r["label"]: (r["n"], r["centroid"]) for r in O.centroids(df).collect()}
    assert got["a"][0] == 2 and np.allclose(got["a"][1], [2**-0.5] * 2)
    assert np.allclose(got["b"][1], [0, 1])


def test_centroid_flush_of_partial_groups(spark, monkeypatch):
    monkeypatch.setattr(O, "PARTIAL_GROUPS", 1)
    data = clustered()
    got = {r["label"]: np.array(r["centroid"]) for r in O.centroids(frame(spark, data)).collect()}
    for label in ("l0", "l1", "l2"):
        unit = [v / np.linalg.norm(v) for l, _, v in data if l == label]
        mean = np.mean(unit, axis=0)
        assert np.allclose(got[label], mean / np.linalg.norm(mean), atol=1e-6)


def test_small_labels_have_no_outliers(spark):
    got = O.outliers(frame(spark, [("a", "1", [1, 0]), ("a", "2", [0, 1])]))
    assert rows(got) == [("a", "1", 0.0, False), ("a", "2", 0.0, False)]


def test_outlier_found_and_fallback_equal(spark):
    data = [("a", f"{i:02d}", [1, 0.01 * i]) for i in range(9)] + [("a", "odd", [-1, 1])]
    got = {r["item_id"]: r["is_outlier"] for r in O.outliers(frame(spark, data)).collect()}
    assert got["odd"] and sum(got.values()) == 1
    df = frame(spark, data)
    cents = O.centroids(df)
    near = O.own_distances(df, cents).select("item_id", F.round("distance", 9))
    far = O.own_distances(df, cents, max_bytes=1).select("item_id", F.round("distance", 9))
    assert rows(near) == rows(far)


def test_zero_shot_margin_and_ties(spark):
    protos = spark.createDataFrame(
        [("good", [1.0, 0.0, 0.0]), ("x", [0.0, 1.0, 0.0]), ("y", [0.0, 1.0, 0.0])],
        "category string, embedding array<double>",
    )
    df = frame(spark, [("a", "good", [1, 0, 0]), ("a", "neg", [0, 1, 0]), ("a", "near", [1, 1.001, 0])])
    got = {r["item_id"]: r for r in O.zero_shot(df, protos, ["good", "x", "y"]).collect()}
    assert [got[i]["category"] for i in ("good", "neg", "near")] == ["good", "x", "good"]
    assert abs(sum(got["neg"]["scores"].values()) - 1) < 1e-3
    with pytest.raises(ValueError):
        O.zero_shot(df, protos, ["good", "x", "z"])


def test_corrupted_counts_only_in_total(spark):
    items = spark.createDataFrame([("a", "1", 10), ("a", "2", 0)], "label string, item_id string, width int")
    classified = spark.createDataFrame(
        [("a", "1", "good", 0.2, {"good": 0.2})],
        "label string, item_id string, category string, confidence double, scores map<string,double>",
    )
    summary = O.category_summary(O.with_corrupted(classified, items)).first()
    assert summary["total"] == 2 and summary["good"] == 1 and summary["poor_quality"] == 0


@pytest.mark.parametrize("tile", [4, 1000])
def test_near_pairs_equal_brute_force(spark, tile):
    data = clustered()
    unit = {i: v / np.linalg.norm(v) for _, i, v in ((l, i, np.float32(v).astype(float)) for l, i, v in data)}
    want = sorted(
        (l1, a, b) for l1, a, _ in data for l2, b, _ in data
        if l1 == l2 and a < b and unit[a] @ unit[b] > 0.85
    )
    got = O.near_pairs(frame(spark, data), 0.85, tile=tile).select("label", "item_a", "item_b")
    assert rows(got) == want and want


def test_copies_collapse_to_the_best(spark):
    data = [("a", f"{i:02d}", [1, 2, 3]) for i in range(30)] + [("a", "x", [3, -1, 0]), ("b", "00", [1, 2, 3])]
    df = frame(spark, data)
    scores = df.select("label", "item_id", F.when(F.col("item_id") == "17", 0.9).otherwise(0.1).alias("composite_score"))
    got = O.near_duplicates(df, scores, 0.95)
    assert {(r["kept"], r["similarity"]) for r in got.collect()} == {("17", 1.0)}
    assert got.count() == 29


def test_better_score_is_kept_and_ties_go_to_the_smaller_name(spark):
    df = frame(spark, [("a", "p", [1, 0]), ("a", "q", [1, 0.001]), ("b", "r", [1, 0]), ("b", "s", [1, 0.001])])
    scores = spark.createDataFrame(
        [("a", "p", 0.3), ("a", "q", 0.8)], "label string, item_id string, composite_score double"
    )
    got = O.near_duplicates(df, scores, 0.95).select("label", "kept", "removed")
    assert rows(got) == [("a", "q", "p"), ("b", "r", "s")]


def greedy(pairs, score):
    gone, out = set(), []
    for a, b, s in sorted(pairs, key=lambda p: (-p[2], p[0], p[1])):
        if a in gone and b in gone:
            continue
        if a in gone or b in gone:
            lost = a if a in gone else b
        else:
            lost = a if score[b] > score[a] else b
            gone.add(lost)
        out.append((b if lost == a else a, lost))
    return sorted(out)


@pytest.mark.parametrize("local_pairs", [0, 10**6])
def test_rounds_and_local_walk_equal_greedy(spark, local_pairs):
    rng = np.random.default_rng(5)
    pairs = [(f"{a:02d}", f"{b:02d}", float(rng.integers(1, 6)) / 10)
             for a in range(14) for b in range(a + 1, 14) if rng.random() < 0.4]
    score = {f"{i:02d}": float(rng.integers(0, 4)) for i in range(14)}
    p = spark.createDataFrame([("a", *x) for x in pairs], "label string, item_a string, item_b string, similarity double")
    s = spark.createDataFrame([("a", k, v) for k, v in score.items()], "label string, item_id string, composite_score double")
    got = O.resolve_duplicates(p, s, local_pairs=local_pairs).select("kept", "removed")
    assert rows(got) == greedy(pairs, score)


def test_a_hub_and_a_chain_need_few_stretches(spark, monkeypatch):
    # A chain: every pair waits for the one before it, so rounds of first pairs took one round each.
    chain = [(f"c{i:03d}", f"c{i + 1:03d}", 0.9 - i / 1000) for i in range(60)]
    hub = [("a000", f"h{i:03d}", 0.5 - i / 1000) for i in range(60)]
    names = sorted({x for p in chain + hub for x in p[:2]})
    score = {x: float(x != "a000") * 0.5 + i % 7 / 20 for i, x in enumerate(names)}
    p = spark.createDataFrame(
        [(g, *x) for g in "ab" for x in (chain + hub if g == "a" else chain[:9])],
        "label string, item_a string, item_b string, similarity double",
    )
    s = spark.createDataFrame([(g, k, v) for g in "ab" for k, v in score.items()], "label string, item_id string, composite_score double")
    walks, ends = [], O._stretch_ends
    monkeypatch.setattr(O, "_stretch_ends", lambda *a: walks.append(1) or ends(*a))
    got = O.resolve_duplicates(p, s, local_pairs=5, stretch=40)
    assert rows(got.filter("label = 'a'").select("kept", "removed")) == greedy(chain + hub, score)
    assert rows(got.filter("label = 'b'").select("kept", "removed")) == greedy(chain[:9], score)
    assert len(walks) <= 4


def test_stretches_of_one_pair_equal_greedy(spark):
    rng = np.random.default_rng(6)
    pairs = [(a, b, float(rng.integers(1, 4)) / 10) for a in range(9) for b in range(a + 1, 9) if rng.random() < 0.5]
    score = {i: float(rng.integers(0, 3)) for i in range(9)}
    p = spark.createDataFrame([(0, *x) for x in pairs], "label int, item_a bigint, item_b bigint, similarity double")
    s = spark.createDataFrame([(0, k, v) for k, v in score.items()], "label int, item_id bigint, composite_score double")
    got = O.resolve_duplicates(p, s, local_pairs=0, stretch=4).select("kept", "removed")
    assert rows(got) == greedy(pairs, score)


def test_mislabel_blocks_equal_one_block(spark):
    data = clustered(labels=6, dim=8)
    data[0] = ("l0", data[0][1], np.eye(8)[1] * 2)
    df = frame(spark, data)
    whole = O.mislabeled(df)
    blocked = O.mislabeled(df, max_bytes=3 * 8 * 8)
    assert rows(whole) == rows(blocked)
    found = [(r["item_id"], r["nearest_label"]) for r in whole.filter("suspected").collect()]
    assert found == [("l0_000", "l1")]
    totals = {r["label"]: r["suspected_count"] for r in O.mislabel_summary(whole).collect()}
    assert totals == {"l0": 1, None: 1}


def test_mislabel_needs_two_labels(spark):
    assert O.mislabeled(frame(spark, [("a", "1", [1, 0]), ("a", "2", [0, 1])])).count() == 0


def test_encode_batches(spark):
    df = spark.range(10).select(F.lit("a").alias("label"), F.col("id").alias("item_id"), F.col("id").cast("double").alias("p"))
    sizes = lambda s: np.stack([s, np.full(len(s), len(s))], axis=1)
    got = O.encode(df.coalesce(1), sizes, "p", batch_size=4).orderBy("item_id").collect()
    assert [r["embedding"] for r in got][0] == [0.0, 4.0] and got[9]["embedding"] == [9.0, 2.0]


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_near_pairs_of_whole_number_ids_need_no_objects(spark, kind):
    assert O._plain(pa.chunked_array([pa.array([3, 1], pa.int64())])).dtype == np.int64
    assert O._plain(pa.chunked_array([pa.array([3, None], pa.int64())])).tolist() == [3, None]
    data = clustered(labels=2, each=10)
    typed = frame(spark, data).withColumn("item_id", F.substring("item_id", 4, 3).cast(kind))
    unit = {(l, int(i[-3:])): v / np.linalg.norm(v) for l, i, v in data}
    expected = {
        (l, a, b) for l, a in unit for m, b in unit if l == m and a < b and unit[l, a] @ unit[m, b] > 0.8
    }
    found = O.near_pairs(typed, 0.8, tile=4)
    assert found.schema["item_a"].dataType == typed.schema["item_id"].dataType
    assert {(r["label"], int(r["item_a"]), int(r["item_b"])) for r in found.collect()} == expected
