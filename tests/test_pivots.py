"""The pivot index against brute force, and what it leaves to compare."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import pivots as P
from corpusmill.operators import vectors as O

SCHEMA = "label string, item_id string, embedding array<float>"


def frame(spark, data):
    return spark.createDataFrame([(l, i, [float(x) for x in v]) for l, i, v in data], SCHEMA)


def clusters(n, centres, dim, noise, seed=0, label="a"):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    middle /= np.linalg.norm(middle, axis=1)[:, None]
    return [(label, f"{label}{i:05d}", middle[i % centres] + rng.normal(0, noise, dim)) for i in range(n)]


def brute(data, threshold):
    found = []
    for label in {l for l, _, _ in data}:
        ids = [i for l, i, _ in data if l == label]
        rows = np.array([np.float32(v) for l, _, v in data if l == label], float)
        rows /= np.linalg.norm(rows, axis=1)[:, None]
        for a, b in zip(*np.nonzero(np.triu(rows @ rows.T > threshold, 1)), strict=True):
            found.append((label, *sorted((ids[a], ids[b]))))
    return sorted(found)


def pairs_of(df):
    return sorted(tuple(r) for r in df.select("label", "item_a", "item_b").collect())


def test_clusters_leave_few_comparisons(spark):
    data = clusters(1500, 30, 16, 0.04) + clusters(200, 4, 16, 0.04, 1, "b") + clusters(1, 1, 16, 0.04, 2, "c")
    df = frame(spark, data)
    want = brute(data, 0.95)
    assert len(want) > 1000
    assert pairs_of(P.pruned_pairs(df, 0.95, tile=32)) == want
    left = P.tile_pairs(P.pivot_tiles(df, tile=32), 0.95)
    compared = {r["label"]: r["compared"] for r in P.comparisons(left).collect()}
    print("compared", compared, "of", 1500 * 1499 // 2, 200 * 199 // 2)
    assert compared["a"] < 1500 * 1499 // 4


@pytest.mark.parametrize("threshold", [0.3, -0.5, 0.999])
def test_vectors_without_structure_lose_no_pair(spark, threshold):
    rng = np.random.default_rng(3)
    data = [("a", f"{i:03d}", rng.normal(size=6)) for i in range(150)]
    got = P.pruned_pairs(frame(spark, data), threshold, tile=8, pivots=5)
    assert pairs_of(got) == brute(data, threshold)


def test_a_crowded_angle_is_dealt_to_tiles_of_bounded_size(spark):
    data = clusters(400, 1, 8, 1e-5)
    tiles = P.pivot_tiles(frame(spark, data), pivots=3, tile=16)
    sizes = [r["n"] for r in tiles.groupBy("_tile").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 400 and len(sizes) > 10
    assert pairs_of(P.pruned_pairs(frame(spark, data), 0.95, tile=64)) == brute(data, 0.95)


def test_nulls_zeros_and_empty_tables(spark):
    df = frame(spark, [("a", "1", [1, 0]), ("a", "2", [1, 0.01]), ("a", "3", [0, 0]), ("a", "4", [float("nan"), 1])])
    df = df.unionByName(df.limit(1).select("label", F.lit("5").alias("item_id"), F.lit(None).cast("array<float>").alias("embedding")))
    assert pairs_of(P.pruned_pairs(df)) == [("a", "1", "2")]
    assert P.pruned_pairs(df.filter("false")).count() == 0


def test_resolution_is_the_same_through_the_index(spark):
    df = frame(spark, clusters(120, 6, 8, 0.1))
    one = O.near_duplicates(df, threshold=0.9)
    two = O.near_duplicates(df, threshold=0.9, find=P.pruned_pairs)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
