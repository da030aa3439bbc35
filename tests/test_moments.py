"""The mergeable state of labels against the batch operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import vectors as O
from corpusmill.streaming import moments as M

SCHEMA = "label string, item_id string, embedding array<float>"


@pytest.fixture(scope="module")
def items(spark):
    rng = np.random.default_rng(11)
    data = [(f"l{i % 4}", f"{i:04d}", (np.eye(8)[i % 4] + rng.normal(0, 0.3, 8)).tolist()) for i in range(240)]
    data += [("two", "x1", [1.0] * 8), ("two", "x2", [1.0] * 7 + [0.0])]
    return spark.createDataFrame(data, SCHEMA).cache()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def files(items, folder):
    """Three files, one batch each."""
    for k in range(3):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(3)) == k)
        part.coalesce(1).write.mode("append").parquet(folder)


def test_batches_add_up_to_the_batch_query(spark, items, tmp_path):
    files(items, f"{tmp_path}/in")
    stream = spark.readStream.schema(items.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    known = M.follow(stream, f"{tmp_path}/out", f"{tmp_path}/state")
    assert spark.read.parquet(f"{tmp_path}/out/state").select("version").distinct().count() == 3
    want = O.outliers(items)
    assert any(r[3] for r in rows(want))
    assert rows(M.outliers_by_state(items, known)) == rows(want)
    cents = known.select("label", "n", "centroid")
    assert rows(O.mislabeled(items, cents=cents)) == rows(O.mislabeled(items))
    assert spark.read.parquet(f"{tmp_path}/out/outliers").count() == items.count()
    # Nothing new: the next run leaves all as it is.
    again = M.follow(stream, f"{tmp_path}/out", f"{tmp_path}/state")
    assert rows(again.select("label", "n")) == rows(known.select("label", "n"))


def test_a_replayed_batch_changes_nothing(spark, items, tmp_path):
    first, second = items.filter("item_id < '0100'"), items.filter("item_id >= '0100'")
    M.update_state(first, 0, str(tmp_path))
    once = rows(M.limits(M.update_state(second, 1, str(tmp_path))).select("label", "n", F.round("limit", 9)))
    twice = rows(M.limits(M.update_state(second, 1, str(tmp_path))).select("label", "n", F.round("limit", 9)))
    assert once == twice
    assert rows(M.limits(M.latest_state(spark, str(tmp_path))).select("label", "n")) == [r[:2] for r in once]


def test_partials_flush_within_their_budget(spark, items, monkeypatch):
    whole = rows(M.limits(M.merged(M.moments(items))).select("label", "n", F.round("limit", 9)))
    monkeypatch.setattr(M, "HELD_BYTES", 1)
    small = rows(M.limits(M.merged(M.moments(items))).select("label", "n", F.round("limit", 9)))
    assert whole == small


def test_nulls_and_empty_batches(spark, items, tmp_path):
    nulls = items.limit(2).withColumn("embedding", F.lit(None).cast("array<float>"))
    M.update_state(items.unionByName(nulls), 0, str(tmp_path))
    known = M.limits(M.update_state(items.filter("false"), 1, str(tmp_path)))
    assert rows(M.outliers_by_state(items, known)) == rows(O.outliers(items))
