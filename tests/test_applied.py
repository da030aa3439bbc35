"""One-pass apply: totals, sides, and a failed run."""

import pytest
from pyspark.sql import functions as F

from corpusmill.sources import applied as A


def verdicts(spark, n=100):
    return spark.range(n, numPartitions=4).select(
        F.concat(F.lit("l"), F.col("id") % 3).alias("label"), F.col("id").alias("item_id"),
        F.when(F.col("id") != 7, F.col("id") % 5 == 0).alias("removed"),
    )


def ids(df):
    return sorted(r["item_id"] for r in df.select("item_id").collect())


def test_both_sides_and_totals_come_from_one_pass(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = verdicts(spark)
    assert A.publish(rows.mapInArrow(count, rows.schema), str(tmp_path)) == (80, 20)
    assert seen.value == 100
    assert ids(A.read_published(spark, str(tmp_path), "rejected")) == list(range(0, 100, 5))
    assert ids(A.read_published(spark, str(tmp_path))) == list(range(100))
    plan = A.read_published(spark, str(tmp_path), "kept")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(side" in plan


def test_a_failed_run_leaves_the_last_one(spark, tmp_path):
    A.publish(verdicts(spark), str(tmp_path))
    broken = verdicts(spark, 10).withColumn(
        "label", F.when(F.col("item_id") == 9, F.raise_error(F.lit("lost"))).otherwise(F.col("label"))
    )
    with pytest.raises(Exception, match="lost"):
        A.publish(broken, str(tmp_path))
    assert len(ids(A.read_published(spark, str(tmp_path)))) == 100
    assert A.publish(verdicts(spark, 10), str(tmp_path)) == (8, 2)
    assert ids(A.read_published(spark, str(tmp_path))) == list(range(10))
    log = A.published_runs(spark, str(tmp_path)).orderBy("sequence").collect()
    assert [(r["sequence"], r["kept"]) for r in log] == [(0, 80), (1, 8)]


def test_nothing_published_and_empty_sides(spark, tmp_path):
    with pytest.raises(ValueError):
        A.read_published(spark, str(tmp_path))
    assert A.publish(verdicts(spark).filter("item_id = 1"), str(tmp_path)) == (1, 0)
    assert ids(A.read_published(spark, str(tmp_path), "rejected")) == []
