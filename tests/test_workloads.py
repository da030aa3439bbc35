"""Registered queries: contract, a few oracles, and the streams."""

import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import connect, rows_of  # noqa: E402

from corpusmill.workloads import all_oracles, all_queries  # noqa: E402

SF = "/root/testdata/sf0.001"
SAMPLE = ("zero_shot_categories", "duplicate_resolution", "priority_fill", "retry_merge", "quality_scores",
          "verdict_capped", "review_pages", "merged_annotations", "balanced_resample", "early_stops",
          "streamed_categories", "streamed_top_classes")
NAMES = sorted(entry.queries()) if os.environ.get("ALL_ORACLES") else SAMPLE

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["label", "item_id", "distance", "is_outlier"]


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, name):
    df = entry.queries()[name](spark, SF)
    cursor = connect(SF).execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cursor.fetchall())


def test_stream_resumes_with_new_files_only(spark, tmp_path):
    from pyspark.sql import functions as F

    from corpusmill.functions.constants import CATEGORIES
    from corpusmill.streaming.incremental import finished_labels, stream_report, vector_stream

    axes = [[1.0 if i == k else 0.0 for i in range(6)] for k in range(6)]
    protos = spark.createDataFrame(list(zip(CATEGORIES, axes)), "category string, embedding array<double>")
    source, sink, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    schema = "label string, item_id string, embedding array<float>"
    for step, label in enumerate(("a", "b")):
        spark.createDataFrame([(label, f"{label}{k}", axes[k]) for k in range(3)], schema).coalesce(1).write.mode("append").parquet(source)
        stream = vector_stream(spark, source, spark.read.parquet(source).schema)
        report = stream_report(stream, protos, sink, state, enrich=lambda df: df.withColumn("seen", F.lit(True)))
        assert report.count() == 3 * (step + 1)
    assert {r["label"]: r["items"] for r in finished_labels(report).collect()} == {"a": 3, "b": 3}
    assert report.filter("category = 'good'").count() == 2


@pytest.mark.parametrize("query, rows", [("streamed_categories", 120), ("streamed_top_classes", 600)])
def test_streams_of_a_table_in_several_files(spark, tmp_path, query, rows):
    data = np.random.default_rng(5).normal(size=(120, 8))
    vecs = spark.createDataFrame([(i, [float(x) for x in v], i % 6) for i, v in enumerate(data)], "vec_id bigint, embedding array<float>, label int")
    vecs.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    nations = spark.createDataFrame([(i, f"N{i}", i % 5) for i in range(8)], "n_nationkey int, n_name string, n_regionkey int")
    nations.write.parquet(f"{tmp_path}/nation.parquet")
    got = all_queries()[query](spark, str(tmp_path))
    assert got.count() == rows and got.select("item_id").distinct().count() == 120
