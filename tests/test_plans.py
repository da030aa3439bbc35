"""Skew-safe helpers against plain windows."""

import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.functions.hashing import shuffle_key
from corpusmill.functions.numeric import round_to
from corpusmill.plans.ranking import hash_rank, range_rank, top_n
from corpusmill.plans.running import running
from corpusmill.plans.sizing import join_small, small_table


def skewed(spark, n=3000):
    """Half of all rows in one group."""
    return spark.range(n).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 37)).alias("label"),
        F.col("id").alias("item_id"),
        (F.col("id") * 7919 % 101 / 101).alias("score"),
    )


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_top_n_equals_window(spark):
    df = skewed(spark)
    order = [F.col("score"), F.col("item_id")]
    plain = df.withColumn("rn", F.row_number().over(W.partitionBy("label").orderBy(*order))).filter("rn <= 9")
    assert rows(top_n(df, ["label"], order, 9)) == rows(plain)


def test_top_n_quota(spark):
    df = skewed(spark).withColumn("q", F.when(F.col("label") == "hot", 11).otherwise(2))
    got = top_n(df, ["label"], [F.col("item_id")], 11, "q").groupBy("label").count()
    counts = dict(rows(got))
    assert counts.pop("hot") == 11 and set(counts.values()) == {2}


def test_hash_rank_equals_window(spark):
    df = skewed(spark)
    w = W.partitionBy("label").orderBy(shuffle_key(F.col("item_id")), "item_id")
    plain = df.withColumn("rn", F.row_number().over(w)).withColumn("n", F.count("*").over(W.partitionBy("label")))
    for bucket_rows in (5, 100, 10**6):
        got = hash_rank(df, ["label"], "item_id", bucket_rows=bucket_rows).select(*plain.columns)
        assert rows(got) == rows(plain)


def test_hash_rank_survives_repartitioning(spark):
    df = skewed(spark, 500)
    assert rows(hash_rank(df.repartition(7), ["label"], "item_id")) == rows(hash_rank(df, ["label"], "item_id"))


def test_range_rank_equals_window(spark):
    df = skewed(spark).repartition(5)
    order = [F.col("score"), F.col("item_id")]
    grouped = df.withColumn("rn", F.row_number().over(W.partitionBy("label").orderBy(*order)))
    assert rows(range_rank(df, ["label"], order)) == rows(grouped)
    whole = df.withColumn("rn", F.row_number().over(W.partitionBy(F.lit(1)).orderBy("label", *order)))
    assert rows(range_rank(df, [], [F.col("label"), *order])) == rows(whole)


def test_range_rank_over_many_partitions(spark):
    """Without coalescing, a dominant group really spans several range partitions."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        df = skewed(spark).repartition(5)
        order = [F.col("score"), F.col("item_id")]
        ranged = df.repartitionByRange("label", *order).filter("label = 'hot'").select(F.spark_partition_id().alias("p"))
        assert ranged.distinct().count() > 1
        plain = df.withColumn("rn", F.row_number().over(W.partitionBy("label").orderBy(*order)))
        assert rows(range_rank(df, ["label"], order)) == rows(plain)
        top = plain.filter("rn <= 9")
        assert rows(top_n(df, ["label"], order, 9, salts=2)) == rows(top)
    finally:
        spark.conf.unset(key)


def test_ranks_without_broadcast(spark, monkeypatch):
    from functools import partial

    from corpusmill.plans import ranking

    df = skewed(spark, 800)
    want = rows(hash_rank(df, ["label"], "item_id", bucket_rows=20))
    want_range = rows(range_rank(df, ["label"], [F.col("score"), F.col("item_id")]))
    monkeypatch.setattr(ranking, "join_small", partial(join_small, max_bytes=8))
    monkeypatch.setattr(ranking, "small_table", partial(small_table, max_bytes=8))
    assert rows(hash_rank(df, ["label"], "item_id", bucket_rows=20)) == want
    assert rows(range_rank(df, ["label"], [F.col("score"), F.col("item_id")])) == want_range


def test_running_equals_window(spark):
    random.seed(3)
    data = [(g, i, random.random()) for g in "ab" for i in range(40)]
    df = spark.createDataFrame(data, "run string, epoch int, v double")
    w = W.partitionBy("run").orderBy("epoch")
    plain = df.select("*", F.min("v").over(w).alias("lo"), F.sum("v").over(w).alias("total"))
    got = running(df, ["run"], "epoch", {"lo": ("min", F.col("v")), "total": ("sum", F.col("v"))}, chunk=7)
    for a, b in zip(rows(got), rows(plain)):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-9


def test_small_table_limit(spark):
    df = spark.range(100)
    assert small_table(df)[1] and not small_table(df, max_bytes=400)[1]
    big = skewed(spark)
    side = big.groupBy("label").count()
    assert rows(join_small(big, side, ["label"])) == rows(join_small(big, side, ["label"], max_bytes=8))


def test_round_matches_python(spark):
    values = [2.675, 1.005, 69.195, 481.745, 0.03125, 40.15625, 0.5, 1.5, -2.675] + [i / 32 for i in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1, 2, 4):
        assert [r[0] for r in df.select(round_to(F.col("v"), digits)).collect()] == [float(round(v, digits)) for v in values]


def test_top_n_beyond_the_engine_limit(spark):
    """No row beyond n of a partition's group reaches a shuffle, whatever n is."""
    df = spark.range(0, 40_000, 1, 4).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("g"), (F.col("id") * 7919 % 40_009).alias("v")
    )
    from corpusmill.plans import ranking

    for n in (3, 1500):
        got = {(r["g"], r["rn"], r["v"]) for r in ranking.top_n(df, ["g"], [F.col("v")], n).collect()}
        want = set()
        for g, values in (("hot", []), ("cold", [])):
            values = sorted(r["v"] for r in df.filter(F.col("g") == g).collect())[:n]
            want |= {(g, i + 1, v) for i, v in enumerate(values)}
        assert got == want
    first = ranking._first_of_partitions(df, ["g"], [F.col("v")], 1500)
    assert first.count() == 4 * 1500 + 4 * 1000
    plan = ranking.top_n(df, ["g"], [F.col("v")], 5000)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") > plan.rindex("Exchange")


def test_ship_sends_the_package(spark, tmp_path):
    """A vector query of a process that stands elsewhere and whose workers can't see the folder."""
    import os
    import subprocess
    import sys

    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {top!r})\n"
        "import __spark_entry__ as e\n"
        "from corpusmill.session import get_session\n"
        "s = get_session('local[2]', 'elsewhere', 2, '1g')\n"
        "print('rows', e.queries()['label_centroids'](s, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 640" in done.stdout, done.stderr[-2000:]
