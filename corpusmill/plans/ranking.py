"""Ranks inside groups that stay parallel when one group dominates.

A plain ``row_number() over (partition by label)`` sorts a whole label in one
task. The three forms here bound what a single task receives:

* ``top_n``      - the first n rows of every group, through salted sub-groups;
* ``hash_rank``  - the full pseudo-random rank, through key-prefix buckets;
* ``range_rank`` - the full rank by any total order, through range partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusmill.functions.hashing import shuffle_key
from corpusmill.plans.lineage import cut
from corpusmill.plans.sizing import join_small, small_table

SALTS = 64
BUCKET_ROWS = 200_000
RANGE_ROWS = 2_000_000
ENGINE_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _first_of_partitions(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """At most n rows of a group from every partition, without a shuffle: a local sort and one pass."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = list(zip(*[batch.column(c).to_pylist() for c in group]))
            starts = np.array([keys[0] != last, *[a != b for a, b in zip(keys, keys[1:])]])
            at = np.arange(len(keys))
            begin = np.maximum.accumulate(np.where(starts, at, -1))
            place = np.where(begin < 0, at + seen, at - begin)
            last, seen = keys[-1], int(place[-1]) + 1
            yield batch.filter(pa.array(place < n))

    ordered = df.sortWithinPartitions(*[F.col(c) for c in group], *order)
    return ordered.mapInArrow(first, df.schema)


def top_n(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    n: int,
    quota: str | None = None,
    rank: str = "rn",
    salts: int = SALTS,
) -> DataFrame:
    """First ``n`` rows per group by a total order, with their rank.

    Every input partition keeps at most n rows of a group before any shuffle:
    by Spark's window group limit as far as its threshold goes, beyond it by a
    sorted pass that counts. The partitions are then merged in two steps,
    first ``salts`` ways, so the last task of a group receives at most
    ``salts * n`` rows however many partitions held it. ``quota`` names a
    column holding a smaller per-row limit; ``n`` must bound it.
    """
    keep = F.col(rank) <= n
    if quota is not None:
        keep = keep & (F.col(rank) <= F.col(quota))
    if n > int(df.sparkSession.conf.get(ENGINE_LIMIT, "1000")):
        df = _first_of_partitions(df, group, order, n)
    salted = df.withColumn("_salt", F.spark_partition_id() % salts)
    first = W.partitionBy(*group, "_salt").orderBy(*order)
    part = salted.withColumn(rank, F.row_number().over(first)).filter(keep).drop(rank, "_salt")
    final = W.partitionBy(*group).orderBy(*order)
    return part.withColumn(rank, F.row_number().over(final)).filter(keep)


def hash_rank(
    df: DataFrame,
    group: Sequence[str],
    item: str,
    seed: int | str = 42,
    rank: str = "rn",
    size: str = "n",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Seeded pseudo-random rank (from 1) and group size for every row.

    md5 digits are uniform, so a key prefix cuts a group into even buckets.
    The prefix grows with the group until a bucket holds at most about
    ``bucket_rows``; small groups are one bucket. Offsets are counted for the
    buckets of large groups only, and no task sorts more than a bucket.
    """
    digits = F.greatest(
        F.lit(0), F.ceil(F.log(F.col(size) / F.lit(float(bucket_rows))) / F.log(F.lit(16.0)))
    ).cast("int")
    sizes, _ = small_table(df.groupBy(*group).agg(F.count(F.lit(1)).alias(size)))
    sizes = sizes.withColumn("_digits", digits)
    keyed = (
        join_small(df, sizes, group)
        .withColumn("_key", shuffle_key(F.col(item), seed))
        .withColumn("_bucket", F.substr("_key", F.lit(1), F.col("_digits")))
    )
    inside = W.partitionBy(*group, "_bucket").orderBy("_key", item)
    if sizes.filter("_digits > 0").isEmpty():
        ranked = keyed.withColumn(rank, F.row_number().over(inside).cast("bigint"))
    else:
        counts = (
            keyed.filter("_digits > 0").groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_count"))
        )
        before = W.partitionBy(*group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
        offsets = counts.select(*group, "_bucket", F.sum("_count").over(before).alias("_offset"))
        ranked = (
            join_small(keyed, offsets, [*group, "_bucket"], "left")
            .withColumn(rank, F.coalesce("_offset", F.lit(0)) + F.row_number().over(inside))
            .drop("_offset")
        )
    return ranked.drop("_key", "_bucket", "_digits")


def range_rank(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    rank: str = "rn",
) -> DataFrame:
    """Rank (from 1) by a total order, through sampled range partitions.

    Range partitioning splits a dominant group over many partitions, of about
    ``RANGE_ROWS`` rows where the session's number would give larger ones. The
    partitions are written once, because their sampled bounds must not change
    between counting and ranking. An empty ``group`` ranks the whole table.
    """
    keys = list(group) or ["_all"]
    base = df if group else df.withColumn("_all", F.lit(0))
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // RANGE_ROWS))
    ranged = cut(
        base.repartitionByRange(parts, *[F.col(c) for c in keys], *order).withColumn(
            "_part", F.spark_partition_id()
        )
    )
    counts = ranged.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_count"))
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *keys, "_part", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_offset")
    )
    inside = W.partitionBy(*keys, "_part").orderBy(*order)
    ranked = (
        join_small(ranged, offsets, [*keys, "_part"])
        .withColumn(rank, F.col("_offset") + F.row_number().over(inside))
        .drop("_part", "_offset")
    )
    return ranked if group else ranked.drop("_all")
