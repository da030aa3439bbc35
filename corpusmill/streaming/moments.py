"""Outliers and mislabels that follow new items through a mergeable state per label.

The state of a label is the number of its unit vectors, their sum and the sum of
their outer products. States of disjoint sets add up. The centroid follows from
the sum, and the mean and deviation of all distances to it from both sums:
with c the centroid, a cosine's mean is sum.c / n and its mean square c'Mc / n.
So the outlier limit of a label moves with every batch without a look at an earlier vector.

Version k of the state is version k-1 plus batch k, in a folder of its own that a
replay overwrites. A label takes dim * (dim + 1) numbers. Null vectors are left
out. The variance is a difference of two sums: for labels whose distances all lie within
1e-7 of each other the limit is not reliable.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusmill.functions import vectors as V
from corpusmill.functions.numeric import round_to
from corpusmill.operators import vectors as O
from corpusmill.plans.sizing import join_small

HELD_BYTES = 64 << 20


def _schema(vectors: DataFrame, group: Sequence[str]) -> T.StructType:
    return T.StructType(
        [*[vectors.schema[c] for c in group], T.StructField("n", T.LongType()),
         T.StructField("total", T.ArrayType(T.DoubleType()))]
    )


def _partial_moments(schema: pa.Schema, group: Sequence[str], vector: str):
    """Arrow mapper: n and [sum, outer products] per group inside a partition."""

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def flush() -> pa.RecordBatch:
            rows = [dict(zip(group, key)) | {"n": n, "total": total.tolist()} for key, (n, total) in held.items()]
            held.clear()
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = V.unit_rows(V.matrix(batch.column(batch.schema.get_field_index(vector))))
            at_most = max(1, HELD_BYTES // (8 * rows.shape[1] * (rows.shape[1] + 1)))
            places: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in group))):
                places.setdefault(key, []).append(i)
            for key, index in places.items():
                own = rows[index]
                total = np.concatenate((own.sum(axis=0), (own.T @ own).reshape(-1)))
                if key in held:
                    held[key][0] += len(index)
                    held[key][1] += total
                else:
                    held[key] = [len(index), total]
                if len(held) >= at_most:
                    yield flush()
        if held:
            yield flush()

    return mapper


def moments(vectors: DataFrame, group: Sequence[str] = ("label",), vector: str = "embedding") -> DataFrame:
    """Partial states ``(*group, n, total)`` of the vectors, at least one for each partition and group."""
    out = _schema(vectors, group)
    present = vectors.filter(F.col(vector).isNotNull()).select(*group, vector)
    return present.mapInArrow(_partial_moments(to_arrow_schema(out), list(group), vector), out)


def merged(partial: DataFrame, group: Sequence[str] = ("label",), salts: int = O.SUM_SALTS) -> DataFrame:
    """One state per group, added up in two steps so that a dominant group is dealt ``salts`` ways."""
    out = partial.schema
    salted = T.StructType([*out.fields, T.StructField("_salt", T.IntegerType())])
    halves = (
        partial.withColumn("_salt", F.spark_partition_id() % salts)
        .groupBy(*group, "_salt")
        .applyInArrow(O._added(to_arrow_schema(salted), [*group, "_salt"]), salted)
    )
    return halves.drop("_salt").groupBy(*group).applyInArrow(O._added(to_arrow_schema(out), group), out)


def update_state(
    batch: DataFrame, batch_id: int, path: str, group: Sequence[str] = ("label",), vector: str = "embedding"
) -> DataFrame:
    """Write version ``batch_id``: the version before it and the batch; running it again changes nothing."""
    partial = moments(batch, group, vector)
    if batch_id > 0:
        before = batch.sparkSession.read.schema(partial.schema).parquet(f"{path}/version={batch_id - 1}")
        partial = partial.unionByName(before)
    merged(partial, group).write.mode("overwrite").parquet(f"{path}/version={batch_id}")
    return batch.sparkSession.read.schema(partial.schema).parquet(f"{path}/version={batch_id}")


def latest_state(spark: SparkSession, path: str) -> DataFrame:
    every = spark.read.parquet(path)
    last = every.agg(F.max("version")).first()[0]
    return every.filter(F.col("version") == last).drop("version")


def _limits(schema: pa.Schema, sigma: float):
    """Arrow mapper: centroid and outlier limit of a state."""

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centres, limits = [], []
            numbers = batch.column(batch.schema.get_field_index("n")).to_pylist()
            for n, total in zip(numbers, batch.column(batch.schema.get_field_index("total"))):
                values = np.asarray(total.values)
                dim = int(np.sqrt(len(values)))  # dim * (dim + 1) numbers
                first, second = values[:dim], values[dim:].reshape(dim, dim)
                centre = first / np.sqrt(first @ first)
                mean = first @ centre / n
                spread = np.sqrt(max(0.0, centre @ second @ centre / n - mean * mean))
                centres.append(centre.tolist())
                limits.append(1.0 - mean + sigma * spread)
            keys = [batch.column(batch.schema.get_field_index(name)) for name in schema.names[:-3]]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(numbers, pa.int64()), pa.array(centres, pa.list_(pa.float64())),
                 pa.array(limits, pa.float64())], schema=schema,
            )

    return mapper


def limits(state: DataFrame, sigma: float = 1.5, group: Sequence[str] = ("label",)) -> DataFrame:
    """``(*group, n, centroid, limit)`` of every group."""
    out = T.StructType(
        [*[state.schema[c] for c in group], T.StructField("n", T.LongType()),
         T.StructField("centroid", T.ArrayType(T.DoubleType())), T.StructField("limit", T.DoubleType())]
    )
    return state.select(*group, "n", "total").mapInArrow(_limits(to_arrow_schema(out), float(sigma)), out)


def outliers_by_state(
    vectors: DataFrame,
    known: DataFrame,
    min_items: int = 3,
    group: Sequence[str] = ("label",),
    item: str = "item_id",
    vector: str = "embedding",
) -> DataFrame:
    """The rows of ``operators.vectors.outliers`` for these vectors, from ``limits``, in one map-only pass."""
    far = O.own_distances(vectors, known, group, vector).select(*group, item, "distance")
    enough = F.col("n") >= min_items
    return join_small(far, known.select(*group, "n", "limit"), group).select(
        *group,
        item,
        F.when(enough, round_to(F.col("distance"), 4)).otherwise(F.lit(0.0)).alias("distance"),
        (enough & (F.col("distance") > F.col("limit"))).alias("is_outlier"),
    )


def follow(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    sigma: float = 1.5,
    margin: float = 0.1,
    label: str = "label",
    item: str = "item_id",
    vector: str = "embedding",
) -> DataFrame:
    """Keep the state up to date with a stream and report new items against it; returns ``limits`` of the last version.

    Below ``path``: ``state`` (versions), and per batch ``outliers`` and
    ``mislabels`` of its items as the state was then. Centroids move as items
    arrive: rows for all items under the last state come from
    :func:`outliers_by_state` and from ``mislabeled`` with these centroids.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        known = limits(update_state(batch, batch_id, f"{path}/state", (label,), vector), sigma, (label,))
        flagged = outliers_by_state(batch, known, 3, (label,), item, vector)
        flagged.write.mode("overwrite").parquet(f"{path}/outliers/batch={batch_id}")
        suspects = O.mislabeled(batch, margin, label, item, vector, cents=known.select(label, "n", "centroid"))
        suspects.write.mode("overwrite").parquet(f"{path}/mislabels/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return limits(latest_state(stream.sparkSession, f"{path}/state"), sigma, (label,))
