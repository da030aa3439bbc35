"""Vector columns: JVM expressions and Arrow-batched matrix products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.numeric import with_scalar

# Upper bound on the entries of one product matrix inside a task.
BLOCK_ENTRIES = 1 << 22


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x))


def l2_normalise(vector: Column) -> Column:
    """v / |v| in double precision."""
    return with_scalar(vector, norm(vector), lambda x, length: x.cast("double") / length)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def matrix(array: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """An Arrow list array of equal lengths as a (rows, dim) float64 matrix."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if len(array) == 0:
        return np.zeros((0, 0))
    if array.null_count:
        raise ValueError("null vectors must be filtered out first")
    flat = np.asarray(array.flatten(), dtype=np.float64)
    lengths = np.diff(np.asarray(array.offsets))
    if (lengths != lengths[0]).any():
        raise ValueError("vectors of different lengths")
    return flat.reshape(len(array), int(lengths[0]))


def unit_rows(rows: np.ndarray) -> np.ndarray:
    lengths = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    with np.errstate(divide="ignore", invalid="ignore"):
        return rows / lengths[:, None]


def blocks(n_rows: int, width: int):
    """Row ranges whose product with ``width`` columns stays bounded."""
    step = max(1, BLOCK_ENTRIES // max(1, width))
    for start in range(0, n_rows, step):
        yield slice(start, min(start + step, n_rows))


def to_lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    offsets = pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1)))


def similarities(vector: Column, packed: Broadcast) -> Column:
    """Cosine of a vector to every row of a broadcast unit matrix, array<double>."""

    @F.arrow_udf("array<double>")
    def product(vectors: pa.Array) -> pa.Array:
        reference = packed.value
        if len(vectors) == 0:
            return pa.array([], pa.list_(pa.float64()))
        return to_lists(unit_rows(matrix(vectors)) @ reference.T)

    return product(vector)


def own_distance(vector: Column, index: Column, packed: Broadcast) -> Column:
    """1 - cosine to the matrix row numbered ``index``."""

    @F.arrow_udf("double")
    def distance(vectors: pa.Array, indexes: pa.Array) -> pa.Array:
        if len(vectors) == 0:
            return pa.array([], pa.float64())
        own = packed.value[np.asarray(indexes, dtype=np.int64)]
        return pa.array(1.0 - np.einsum("ij,ij->i", unit_rows(matrix(vectors)), own))

    return distance(vector, index)


def pair_distance(a: Column, b: Column) -> Column:
    """1 - cosine of two vector columns."""

    @F.arrow_udf("double")
    def distance(left: pa.Array, right: pa.Array) -> pa.Array:
        if len(left) == 0:
            return pa.array([], pa.float64())
        return pa.array(1.0 - np.einsum("ij,ij->i", unit_rows(matrix(left)), unit_rows(matrix(right))))

    return distance(a, b)


def nearest_other(vector: Column, index: Column, packed: Broadcast) -> Column:
    """[row number, distance] of the nearest other matrix row, and the own distance.

    ``index`` is the vector's own row; -1 means that it is not in this matrix,
    and the own distance is then -inf. Ties go to the smallest row number.
    """

    @F.arrow_udf("array<double>")
    def nearest(vectors: pa.Array, indexes: pa.Array) -> pa.Array:
        reference = packed.value
        if len(vectors) == 0:
            return pa.array([], pa.list_(pa.float64()))
        rows = unit_rows(matrix(vectors))
        own = np.asarray(indexes, dtype=np.int64)
        out = np.full((len(rows), 3), -np.inf)
        for part in blocks(len(rows), len(reference)):
            distance = 1.0 - rows[part] @ reference.T
            here = own[part]
            mine = np.nonzero(here >= 0)[0]
            out[part.start + mine, 2] = distance[mine, here[mine]]
            distance[mine, here[mine]] = np.inf
            best = distance.argmin(axis=1)
            out[part, 0] = best
            out[part, 1] = distance[np.arange(len(best)), best]
        return to_lists(out)

    return nearest(vector, index)
