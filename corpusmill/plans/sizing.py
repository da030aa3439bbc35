"""Size-checked broadcasts.

A table is broadcast only after its rows have been counted against a byte
budget. Past the budget the same join runs as a shuffle join, where adaptive
execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20
ARRAY_WIDTH = 8192
STRING_WIDTH = 48


def row_width(schema: T.StructType) -> int:
    """Rough bytes per row, used to bound how much the check may fetch."""
    width = 0
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            width += row_width(field.dataType)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType)):
            width += ARRAY_WIDTH
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width += STRING_WIDTH
        else:
            width += 8
    return max(width, 8)


def small_table(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """A local copy and True when ``df`` fits the budget, else ``df`` and False."""
    limit = max(1, max_bytes // row_width(df.schema))
    table = df.limit(limit + 1).toArrow()
    if table.num_rows > limit or table.nbytes > max_bytes:
        return df, False
    return df.sparkSession.createDataFrame(table, schema=df.schema), True


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a label-sized table to a large one: broadcast if it fits, else shuffle."""
    local, fits = small_table(small, max_bytes)
    side = F.broadcast(local) if fits else local
    return big.join(side, list(on), how)
