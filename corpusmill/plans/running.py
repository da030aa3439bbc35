"""Running aggregates along an integer position, in bounded chunks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusmill.plans.sizing import join_small

CHUNK = 4096

# name of the aggregate -> (function over rows, merge of two partial values)
_MERGE: dict[str, tuple[Callable[[Column], Column], Callable[..., Column]]] = {
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
    "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
}


def running(
    df: DataFrame,
    group: Sequence[str],
    position: str,
    specs: Mapping[str, tuple[str, Column] | tuple[str, Column, bool]],
    chunk: int = CHUNK,
) -> DataFrame:
    """Add ``name: (aggregate, column)`` over the rows up to each position.

    A third element False stops one row earlier. Rows are cut into chunks of ``chunk`` positions; each chunk is summarised,
    the summaries are accumulated per group and handed to the rows, so no task
    walks a whole group.
    """
    chunked = df.withColumn("_chunk", F.floor(F.col(position) / F.lit(chunk)))
    for name, (_, value, *_flag) in specs.items():
        chunked = chunked.withColumn(f"_v_{name}", value)
    parts = chunked.groupBy(*group, "_chunk").agg(
        *[_MERGE[kind][0](F.col(f"_v_{name}")).alias(f"_p_{name}") for name, (kind, _value, *flag) in specs.items()]
    )
    earlier = W.partitionBy(*group).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = parts.select(
        *group,
        "_chunk",
        *[_MERGE[kind][0](F.col(f"_p_{name}")).over(earlier).alias(f"_c_{name}")
          for name, (kind, _value, *flag) in specs.items()],
    )
    inside = W.partitionBy(*group, "_chunk").orderBy(position)
    out = join_small(chunked, carried, [*group, "_chunk"])
    for name, (kind, _value, *flag) in specs.items():
        function, merge = _MERGE[kind]
        last = -1 if flag == [False] else 0
        here = function(F.col(f"_v_{name}")).over(inside.rowsBetween(W.unboundedPreceding, last))
        out = out.withColumn(name, merge(F.col(f"_c_{name}"), here))
    return out.drop("_chunk", *[f"_{p}_{name}" for name in specs for p in ("v", "c")])
