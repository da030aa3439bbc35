"""Near pairs behind a pivot index: tiles too far apart are never compared.

The angle between vectors is a metric. If the angles of two vectors to a third,
a pivot, differ by some amount, the vectors are at least that far apart. Every
vector goes to the cell of its nearest pivot and, by its angle there, to a tile;
of a tile only the range of its angles to each pivot is kept. A pair of tiles
whose ranges lie apart at one pivot can't hold a near pair and is dropped on these
narrow rows, before a vector is shuffled. What is left is compared exactly, so the
pairs are those of ``near_pairs``, whatever the data. The saving depends on them:
vectors in clusters leave few tile pairs, vectors without any structure in many
dimensions leave all.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusmill.functions import vectors as V
from corpusmill.functions.numeric import with_scalar
from corpusmill.operators.vectors import TILE, _tile_pairs
from corpusmill.plans.lineage import cut
from corpusmill.plans.ranking import top_n
from corpusmill.plans.sizing import join_small

PIVOTS = 16
BINS = 4096
# Angles are rounded; ranges must lie apart by more than that.
SLACK = 1e-6


def _angle(unit: Column, pivot: Column) -> Column:
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), V.dot(unit, pivot))))


def _pivots(narrow: DataFrame, group: Sequence[str], item: str, vector: str, pivots: int) -> DataFrame:
    """(*group, _pivots): unit vectors of the items with the smallest hashes."""
    chosen = top_n(narrow, group, [F.xxhash64(item), F.col(item)], pivots)
    unit = V.l2_normalise(F.col(vector))
    return chosen.groupBy(*group).agg(F.sort_array(F.collect_list(unit)).alias("_pivots"))


def pivot_tiles(
    distinct: DataFrame,
    group: Sequence[str] = ("label",),
    item: str = "item_id",
    vector: str = "embedding",
    pivots: int = PIVOTS,
    tile: int = TILE,
) -> DataFrame:
    """``(*group, _tile, _angles, item, vector)``, written once: every vector with its tile and pivot angles.

    A tile has less than two times ``tile`` vectors: counts per (cell, angle bin)
    are added up along the angle, and a bin above ``tile`` is dealt by a hash of the id. No
    vector is sorted. Null, zero and not finite vectors are in no pair and left out.
    """
    if not 1 <= pivots < 1 << 15:
        raise ValueError("between 1 and 32767 pivots are needed")
    length = V.norm(F.col(vector))
    narrow = distinct.select(*group, item, vector).filter(
        F.col(vector).isNotNull() & (length > 0) & (length < float("inf"))
    )
    angles = with_scalar(
        F.col("_pivots"), V.l2_normalise(F.col(vector)),
        lambda pivot, unit: _angle(unit, pivot),
    )
    least = F.array_min("_angles")
    placed = (
        join_small(narrow, _pivots(narrow, group, item, vector, pivots), group)
        .withColumn("_angles", angles)
        .withColumn("_cell", F.array_position("_angles", least).cast("long"))
        .withColumn("_bin", F.floor(least / math.pi * BINS).cast("int"))
        .drop("_pivots")
    )
    placed = cut(placed)
    where = [*group, "_cell", "_bin"]
    counts = placed.groupBy(*where).agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy(*group, "_cell").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *where,
        F.floor(F.coalesce(F.sum("_n").over(along), F.lit(0)) / tile).cast("long").alias("_start"),
        F.ceil(F.col("_n") / F.lit(tile)).cast("long").alias("_parts"),
    )
    number = (
        F.shiftleft(F.col("_cell"), 48)
        + F.shiftleft(F.col("_start"), 24)
        + F.pmod(F.xxhash64(item), F.col("_parts"))
    )
    return join_small(placed, starts, where).select(*group, number.alias("_tile"), "_angles", item, vector)


def tile_pairs(tiles: DataFrame, threshold: float, group: Sequence[str] = ("label",), pivots: int = PIVOTS) -> DataFrame:
    """``(*group, _a, _b, _n_a, _n_b)``: pairs of tiles, _a <= _b, that may hold a pair above the threshold."""
    angle = [F.get("_angles", F.lit(i)) for i in range(pivots)]
    ranges = cut(
        tiles.groupBy(*group, "_tile").agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.min(a).alias(f"_lo{i}") for i, a in enumerate(angle)],
            *[F.max(a).alias(f"_hi{i}") for i, a in enumerate(angle)],
        )
    )
    first = ranges.select(*group, *[F.col(c).alias(f"{c}_a") for c in ranges.columns if c not in group])
    second = ranges.select(*group, *[F.col(c).alias(f"{c}_b") for c in ranges.columns if c not in group])
    reach = math.acos(max(-1.0, min(1.0, threshold))) + SLACK
    apart = [
        F.coalesce(F.greatest(F.col(f"_lo{i}_a") - F.col(f"_hi{i}_b"), F.col(f"_lo{i}_b") - F.col(f"_hi{i}_a")), F.lit(0.0))
        for i in range(pivots)
    ]
    return (
        join_small(first, second, group)
        .filter((F.col("_tile_a") <= F.col("_tile_b")) & reduce(lambda x, y: x & y, [a < reach for a in apart]))
        .select(*group, F.col("_tile_a").alias("_a"), F.col("_tile_b").alias("_b"), "_n_a", "_n_b")
    )


def comparisons(pairs: DataFrame, group: Sequence[str] = ("label",)) -> DataFrame:
    """``(*group, compared)``: how many pairs of vectors the tile pairs stand for."""
    n, m = F.col("_n_a"), F.col("_n_b")
    count = F.when(F.col("_a") == F.col("_b"), (n * (n - 1) / 2).cast("long")).otherwise(n * m)
    return pairs.groupBy(*group).agg(F.sum(count).alias("compared"))


def pruned_pairs(
    distinct: DataFrame,
    threshold: float = 0.95,
    group: Sequence[str] = ("label",),
    item: str = "item_id",
    vector: str = "embedding",
    pivots: int = PIVOTS,
    tile: int = TILE,
) -> DataFrame:
    """The pairs of ``near_pairs``; a vector is sent to a task for each tile pair that is left with its tile.

    Feed it the distinct rows of ``split_copies``.
    """
    tiles = pivot_tiles(distinct, group, item, vector, pivots, tile)
    left = cut(tile_pairs(tiles, threshold, group, pivots).select(*group, "_a", "_b"))
    sides = left.select(*group, F.col("_a").alias("_tile"), "_a", "_b", F.lit(False).alias("_second")).unionAll(
        left.filter("_a <> _b").select(*group, F.col("_b").alias("_tile"), "_a", "_b", F.lit(True))
    )
    paired = join_small(tiles.drop("_angles"), sides, [*group, "_tile"]).select(
        *group, "_a", "_b", "_second", item, vector
    )
    out = T.StructType(
        [
            *[distinct.schema[c] for c in group],
            T.StructField("item_a", distinct.schema[item].dataType),
            T.StructField("item_b", distinct.schema[item].dataType),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    mapper = _tile_pairs(list(group), item, vector, float(threshold), to_arrow_schema(out))
    return paired.groupBy(*group, "_a", "_b").applyInArrow(mapper, out)
