"""Seeded, portable pseudo-random order.

``rand(seed)`` depends on the partitioning of its input; an md5 of the id
does not, so a recomputed task after an executor loss draws the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shuffle_key(item: Column, seed: int | str = 42) -> Column:
    """32 hex digits that order the items pseudo-randomly."""
    return F.md5(F.concat(item.cast("string"), F.lit(f":{seed}")))


def key_int(key: Column, start: int = 1, digits: int = 8) -> Column:
    """Integer value of some hex digits of a shuffle key."""
    return F.conv(F.substring(key, start, digits), 16, 10).cast("bigint")
