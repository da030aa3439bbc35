"""Name handling: slugs, display names, file suffixes and stems."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(name: Column) -> Column:
    """Lower-cased name with spaces turned into underscores."""
    return F.regexp_replace(F.lower(name), " ", "_")


def display_name(slug_col: Column) -> Column:
    """Title-cased name of a slug."""
    return F.initcap(F.regexp_replace(slug_col, "_", " "))


def label_from_file_name(name: Column) -> Column:
    """``great_tit__12.jpg`` -> ``Great tit``; empty when there is no ``__``."""
    head = F.lower(F.regexp_replace(F.split_part(name, F.lit("__"), F.lit(1)), "_", " "))
    text = F.concat(F.upper(F.substring(head, 1, 1)), F.substr(head, F.lit(2)))
    return F.when(F.contains(name, F.lit("__")), text).otherwise(F.lit(""))


def suffix(name: Column) -> Column:
    """Lower-cased extension without the dot; empty when there is none."""
    return F.lower(F.regexp_extract(name, r"[^./]\.([^./]*)$", 1))


def stem(name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(name, r"(?<=[^./])\.[^./]*$", "")


def has_extension(name: Column, extensions: Iterable[str]) -> Column:
    return suffix(name).isin(*extensions)
