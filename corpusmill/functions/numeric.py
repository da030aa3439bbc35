"""Scalar numeric helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column) -> Column:
    """Round to the nearest integer, ties to even, as a bigint."""
    return F.rint(value).cast("bigint")


def rounded(value: Column, digits: int) -> Column:
    """Round a plain column or lambda variable by its exact binary value, ties to even.

    69.195 is stored slightly below its text form and gives 69.19, where
    ``F.round`` rounds the text up. When ``value * 10**digits`` lands on a
    half, the product's rounding error - exact with the value split into two
    26-bit halves - tells on which side the true product lies.
    """
    scale = float(10**digits)
    product = value * scale
    shifted = value * 134217729.0
    high = shifted - (shifted - value)
    error = (high * scale - product) + (value - high) * scale
    below = F.floor(product).cast("double")
    half = F.when(error > 0, below + 1).when(error < 0, below).otherwise(F.rint(product))
    return F.when(product - below == 0.5, half).otherwise(F.rint(product)) / scale


def round_to(value: Column, digits: int) -> Column:
    """:func:`rounded` for any expression; the lambda evaluates it once."""
    return F.transform(F.array(value), lambda x: rounded(x, digits))[0]


def ratio(num: Column, den: Column) -> Column:
    """num/den, 0 where the denominator is 0."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def f1_score(precision: Column, recall: Column) -> Column:
    return ratio(2 * precision * recall, precision + recall)


def with_scalar(
    values: Column, scalar: Column, function: Callable[[Column, Column], Column]
) -> Column:
    """function(x, scalar) per element, evaluating the scalar once per row.

    An expression captured by a lambda is evaluated again for every element;
    repeating its value beside the array keeps the work linear.
    """
    return F.zip_with(values, F.array_repeat(scalar, F.size(values)), function)


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def softmax(values: Column) -> Column:
    """Softmax of an array<double>, shifted by its maximum."""
    exps = with_scalar(values, F.array_max(values), lambda x, peak: F.exp(x - peak))
    return with_scalar(exps, array_sum(exps), lambda x, total: x / total)


def log_sum_exp(values: Column) -> Column:
    peak = F.array_max(values)
    return peak + F.log(array_sum(with_scalar(values, peak, lambda x, p: F.exp(x - p))))


def argmax(values: Column) -> Column:
    """Zero-based index of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    """Inclusive geographic box test; plain comparisons, so scans can push it."""
    lat_min, lat_max, lon_min, lon_max = box
    return lat.between(lat_min, lat_max) & lon.between(lon_min, lon_max)
