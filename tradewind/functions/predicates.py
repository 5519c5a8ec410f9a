"""Comparisons, labels and buckets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from tradewind.functions.text import _col


def equals(a: Column | str, b: Column | str, null_safe: bool = False) -> Column:
    """``a = b``; with ``null_safe`` two NULLs are equal."""
    return _col(a).eqNullSafe(_col(b)) if null_safe else _col(a) == _col(b)


def tier(value: Column | str, steps: Sequence[tuple[float, str]], default: Column | str) -> Column:
    """Label of the first step whose lower bound ``value`` reaches; NULL gets ``default``."""
    value = _col(value)
    (bound, label), *rest = steps
    chain = F.when(value >= bound, label)
    return reduce(lambda c, s: c.when(value >= s[0], s[1]), rest, chain).otherwise(default)


def range_bucket(value: Column | str, start: int, end: int, interval: int) -> Column:
    """Number of borders ``start, start+interval, …, end`` that are ≤ ``value``: 0 lies below the
    range, the last bucket holds everything at or above the last border. NULL stays NULL."""
    value = _col(value)
    borders = (end - start) // interval + 1
    bucket = F.floor((value - start) / interval) + 1
    return F.when(value.isNotNull(), F.least(F.greatest(bucket, F.lit(0)), F.lit(borders)).cast("bigint"))
