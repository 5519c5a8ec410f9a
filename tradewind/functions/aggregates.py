"""Aggregates that Spark has no single function for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.functions.text import _col


def money_sum(c: Column | str, scale: int | None = None) -> Column:
    """Sum of a double amount.

    A float sum depends on the order in which rows arrive, so a retried task may change its last
    bits. With ``scale`` the amounts are added as whole units of ``10**-scale``: exact, in any
    order, in one 8-byte buffer (an overflow raises under ANSI).
    """
    if scale is None:
        return F.sum(_col(c))
    return F.sum(_units(c, scale)) / F.lit(float(10 ** scale))


def money_avg(c: Column | str, scale: int | None = None) -> Column:
    if scale is None:
        return F.avg(_col(c))
    return F.try_divide(money_sum(c, scale), F.count(_col(c)))


def _units(c: Column | str, scale: int) -> Column:
    # ``rint`` is one machine instruction; ``round`` on doubles goes through a decimal object per row
    return F.rint(_col(c) * F.lit(float(10 ** scale))).cast("bigint")


def distinct_list(c: Column | str, delimiter: str = ", ") -> Column:
    """Sorted distinct non-NULL values as one text, NULL when there are none.

    ``collect_set`` combines before the shuffle, so what travels per group is its set of values.
    """
    values = F.collect_set(_col(c))
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), delimiter))


def listagg(c: Column | str, delimiter: str = ",", order_by: Sequence[Column | str] = ()) -> Column:
    """All non-NULL values of the group as one text in the given order. The text is as long as the
    group: use :func:`listagg_first` for groups without a bound."""
    c = _col(c)
    rows = F.collect_list(F.when(c.isNotNull(), F.struct(*[_col(o) for o in order_by], c.alias("value"))))
    return F.when(F.size(rows) > 0, F.array_join(F.transform(F.array_sort(rows), lambda r: r["value"]), delimiter))


def listagg_first(df: DataFrame, keys: Sequence[str], measure: str, delimiter: str,
                  order_by: Sequence[str], limit: int, name: str = "list") -> DataFrame:
    """First ``limit`` non-NULL values of ``measure`` per group, as one text.

    The rank filter is a group limit: each task passes on at most ``limit`` rows of a group, so a
    group with most of the rows costs no more than any other. Groups with only NULLs give NULL.
    """
    # with the measure as last sort column equal rows carry equal values
    first = Window.partitionBy(*keys).orderBy(F.col(measure).isNull(), *order_by, measure)
    return (
        df.select(*keys, *[c for c in dict.fromkeys([*order_by, measure]) if c not in keys])
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= limit)
        .groupBy(*keys)
        .agg(listagg(measure, delimiter, ["_rank"]).alias(name))
    )


def any_row(*cols: str) -> Column:
    """One row of the group as a struct: the first in ascending order with NULLs last, so that all
    values come from the same row and a rerun picks the same one."""
    order = [c for name in cols for c in (F.col(name).isNull().alias(f"_null_{name}"), F.col(name))]
    return F.min(F.struct(*order))


def bool_or(c: Column | str) -> Column:
    return F.bool_or(_col(c))


def ordered_list(c: Column | str, order_by: Column | str, delimiter: str = ", ") -> Column:
    """Non-NULL values in the order of another column, as one text."""
    return listagg(c, delimiter, [order_by])
