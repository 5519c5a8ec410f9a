"""Set operations and row selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.session import fixed


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _sides(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of both frames with the sides they occur on. Repeats combine before the one
    shuffle, so a row that fills a third of a table travels once per task; NULLs group as equal."""
    in_a, in_b = F.lit(True), F.lit(False)
    both = a.withColumns({"_a": in_a, "_b": in_b}).unionByName(b.select(*a.columns).withColumns({"_a": in_b, "_b": in_a}))
    return both.groupBy(*a.columns).agg(F.bool_or("_a").alias("_a"), F.bool_or("_b").alias("_b"))


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` lacks; NULLs compare as equal."""
    return _sides(a, b).where("_a AND NOT _b").drop("_a", "_b")


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that both frames have; NULLs compare as equal."""
    return _sides(a, b).where("_a AND _b").drop("_a", "_b")


def rows_in(df: DataFrame, keys: Sequence[str], other: DataFrame) -> DataFrame:
    """Rows whose key tuple occurs in ``other``. Keys that ``other`` repeats combine first."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_semi")


def rows_not_in(df: DataFrame, keys: Sequence[str], other: DataFrame) -> DataFrame:
    """Rows whose key tuple does not occur in ``other``; a NULL key occurs nowhere."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")


def filtered(df: DataFrame, where: str | None) -> DataFrame:
    return df.where(where) if where else df


def preview(df: DataFrame, limit: int, order_by: Sequence[str] = ()) -> DataFrame:
    return (df.orderBy(*order_by) if order_by else df).limit(limit)


# a group of more rows than this is spread over tasks when its rows are numbered
LARGE_GROUP = 100_000


def number_in_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str = "number",
                    large: int = LARGE_GROUP) -> DataFrame:
    """Rows numbered 1, 2, … within each group.

    Groups of up to ``large`` rows are numbered by a plain window, whose partitioning by the keys a later join or grouping uses
    again. A larger one would be sorted in one task; such groups, which a count finds first, are numbered by ranges.
    ``order_by`` must order the rows of a group without ties.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)).cast("bigint").alias(name)
    many = fixed(df.groupBy(*keys).count().where(F.col("count") > large).select(*[F.col(k).alias(f"_many_{k}") for k in keys]))
    if many.isEmpty():
        return df.select(*df.columns, number)
    is_many = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_many_{k}")) for k in keys])
    usual, spread = df.join(many, is_many, "left_anti"), df.join(many, is_many, "left_semi")
    return usual.select(*df.columns, number).unionByName(_number_by_ranges(spread, keys, order_by, name))


def _number_by_ranges(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str) -> DataFrame:
    """Rows are dealt by ranges of (keys, order columns), so a group of any size is spread, whatever its order columns hold; rows are
    numbered inside each range, and the sizes of the group's earlier ranges (one row per group and range) are added. The
    borders of ranges come from a sample, so the rows are written once with their range."""
    ranges = df.repartitionByRange(*keys, *order_by).withColumn("_range", F.spark_partition_id())
    # one key for group and range, never NULL itself: the window and the join share its partitioning
    cut = fixed(ranges).withColumn("_cell", F.struct(*keys, "_range"))
    group = [F.col(f"_cell.{k}") for k in keys]
    below = Window.partitionBy(*group).orderBy("_cell._range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy("_cell").count().select(
        "_cell", F.coalesce(F.sum("count").over(below), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_cell").orderBy(*order_by))
    return cut.withColumn("_inside", inside).join(sizes, "_cell").select(
        *df.columns, (F.col("_inside") + F.col("_before")).alias(name))
