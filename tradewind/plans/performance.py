"""Joining sales that are already summed per key to a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tradewind.functions.aggregates import money_sum
from tradewind.plans.params import Params


def join_to_dimension(dimension: DataFrame, sold: DataFrame, keys: Sequence[str], p: Params,
                      sums: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Left join of a dimension to sales per ``keys[0]``, then one row per ``keys``.

    Summing before the join keeps a best-selling key from being one huge join group. The second
    grouping gives a dimension row that occurs twice twice the sales, as joining first would; it
    works in the partitioning of the join.
    """
    unsold = F.lit(1 if p.count_unsold_row else 0)
    return (
        dimension.select(*keys).join(sold, keys[0], "left")
        .groupBy(*keys)
        .agg(
            *[F.max(F.coalesce(c, F.lit(0))).alias(c) for c in counts],
            F.sum(F.coalesce("items", unsold)).alias("total_items_sold"),
            *[money_sum(c, p.money_scale).alias(c) for c in sums],
            F.sum("priced").alias("_priced"),
            F.min("first_sale_date").alias("first_sale_date"),
            F.max("last_sale_date").alias("last_sale_date"),
        )
        .withColumn("avg_price", F.try_divide("total_revenue", "_priced"))
        .drop("_priced")
    )
