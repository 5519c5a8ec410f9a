"""Product models: English categories, product dimension, product performance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewind.functions.aggregates import money_sum
from tradewind.functions.predicates import tier
from tradewind.plans.params import Params
from tradewind.plans.performance import join_to_dimension


def products_with_categories(products: DataFrame, translation: DataFrame, p: Params = Params()) -> DataFrame:
    return products.join(
        translation.select("product_category_name", "product_category_name_english"), "product_category_name", "left",
    ).select(
        "product_id", "product_category_name",
        F.coalesce("product_category_name_english", F.lit(p.unknown)).alias("product_category_name_english"),
        "product_name_length", "product_description_length", "product_photos_qty",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    )


def product_dimension(products: DataFrame) -> DataFrame:
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return products.select("*", volume.alias("product_volume_cm3"))


def product_performance(products: DataFrame, items: DataFrame, p: Params = Params()) -> DataFrame:
    """Sales of every product. ``products`` is the dimension, ``items`` the item fact.

    Items are summed per product and order first, so that orders are counted without expanding rows; sellers
    are counted over the distinct pairs.
    """
    scale, amounts = p.money_scale, {"total_revenue": "price", "total_freight": "freight_value", "total_revenue_with_freight": "item_total"}
    per_order = items.groupBy("product_id", "order_id").agg(
        F.count("*").alias("items"), F.count("price").alias("priced"),
        *[money_sum(c, scale).alias(name) for name, c in amounts.items()],
        F.min("order_purchase_timestamp").alias("first_sale_date"), F.max("order_purchase_timestamp").alias("last_sale_date"),
    )
    sold_by = items.select("product_id", "seller_id").distinct().groupBy("product_id").agg(F.count("seller_id").alias("unique_sellers"))
    sold = per_order.groupBy("product_id").agg(
        F.count("order_id").alias("total_orders"), F.sum("items").alias("items"), F.sum("priced").alias("priced"),
        *[money_sum(name, scale).alias(name) for name in amounts],
        F.min("first_sale_date").alias("first_sale_date"), F.max("last_sale_date").alias("last_sale_date"),
    ).join(sold_by, "product_id", "left")
    keys = ["product_id", "product_category_name_english", "product_weight_g", "product_volume_cm3"]
    joined = join_to_dimension(
        products, sold, keys, p,
        sums=["total_revenue", "total_freight", "total_revenue_with_freight"],
        counts=["total_orders", "unique_sellers"],
    )
    return joined.select(
        *keys, "total_orders", "total_items_sold", "total_revenue", F.col("avg_price"), "total_freight",
        "total_revenue_with_freight", "unique_sellers", "first_sale_date", "last_sale_date",
        tier("total_orders", p.product_steps, p.product_default).alias("product_performance_tier"),
    )
