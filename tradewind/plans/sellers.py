"""Seller models: locations, seller dimension, seller performance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewind.functions.aggregates import any_row, money_sum
from tradewind.functions.dates import elapsed
from tradewind.functions.predicates import tier
from tradewind.plans.params import Params
from tradewind.plans.performance import join_to_dimension


def zip_locations(geolocations: DataFrame) -> DataFrame:
    """One location per zip code, all its values from the same row."""
    values = ("geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state")
    return (
        geolocations.groupBy("geolocation_zip_code_prefix").agg(any_row(*values).alias("row"))
        .select("geolocation_zip_code_prefix", *[F.col(f"row.{v}").alias(v) for v in values])
    )


def sellers_with_locations(sellers: DataFrame, geolocations: DataFrame) -> DataFrame:
    places = zip_locations(geolocations).select(
        F.col("geolocation_zip_code_prefix").alias("seller_zip_code_prefix"),
        F.col("geolocation_lat").alias("seller_lat"), F.col("geolocation_lng").alias("seller_lng"),
    )
    return sellers.join(places, "seller_zip_code_prefix", "left").select(
        "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state", "seller_lat", "seller_lng",
    )


def seller_dimension(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state", "seller_lat", "seller_lng")


def assortment(items: DataFrame, products: DataFrame) -> DataFrame:
    """Products that each seller sold, with their category. Pairs combine before they meet the products.

    Pairs are dealt by their hash before they combine: nearly all differ, and a first step over whole blocks of the scan would hold
    as many as these have rows."""
    sold = items.select("seller_id", "product_id").repartition("seller_id", "product_id").distinct()
    return sold.join(products.select("product_id", "product_category_name_english"), "product_id", "left")


def seller_performance(sellers: DataFrame, items: DataFrame, p: Params = Params(),
                       sold_products: DataFrame | None = None) -> DataFrame:
    """Sales of every seller. ``sellers`` is the dimension, ``items`` the item fact.

    Amounts and dates are summed straight by seller, which combines before the shuffle. Only (seller, order, customer) travels
    for the counts of orders and customers: an order has one customer, so these rows are its orders. Products and categories are
    counted over the few distinct pairs of seller and product; a product has one category. ``sold_products`` is
    :func:`assortment` where ``items`` are not a stored fact with categories.
    """
    if sold_products is None:
        sold_products = items.select("seller_id", "product_id", "product_category_name_english").distinct()
    products_sold = sold_products.groupBy("seller_id", "product_id").agg(
        F.max("product_category_name_english").alias("category")).groupBy("seller_id").agg(
        F.count("product_id").alias("unique_products_sold"), F.count_distinct("category").alias("unique_categories"))
    orders_sold = items.select("seller_id", "order_id", "customer_id").distinct().groupBy("seller_id").agg(
        F.count("order_id").alias("total_orders"), F.count_distinct("customer_id").alias("unique_customers"))
    sold = items.groupBy("seller_id").agg(
        F.count("*").alias("items"), F.count("price").alias("priced"),
        money_sum("price", p.money_scale).alias("total_revenue"), money_sum("freight_value", p.money_scale).alias("total_freight"),
        F.min("order_purchase_timestamp").alias("first_sale_date"), F.max("order_purchase_timestamp").alias("last_sale_date"),
    ).join(orders_sold, "seller_id", "left").join(products_sold, "seller_id", "left")
    keys = ["seller_id", "seller_city", "seller_state", "seller_lat", "seller_lng"]
    joined = join_to_dimension(
        sellers, sold, keys, p, sums=["total_revenue", "total_freight"],
        counts=["total_orders", "unique_products_sold", "unique_categories", "unique_customers"],
    )
    return joined.select(
        *keys, "total_orders", "total_items_sold", "total_revenue", F.col("avg_price").alias("avg_item_price"),
        "total_freight", "unique_products_sold", "unique_categories", "unique_customers",
        "first_sale_date", "last_sale_date",
        elapsed("last_sale_date", "first_sale_date").alias("days_active"),
        tier("total_revenue", p.seller_steps, p.seller_default).alias("seller_performance_tier"),
    )
