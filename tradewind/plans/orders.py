"""Order models: payments and items per order, enriched orders, order and item facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewind.functions.aggregates import distinct_list, money_avg, money_sum
from tradewind.functions.dates import elapsed
from tradewind.plans.params import Params

ORDER_COLUMNS = (
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
)
PAYMENT_METRICS = ("total_payment_value", "payment_count")
ITEM_METRICS = ("unique_products", "total_item_value", "total_freight_value", "avg_item_price", "total_items")


def order_payments(payments: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per order. All four aggregates combine before the shuffle."""
    return payments.groupBy("order_id").agg(
        money_sum("payment_value", p.money_scale).alias("total_payment_value"),
        F.count("*").alias("payment_count"),
        F.max("payment_installments").alias("max_installments"),
        distinct_list("payment_type").alias("payment_methods_used"),
    )


def order_items_aggregated(items: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per order. Rows are first combined per order and product, which spreads the items of
    one huge order over tasks; then products are counted per order."""
    return items.groupBy("order_id").agg(
        F.count_distinct("product_id").alias("unique_products"),
        money_sum("price", p.money_scale).alias("total_item_value"),
        money_sum("freight_value", p.money_scale).alias("total_freight_value"),
        money_avg("price", p.money_scale).alias("avg_item_price"),
        F.count("*").alias("total_items"),
        money_sum(F.col("price") + F.col("freight_value"), p.money_scale).alias("order_total"),
    )


def enriched_orders(orders: DataFrame, payments: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with payment, item and delivery metrics. ``payments`` and ``items`` have one row per
    order and are already partitioned by it, so only the orders move for the two joins."""
    zero = {c: F.coalesce(F.col(c), F.lit(0)).alias(c) for c in (*PAYMENT_METRICS, *ITEM_METRICS)}
    bought, delivered = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    return (
        orders.select(*ORDER_COLUMNS)
        .join(payments, "order_id", "left")
        .join(items.drop("order_total"), "order_id", "left")
        .select(
            *ORDER_COLUMNS,
            *[zero[c] for c in PAYMENT_METRICS], "max_installments", "payment_methods_used",
            *[zero[c] for c in ITEM_METRICS],
            (F.coalesce("total_item_value", F.lit(0)) + F.coalesce("total_freight_value", F.lit(0))).alias("order_total"),
            elapsed(delivered, bought, "day").alias("delivery_days"),
            F.when(delivered.isNull(), "Not Delivered")
            .when(delivered <= F.col("order_estimated_delivery_date"), "On Time")
            .otherwise("Delayed").alias("delivery_status"),
            elapsed("order_approved_at", bought, "hour").alias("hours_to_approval"),
        )
    )


def orders_with_spend(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """The columns of the order fact that customer metrics read, without the item aggregates."""
    return orders.join(payments.select("order_id", "total_payment_value"), "order_id", "left").select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        F.coalesce("total_payment_value", F.lit(0)).alias("total_payment_value"),
    )


def items_with_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items with customer, status and time of their order, and the item total.

    ``orders`` may be cleaned, enriched or stored orders: only three columns are read, none of which
    the enrichment changes.
    """
    context = orders.select("order_id", "customer_id", "order_status", "order_purchase_timestamp")
    return items.join(context, "order_id", "left").withColumn("item_total", F.col("price") + F.col("freight_value"))


def with_categories(items: DataFrame, products: DataFrame) -> DataFrame:
    return items.join(products.select("product_id", "product_category_name_english"), "product_id", "left")


def order_items_fact(items: DataFrame, orders: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Items with the context of their order, product and seller.

    No side is broadcast by hand: Spark does so where it knows a side to be small, and otherwise
    splits a skewed item side at run time. The total is added behind the joins, so that it does not travel with
    the items through their shuffles.
    """
    return (
        with_categories(items_with_orders(items, orders).drop("item_total"), products)
        .join(sellers.select("seller_id", "seller_city", "seller_state"), "seller_id", "left")
        .withColumn("item_total", F.col("price") + F.col("freight_value"))
        .select(
            "order_id", "order_item_id", "product_id", "seller_id",
            "customer_id", "order_status", "order_purchase_timestamp",
            "product_category_name_english", "seller_city", "seller_state",
            "price", "freight_value", "item_total",
        )
    )
