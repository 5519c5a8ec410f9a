"""Customer models: order history, customer dimension, customer metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewind.functions.aggregates import money_avg, money_sum
from tradewind.functions.casts import safe_divide
from tradewind.functions.dates import boundaries, elapsed
from tradewind.functions.predicates import tier
from tradewind.plans.params import Params


def customer_history(enriched: DataFrame, p: Params = Params()) -> DataFrame:
    """Per customer, over orders that were neither canceled nor unavailable (an order without a
    status is left out too)."""
    return (
        enriched.where(~F.col("order_status").isin(*p.dropped_statuses))
        .groupBy(p.customer_key)
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            money_sum("total_payment_value", p.money_scale).alias("total_spend"),
            money_avg("total_payment_value", p.money_scale).alias("avg_order_value"),
            F.min("order_purchase_timestamp").alias("first_order_date"),
            F.max("order_purchase_timestamp").alias("last_order_date"),
            elapsed(F.max("order_purchase_timestamp"), F.min("order_purchase_timestamp")).alias("days_since_first_order"),
            F.avg("delivery_days").alias("avg_delivery_days"),
            F.sum("unique_products").alias("total_unique_products_ordered"),
            F.avg("payment_count").alias("avg_payments_per_order"),
        )
    )


def customer_dimension(customers: DataFrame, history: DataFrame, p: Params = Params()) -> DataFrame:
    orders = F.col("total_orders")
    few = F.when(orders == 1, p.single_order).otherwise(p.no_orders)
    return customers.join(history, p.customer_key, "left").select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
        F.coalesce(orders, F.lit(0)).alias("total_orders"),
        F.coalesce("total_spend", F.lit(0)).alias("total_spend"),
        F.coalesce("avg_order_value", F.lit(0)).alias("avg_order_value"),
        "first_order_date", "last_order_date",
        F.coalesce("days_since_first_order", F.lit(0)).alias("days_since_first_order"),
        tier(orders, p.customer_steps, few).alias("customer_segment"),
    )


def customer_orders(orders: DataFrame, p: Params = Params()) -> DataFrame:
    """Order counts and spend per customer.

    The three distinct counts are all over orders, so rows are reduced to one per customer and order
    first. That step needs no shuffle of its own where orders arrive partitioned by order, and it
    spreads a customer with very many orders over tasks.
    """
    amount = "total_payment_value"
    per_order = orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id", "order_id").agg(
        F.min("order_purchase_timestamp").alias("first"),
        F.max("order_purchase_timestamp").alias("last"),
        money_sum(amount, p.money_scale).alias("spent"),
        F.count(amount).alias("paid_rows"),
        F.max(F.when(F.col("order_status") == "delivered", 1)).alias("delivered"),
        F.max(F.when(F.col("order_status") == "canceled", 1)).alias("canceled"),
    )
    return per_order.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.min("first").alias("first_order_date"),
        F.max("last").alias("last_order_date"),
        money_sum("spent", p.money_scale).alias("total_spent"),
        F.sum("paid_rows").alias("_paid_rows"),
        F.count(F.when(F.col("order_id").isNotNull(), F.col("delivered"))).alias("delivered_orders"),
        F.count(F.when(F.col("order_id").isNotNull(), F.col("canceled"))).alias("canceled_orders"),
    ).withColumn("avg_order_value", F.try_divide("total_spent", "_paid_rows")).drop("_paid_rows")


def customer_reviews(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Review count and mean score of customers with reviews. An inner join, so that either side of
    it can be split when one order holds most of the reviews."""
    return (
        reviews.select("order_id", "review_id", "review_score")
        .join(orders.where(F.col("customer_id").isNotNull()).select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(F.count_distinct("review_id").alias("total_reviews"), F.avg("review_score").alias("avg_review_score"))
    )


def customer_metrics(orders: DataFrame, reviews: DataFrame, customers: DataFrame, p: Params = Params(),
                     calendar_days: bool = False) -> DataFrame:
    """Lifetime numbers of every customer with orders. ``orders`` is the order fact and ``customers``
    the customer dimension. ``calendar_days`` counts midnights instead of whole days passed."""
    first, last = F.col("first_order_date"), F.col("last_order_date")
    return (
        customer_orders(orders, p)
        .join(customers.select("customer_id", "customer_city", "customer_state"), "customer_id", "left")
        .join(customer_reviews(orders, reviews), "customer_id", "left")
        .select(
            "customer_id",
            F.coalesce("customer_city", F.lit(p.unknown)).alias("customer_city"),
            F.coalesce("customer_state", F.lit(p.unknown)).alias("customer_state"),
            "total_orders", "first_order_date", "last_order_date",
            (boundaries(first, last) if calendar_days else elapsed(last, first)).alias("customer_lifetime_days"),
            "total_spent", "avg_order_value", "delivered_orders", "canceled_orders",
            safe_divide("canceled_orders", "total_orders").alias("cancellation_rate"),
            F.coalesce("total_reviews", F.lit(0)).alias("total_reviews"),
            "avg_review_score",
            tier("total_orders", p.customer_steps, p.single_order).alias("customer_segment"),
        )
    )
