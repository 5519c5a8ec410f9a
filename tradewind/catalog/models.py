"""Registered queries for cleaning and models."""

from __future__ import annotations

from tradewind.catalog.bound import Bound, sql
from tradewind.sources.schemas import COLUMNS

# raw table -> name of its SQL view
SOURCE_VIEWS = {
    "customers": "customers", "orders": "src_orders", "order_items": "order_items", "order_payments": "order_pays",
    "reviews": "reviews", "products": "products", "sellers": "sellers", "geolocations": "geolocations",
    "product_category_name_translation": "translation",
}

MODELS = [
    "order_payments", "order_items_agg", "orders_enriched", "customer_history", "products_with_categories",
    "sellers_with_locations", "dim_customers", "dim_products", "dim_sellers", "fct_order_items",
    "customer_metrics", "product_performance", "seller_performance",
]

QUERIES = {f"stg_{t}": (lambda spark, d, t=t: Bound(spark, d).source(t)) for t in COLUMNS}
QUERIES |= {m: (lambda spark, d, m=m: getattr(Bound(spark, d), m)()) for m in MODELS}
QUERIES["fct_orders"] = lambda spark, d: Bound(spark, d).orders_enriched()

ORACLE = {f"stg_{t}": sql(f"SELECT * FROM {SOURCE_VIEWS[t]}") for t in COLUMNS}
ORACLE |= {m: sql(f"SELECT * FROM {m}") for m in MODELS}
ORACLE["fct_orders"] = sql("SELECT * FROM orders_enriched")
