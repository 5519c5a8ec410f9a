"""Checks declared for the columns of every layer: 17 unique, 33 not null, 8 relationships,
1 accepted values, 3 ranges."""

from __future__ import annotations

from tradewind.operators.quality import ColumnRule as Rule
from tradewind.sources.schemas import ORDER_STATUSES

KEY = Rule(unique=True, not_null=True)
FILLED = Rule(not_null=True)

STAGING = {
    "stg_customers": {"customer_id": KEY, "customer_unique_id": FILLED},
    "stg_orders": {
        "order_id": KEY,
        "customer_id": Rule(not_null=True, parent=("stg_customers", "customer_id")),
        "order_status": Rule(accepted=ORDER_STATUSES),
    },
    "stg_order_items": {
        "order_id": Rule(not_null=True, parent=("stg_orders", "order_id")),
        "price": FILLED, "freight_value": FILLED,
    },
    "stg_order_payments": {"order_id": Rule(not_null=True, parent=("stg_orders", "order_id"))},
    "stg_products": {"product_id": KEY},
    "stg_sellers": {"seller_id": KEY},
    "stg_reviews": {"review_id": FILLED, "order_id": Rule(parent=("stg_orders", "order_id")), "review_score": FILLED},
}

INTERMEDIATE = {
    "order_payments": {"order_id": KEY, "total_payment_value": FILLED},
    "order_items_agg": {"order_id": KEY},
    "orders_enriched": {
        "order_id": KEY,
        "customer_id": Rule(not_null=True, parent=("stg_customers", "customer_id")),
    },
    "customer_history": {"customer_id": KEY},
    "products_with_categories": {"product_id": KEY},
    "sellers_with_locations": {"seller_id": KEY},
}

GOLD = {
    "dim_customers": {"customer_id": KEY},
    "dim_products": {"product_id": KEY},
    "dim_sellers": {"seller_id": KEY},
    "fct_orders": {
        "order_id": KEY,
        "customer_id": Rule(not_null=True, parent=("dim_customers", "customer_id")),
        "total_payment_value": Rule(low=0, high=100_000, range_severity="warn"),
        "hours_to_approval": Rule(low=0, high=8_760, range_severity="warn"),
    },
    "fct_order_items": {
        "order_id": FILLED, "order_item_id": FILLED,
        "product_id": Rule(not_null=True, parent=("dim_products", "product_id")),
        "seller_id": Rule(not_null=True, parent=("dim_sellers", "seller_id")),
        "price": FILLED,
    },
    "customer_metrics": {"customer_id": KEY, "cancellation_rate": Rule(low=0, high=1)},
    "product_performance": {"product_id": KEY},
    "seller_performance": {"seller_id": KEY},
}

ALL = {**STAGING, **INTERMEDIATE, **GOLD}


def count_by_kind() -> dict[str, int]:
    rules = [r for columns in ALL.values() for r in columns.values()]
    return {
        "unique": sum(r.unique for r in rules), "not_null": sum(r.not_null for r in rules),
        "relationships": sum(r.parent is not None for r in rules), "accepted_values": sum(bool(r.accepted) for r in rules),
        "between": sum(r.low is not None or r.high is not None for r in rules),
    }
