"""Columns of the nine raw tables and the types the cleaning step gives them."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Raw table -> column -> type after cleaning. ``text`` is a string that is also
# stripped of surrounding white space.
COLUMNS: dict[str, dict[str, str]] = {
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_zip_code_prefix": "string",
        "customer_city": "text",
        "customer_state": "text",
    },
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp",
        "order_approved_at": "timestamp",
        "order_delivered_carrier_date": "timestamp",
        "order_delivered_customer_date": "timestamp",
        "order_estimated_delivery_date": "timestamp",
    },
    "order_items": {
        "order_id": "string",
        "order_item_id": "bigint",
        "product_id": "string",
        "seller_id": "string",
        "shipping_limit_date": "timestamp",
        "price": "double",
        "freight_value": "double",
    },
    "order_payments": {
        "order_id": "string",
        "payment_sequential": "bigint",
        "payment_type": "string",
        "payment_installments": "bigint",
        "payment_value": "double",
    },
    "reviews": {
        "review_id": "string",
        "order_id": "string",
        "review_score": "bigint",
        "review_comment_title": "text",
        "review_comment_message": "text",
        "review_creation_date": "timestamp",
        "review_answer_timestamp": "timestamp",
    },
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_name_length": "bigint",
        "product_description_length": "bigint",
        "product_photos_qty": "bigint",
        "product_weight_g": "bigint",
        "product_length_cm": "bigint",
        "product_height_cm": "bigint",
        "product_width_cm": "bigint",
    },
    "sellers": {
        "seller_id": "string",
        "seller_zip_code_prefix": "string",
        "seller_city": "text",
        "seller_state": "text",
    },
    "geolocations": {
        "geolocation_zip_code_prefix": "string",
        "geolocation_lat": "double",
        "geolocation_lng": "double",
        "geolocation_city": "text",
        "geolocation_state": "text",
    },
    "product_category_name_translation": {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
}

# Names under which the files arrive by default; override per deployment.
FILES = {name: f"{name}.csv" for name in COLUMNS}

ORDER_STATUSES = (
    "delivered", "shipped", "approved", "canceled", "unavailable", "invoiced", "processing", "created",
)


def raw_schema(table: str) -> StructType:
    """Every column as text: identifiers keep leading zeros, and bad numbers fail in the cast
    instead of turning into NULL while reading."""
    return StructType([StructField(c, StringType()) for c in COLUMNS[table]])
