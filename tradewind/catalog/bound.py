"""The models on bound tables: what a registered query starts from, in Spark and in SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tradewind.plans import customers, orders, products, sellers
from tradewind.plans.params import Params
from tradewind.plans.staging import clean
from tradewind.sources.bindings import BINDINGS, LINE_ORDER, TYPE_NAMES, order_items

# Thresholds that split these tables into all labels; amounts have two decimals.
PARAMS = replace(
    Params(), money_scale=2,
    customer_steps=((12, "Loyal"), (8, "Repeat")),
    product_steps=((40, "Bestseller"), (30, "Popular"), (20, "Moderate")),
    seller_steps=((33_000_000, "Top Seller"), (31_000_000, "High Performer"), (29_000_000, "Average")),
)


class Bound:
    """Lazy frames of every model over the tables in one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = PARAMS) -> None:
        self.spark, self.sf_dir, self.params = spark, sf_dir, params

    def source(self, name: str) -> DataFrame:
        return clean(name, BINDINGS[name](self.spark, self.sf_dir))

    def items(self) -> DataFrame:
        """Order items without their numbers, for models that do not read these."""
        return clean("order_items", order_items(self.spark, self.sf_dir, numbered=False))

    def order_payments(self) -> DataFrame:
        return orders.order_payments(self.source("order_payments"), self.params)

    def order_items_agg(self) -> DataFrame:
        return orders.order_items_aggregated(self.items(), self.params)

    def orders_enriched(self) -> DataFrame:
        return orders.enriched_orders(self.source("orders"), self.order_payments(), self.order_items_agg())

    def customer_history(self) -> DataFrame:
        return customers.customer_history(self.orders_enriched(), self.params)

    def products_with_categories(self) -> DataFrame:
        return products.products_with_categories(
            self.source("products"), self.source("product_category_name_translation"), self.params)

    def sellers_with_locations(self) -> DataFrame:
        return sellers.sellers_with_locations(self.source("sellers"), self.source("geolocations"))

    def dim_customers(self) -> DataFrame:
        return customers.customer_dimension(self.source("customers"), self.customer_history(), self.params)

    def dim_products(self) -> DataFrame:
        return products.product_dimension(self.products_with_categories())

    def dim_sellers(self) -> DataFrame:
        return sellers.seller_dimension(self.sellers_with_locations())

    def fct_order_items(self) -> DataFrame:
        return orders.order_items_fact(
            self.source("order_items"), self.source("orders"),
            self.products_with_categories(), self.sellers_with_locations())

    def customer_metrics(self) -> DataFrame:
        spend = orders.orders_with_spend(self.source("orders"), self.order_payments())
        return customers.customer_metrics(spend, self.source("reviews"), self.source("customers"), self.params)

    def item_context(self) -> DataFrame:
        """Items with their orders: all that product performance reads of the item fact."""
        return orders.items_with_orders(self.items(), self.source("orders"))

    def product_performance(self) -> DataFrame:
        return products.product_performance(self.dim_products(), self.item_context(), self.params)

    def seller_performance(self) -> DataFrame:
        sold_products = sellers.assortment(self.items(), self.products_with_categories())
        return sellers.seller_performance(self.dim_sellers(), self.item_context(), self.params, sold_products)


_CLEAN = "trim({}, ' ' || chr(9) || chr(10))"

# The bindings and models as SQL, one named query each; later ones use earlier ones.
VIEWS: dict[str, str] = {
    "places": "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "customers": f"""
        SELECT cast(c_custkey AS varchar) AS customer_id, cast(c_custkey AS varchar) AS customer_unique_id,
               cast(c_nationkey AS varchar) AS customer_zip_code_prefix,
               {_CLEAN.format("' ' || chr(9) || n_name || '  '")} AS customer_city, r_name AS customer_state
        FROM customer LEFT JOIN places ON c_nationkey = n_nationkey""",
    "src_orders": """
        SELECT cast(o_orderkey AS varchar) AS order_id, cast(o_custkey AS varchar) AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'canceled' END
                   AS order_status,
               o_orderdate + to_hours(o_orderkey % 24) AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate + to_hours(o_orderkey % 72) END AS order_approved_at,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 40 <> 0
                    THEN o_orderdate + to_days(cast(o_orderkey % 7 AS integer)) END AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 40 <> 0
                    THEN o_orderdate + to_days(cast(o_orderkey % 61 - 3 AS integer)) + to_hours(o_orderkey % 23) END
                   AS order_delivered_customer_date,
               o_orderdate + to_days(30) AS order_estimated_delivery_date
        FROM orders""",
    "order_items": f"""
        SELECT cast(l_orderkey AS varchar) AS order_id,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS order_item_id,
               cast(l_partkey AS varchar) AS product_id, cast(l_suppkey AS varchar) AS seller_id,
               l_shipdate AS shipping_limit_date, l_extendedprice AS price,
               floor(l_extendedprice * l_tax * 100.0::double + 0.5::double) / 100.0::double AS freight_value
        FROM lineitem""",
    "order_pays": """
        SELECT cast(l_orderkey AS varchar) AS order_id, cast(l_linenumber AS bigint) AS payment_sequential,
               l_returnflag AS payment_type, cast(l_quantity AS bigint) AS payment_installments,
               l_extendedprice AS payment_value
        FROM lineitem""",
    "reviews": f"""
        SELECT cast(event_id - event_id % 3 AS varchar) AS review_id, cast(event_id // 2 AS varchar) AS order_id,
               event_id % 5 + 1 AS review_score, {_CLEAN.format("' ' || event_type")} AS review_comment_title,
               {_CLEAN.format("props || chr(10)")} AS review_comment_message, ts AS review_creation_date,
               ts + to_days(1) AS review_answer_timestamp
        FROM events""",
    "products": """
        SELECT cast(p_partkey AS varchar) AS product_id, p_type AS product_category_name,
               length(p_name) AS product_name_length, length(p_brand) AS product_description_length,
               cast(p_size % 5 AS bigint) AS product_photos_qty, cast(p_size AS bigint) AS product_weight_g,
               cast(p_size + 1 AS bigint) AS product_length_cm, cast(p_size + 2 AS bigint) AS product_height_cm,
               cast(p_size + 3 AS bigint) AS product_width_cm
        FROM part""",
    "sellers": """
        SELECT cast(s_suppkey AS varchar) AS seller_id, cast(s_nationkey AS varchar) AS seller_zip_code_prefix,
               n_name AS seller_city, r_name AS seller_state
        FROM supplier LEFT JOIN places ON s_nationkey = n_nationkey""",
    "geolocations": f"""
        SELECT CASE WHEN c_nationkey = 24 THEN 'no such zip' ELSE cast(c_nationkey AS varchar) END
                   AS geolocation_zip_code_prefix,
               c_nationkey + (c_custkey % 7) / 8.0::double AS geolocation_lat,
               (c_custkey % 11) / 4.0::double - 40 AS geolocation_lng,
               {_CLEAN.format("c_mktsegment || ' '")} AS geolocation_city, c_mktsegment AS geolocation_state
        FROM customer""",
    "translation": "SELECT DISTINCT p_type AS product_category_name, CASE p_type "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPE_NAMES.items())
    + " END AS product_category_name_english FROM part WHERE p_type IN ("
    + ", ".join(f"'{k}'" for k in TYPE_NAMES) + ")",
    "order_payments": """
        SELECT order_id, cast(sum(cast(payment_value AS decimal(18,2))) AS double) AS total_payment_value,
               count(*) AS payment_count, max(payment_installments) AS max_installments,
               string_agg(DISTINCT payment_type, ', ' ORDER BY payment_type) AS payment_methods_used
        FROM order_pays GROUP BY order_id""",
    "order_items_agg": """
        SELECT order_id, count(DISTINCT product_id) AS unique_products,
               cast(sum(cast(price AS decimal(18,2))) AS double) AS total_item_value,
               cast(sum(cast(freight_value AS decimal(18,2))) AS double) AS total_freight_value,
               cast(sum(cast(price AS decimal(18,2))) AS double) / count(price) AS avg_item_price,
               count(*) AS total_items,
               cast(sum(cast(price + freight_value AS decimal(18,2))) AS double) AS order_total
        FROM order_items GROUP BY order_id""",
    "orders_enriched": """
        SELECT o.*, coalesce(total_payment_value, 0) AS total_payment_value, coalesce(payment_count, 0) AS payment_count,
               max_installments, payment_methods_used, coalesce(unique_products, 0) AS unique_products,
               coalesce(total_item_value, 0) AS total_item_value, coalesce(total_freight_value, 0) AS total_freight_value,
               coalesce(avg_item_price, 0) AS avg_item_price, coalesce(total_items, 0) AS total_items,
               coalesce(total_item_value, 0) + coalesce(total_freight_value, 0) AS order_total,
               date_sub('day', order_purchase_timestamp, order_delivered_customer_date) AS delivery_days,
               CASE WHEN order_delivered_customer_date IS NULL THEN 'Not Delivered'
                    WHEN order_delivered_customer_date <= order_estimated_delivery_date THEN 'On Time'
                    ELSE 'Delayed' END AS delivery_status,
               date_sub('hour', order_purchase_timestamp, order_approved_at) AS hours_to_approval
        FROM src_orders o LEFT JOIN order_payments USING (order_id)
             LEFT JOIN (SELECT * EXCLUDE (order_total) FROM order_items_agg) USING (order_id)""",
    "customer_history": """
        SELECT customer_id, count(DISTINCT order_id) AS total_orders,
               cast(sum(cast(total_payment_value AS decimal(18,2))) AS double) AS total_spend,
               cast(sum(cast(total_payment_value AS decimal(18,2))) AS double) / count(total_payment_value) AS avg_order_value,
               min(order_purchase_timestamp) AS first_order_date, max(order_purchase_timestamp) AS last_order_date,
               date_sub('day', min(order_purchase_timestamp), max(order_purchase_timestamp)) AS days_since_first_order,
               avg(delivery_days) AS avg_delivery_days,
               cast(sum(unique_products) AS bigint) AS total_unique_products_ordered,
               avg(payment_count) AS avg_payments_per_order
        FROM orders_enriched WHERE order_status NOT IN ('canceled', 'unavailable') GROUP BY customer_id""",
    "products_with_categories": """
        SELECT p.*, coalesce(product_category_name_english, 'Unknown') AS product_category_name_english
        FROM products p LEFT JOIN translation t ON p.product_category_name = t.product_category_name""",
    "sellers_with_locations": """
        SELECT s.*, lat AS seller_lat, lng AS seller_lng
        FROM sellers s LEFT JOIN (
            SELECT geolocation_zip_code_prefix AS zip, geolocation_lat AS lat, geolocation_lng AS lng
            FROM geolocations QUALIFY row_number() OVER (PARTITION BY geolocation_zip_code_prefix
                ORDER BY geolocation_lat, geolocation_lng, geolocation_city, geolocation_state) = 1
        ) ON seller_zip_code_prefix = zip""",
    "dim_customers": """
        SELECT c.*, coalesce(total_orders, 0) AS total_orders, coalesce(total_spend, 0) AS total_spend,
               coalesce(avg_order_value, 0) AS avg_order_value, first_order_date, last_order_date,
               coalesce(days_since_first_order, 0) AS days_since_first_order,
               CASE WHEN total_orders >= 12 THEN 'Loyal' WHEN total_orders >= 8 THEN 'Repeat'
                    WHEN total_orders = 1 THEN 'One-time' ELSE 'No Orders' END AS customer_segment
        FROM customers c LEFT JOIN customer_history USING (customer_id)""",
    "dim_products": """
        SELECT *, product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3
        FROM products_with_categories""",
    "dim_sellers": "SELECT * FROM sellers_with_locations",
    "fct_order_items": """
        SELECT i.order_id, order_item_id, i.product_id, i.seller_id, customer_id, order_status,
               order_purchase_timestamp, product_category_name_english, seller_city, seller_state,
               price, freight_value, price + freight_value AS item_total
        FROM order_items i LEFT JOIN orders_enriched USING (order_id)
             LEFT JOIN products_with_categories USING (product_id) LEFT JOIN sellers_with_locations USING (seller_id)""",
    "customer_metrics": """
        WITH co AS (
            SELECT customer_id, count(DISTINCT order_id) AS total_orders,
                   min(order_purchase_timestamp) AS first_order_date, max(order_purchase_timestamp) AS last_order_date,
                   cast(sum(cast(total_payment_value AS decimal(18,2))) AS double) AS total_spent,
                   count(total_payment_value) AS paid,
                   count(DISTINCT CASE WHEN order_status = 'delivered' THEN order_id END) AS delivered_orders,
                   count(DISTINCT CASE WHEN order_status = 'canceled' THEN order_id END) AS canceled_orders
            FROM orders_enriched WHERE customer_id IS NOT NULL GROUP BY customer_id
        ), cr AS (
            SELECT customer_id, count(DISTINCT review_id) AS total_reviews, avg(review_score) AS avg_review_score
            FROM orders_enriched LEFT JOIN reviews USING (order_id)
            WHERE customer_id IS NOT NULL GROUP BY customer_id
        )
        SELECT customer_id, coalesce(customer_city, 'Unknown') AS customer_city,
               coalesce(customer_state, 'Unknown') AS customer_state, total_orders, first_order_date, last_order_date,
               date_sub('day', first_order_date, last_order_date) AS customer_lifetime_days, total_spent,
               total_spent / paid AS avg_order_value, delivered_orders, canceled_orders,
               canceled_orders / nullif(total_orders, 0) AS cancellation_rate,
               coalesce(total_reviews, 0) AS total_reviews, avg_review_score,
               CASE WHEN total_orders >= 12 THEN 'Loyal' WHEN total_orders >= 8 THEN 'Repeat'
                    ELSE 'One-time' END AS customer_segment
        FROM co LEFT JOIN customers USING (customer_id) LEFT JOIN cr USING (customer_id)""",
    "product_performance": """
        SELECT product_id, p.product_category_name_english, product_weight_g, product_volume_cm3,
               count(DISTINCT i.order_id) AS total_orders, count(*) AS total_items_sold,
               cast(sum(cast(price AS decimal(18,2))) AS double) AS total_revenue,
               cast(sum(cast(price AS decimal(18,2))) AS double) / count(price) AS avg_price,
               cast(sum(cast(freight_value AS decimal(18,2))) AS double) AS total_freight,
               cast(sum(cast(item_total AS decimal(18,2))) AS double) AS total_revenue_with_freight,
               count(DISTINCT i.seller_id) AS unique_sellers,
               min(order_purchase_timestamp) AS first_sale_date, max(order_purchase_timestamp) AS last_sale_date,
               CASE WHEN count(DISTINCT i.order_id) >= 40 THEN 'Bestseller' WHEN count(DISTINCT i.order_id) >= 30 THEN 'Popular'
                    WHEN count(DISTINCT i.order_id) >= 20 THEN 'Moderate' ELSE 'Low Volume' END AS product_performance_tier
        FROM dim_products p LEFT JOIN fct_order_items i USING (product_id) GROUP BY ALL""",
    "seller_performance": """
        SELECT seller_id, s.seller_city, s.seller_state, seller_lat, seller_lng,
               count(DISTINCT i.order_id) AS total_orders, count(*) AS total_items_sold,
               cast(sum(cast(price AS decimal(18,2))) AS double) AS total_revenue,
               cast(sum(cast(price AS decimal(18,2))) AS double) / count(price) AS avg_item_price,
               cast(sum(cast(freight_value AS decimal(18,2))) AS double) AS total_freight,
               count(DISTINCT i.product_id) AS unique_products_sold,
               count(DISTINCT i.product_category_name_english) AS unique_categories,
               count(DISTINCT i.customer_id) AS unique_customers,
               min(order_purchase_timestamp) AS first_sale_date, max(order_purchase_timestamp) AS last_sale_date,
               date_sub('day', min(order_purchase_timestamp), max(order_purchase_timestamp)) AS days_active,
               CASE WHEN sum(price) >= 33000000 THEN 'Top Seller' WHEN sum(price) >= 31000000 THEN 'High Performer'
                    WHEN sum(price) >= 29000000 THEN 'Average' ELSE 'New/Low Volume' END AS seller_performance_tier
        FROM dim_sellers s LEFT JOIN fct_order_items i USING (seller_id) GROUP BY ALL""",
}


def sql(body: str) -> str:
    """``body`` behind the views above that it needs."""
    import re

    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name, view in VIEWS.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                todo.append(view)
    # materialized, so that a view used twice is computed once
    ctes = ", ".join(f"{n} AS MATERIALIZED ({v.strip()})" for n, v in VIEWS.items() if n in needed)
    return f"WITH {ctes} {body}" if ctes else body
