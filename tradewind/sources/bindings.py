"""Roles of the nine source tables played by generic order, line, part and event tables.

Each binding is one projection over a table, plus a look-up of the nation and region names, so that
models can run on data that has other columns. Key arithmetic gives the roles what the tables lack:
times of day, late and early deliveries, several reviews per order, several locations per zip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewind.operators.sets import number_in_group

# English names of the part types; PROMO is left out and becomes 'Unknown'.
TYPE_NAMES = {
    "ECONOMY": "economy goods",
    "LARGE": "large goods",
    "MEDIUM": "medium goods",
    "SMALL": "small goods",
    "STANDARD": "standard goods",
}

STATUS_OF = {"F": "delivered", "O": "shipped", "P": "canceled"}


# Columns of the generic tables. Stating them saves a job per read that would look into the files.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _after(days: Column | int, hours: Column | int) -> Column:
    days, hours = [F.lit(x) if isinstance(x, int) else x for x in (days, hours)]
    return (F.col("o_orderdate") + F.make_dt_interval(days, hours)).cast("timestamp")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = (
        table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    c = table(spark, sf_dir, "customer")
    return c.join(place, c.c_nationkey == place.n_nationkey, "left").select(
        _text("c_custkey").alias("customer_id"),
        _text("c_custkey").alias("customer_unique_id"),
        _text("c_nationkey").alias("customer_zip_code_prefix"),
        F.concat(F.lit(" \t"), "n_name", F.lit("  ")).alias("customer_city"),
        F.col("r_name").alias("customer_state"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    delivered = (status == "F") & (key % 40 != 0)
    return table(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        F.when(status == "F", "delivered").when(status == "O", "shipped").when(status == "P", "canceled")
        .alias("order_status"),
        _after(0, (key % 24).cast("int")).alias("order_purchase_timestamp"),
        F.when(key % 50 != 0, _after(0, (key % 72).cast("int"))).alias("order_approved_at"),
        F.when(delivered, _after((key % 7).cast("int"), 0)).alias("order_delivered_carrier_date"),
        F.when(delivered, _after((key % 61 - 3).cast("int"), (key % 23).cast("int")))
        .alias("order_delivered_customer_date"),
        _after(30, 0).alias("order_estimated_delivery_date"),
    )


# Columns that order the lines of an order; lines that are equal in all of them are equal rows.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_tax")


def order_items(spark: SparkSession, sf_dir: str, numbered: bool = True) -> DataFrame:
    """The lines as items. Items are numbered 1, 2, … within their order, as a line number may occur twice in one;
    with ``numbered=False``, for queries that do not read the number, it is NULL."""
    # numbered by the key as items have it, so that a join on it finds them in place
    lines = table(spark, sf_dir, "lineitem").select(_text("l_orderkey").alias("order_id"), *LINE_ORDER)
    lines = number_in_group(lines, ["order_id"], LINE_ORDER, "item") if numbered else lines.withColumn("item", F.lit(None))
    return lines.select(
        "order_id",
        F.col("item").cast("bigint").alias("order_item_id"),
        _text("l_partkey").alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        # half a cent up, written so that every engine does the same steps
        (F.floor(F.col("l_extendedprice") * F.col("l_tax") * 100.0 + 0.5) / 100.0).alias("freight_value"),
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        F.col("l_quantity").cast("bigint").alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        # a review id covers three events and so more than one order; an order has two reviews
        (event - event % 3).cast("string").alias("review_id"),
        ((event - event % 2) / 2).cast("bigint").cast("string").alias("order_id"),
        (event % 5 + 1).alias("review_score"),
        F.concat(F.lit(" "), "event_type").alias("review_comment_title"),
        F.concat("props", F.lit("\n")).alias("review_comment_message"),
        F.col("ts").cast("timestamp").alias("review_creation_date"),
        (F.col("ts") + F.make_dt_interval(F.lit(1))).cast("timestamp").alias("review_answer_timestamp"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("bigint")
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").cast("bigint").alias("product_name_length"),
        F.length("p_brand").cast("bigint").alias("product_description_length"),
        (size % 5).alias("product_photos_qty"),
        size.alias("product_weight_g"),
        (size + 1).alias("product_length_cm"),
        (size + 2).alias("product_height_cm"),
        (size + 3).alias("product_width_cm"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = (
        table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    s = table(spark, sf_dir, "supplier")
    return s.join(place, s.s_nationkey == place.n_nationkey, "left").select(
        _text("s_suppkey").alias("seller_id"),
        _text("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
    )


def geolocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer is a location of its zip, so a zip has many rows. Zip 24 has none."""
    nation = F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        F.when(nation == 24, "no such zip").otherwise(_text("c_nationkey")).alias("geolocation_zip_code_prefix"),
        (nation + (F.col("c_custkey") % 7) / 8).alias("geolocation_lat"),
        ((F.col("c_custkey") % 11) / 4 - 40).alias("geolocation_lng"),
        F.concat("c_mktsegment", F.lit(" ")).alias("geolocation_city"),
        F.col("c_mktsegment").alias("geolocation_state"),
    )


def product_category_name_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct part types with their English names, where there is one."""
    english = F.coalesce(*[F.when(F.col("p_type") == kind, name) for kind, name in TYPE_NAMES.items()])
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_type").alias("product_category_name"), english.alias("product_category_name_english"))
        .where(F.col("product_category_name_english").isNotNull())
        .distinct()
    )


BINDINGS = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "reviews": reviews,
    "products": products,
    "sellers": sellers,
    "geolocations": geolocations,
    "product_category_name_translation": product_category_name_translation,
}
