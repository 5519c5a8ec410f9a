"""Registered queries for files and stored tables. Each writes under the shared folder, then reads back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tradewind.catalog.bound import Bound, sql
from tradewind.catalog.maintenance import (
    all_orders, BY_MONTH, COLUMNS as ORDER_COLUMNS, FIRST_RUN, ORACLE as MAINTENANCE, PLACED, SECOND_RUN, TRACKED, _states, new_rows,
    old_rows, own_folder, warehouse,
)
from tradewind.functions.dates import time_literal
from tradewind.operators import history, incremental as inc, quality
from tradewind.operators.incremental import Incremental
from tradewind.operators.rollup import Total, rollup
from tradewind.operators.schema_drift import schema_diff
from tradewind.plans.daily import STAGING
from tradewind.plans.models import Context, Model, build_all
from tradewind.plans.params import Run
from tradewind.plans.staging import clean
from tradewind.session import shuffles_freed
from tradewind.sources.bindings import BINDINGS, table
from tradewind.sources.raw import load_bronze, load_seed, read_csv, read_csv_in_blocks
from tradewind.sources.schemas import COLUMNS
from tradewind.sources.shards import read_shards, shard_summary
from tradewind.sources.tables import RangePartition, TimePartition

TEXTS = StructType([StructField(c, StringType()) for c in ("doc_id", "text", "lang")])


def _folder(spark) -> str:
    return own_folder(spark, "files")


def _write_csv(df, path: str, **options) -> str:
    with shuffles_freed(df.sparkSession):
        df.write.options(**options).csv(path, header=True, quote='"', escape='"', quoteAll=True, emptyValue="",
                                        timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSS")
    return path


def _documents(spark, d) -> str:
    return _write_csv(table(spark, d, "documents").select("doc_id", "text", "lang"), _folder(spark))


def csv_scan(spark, d):
    """Whole documents, with their line breaks and quotes, through CSV files."""
    return read_csv(spark, _documents(spark, d), TEXTS).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")


def csv_scan_in_blocks(spark, d):
    return read_csv_in_blocks(spark, _documents(spark, d), TEXTS).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")


def bronze_load(spark, d):
    """All nine sources as CSV files, loaded, counted and cleaned; their rows per table."""
    folder, wh = _folder(spark), warehouse(spark)
    for t in COLUMNS:
        # quoted text is several times as large as its table; one task reads a compressed file, so that none may be large
        _write_csv(BINDINGS[t](spark, d), f"{folder}/{t}.csv", compression="gzip", maxRecordsPerFile=500_000)
    load_bronze(wh, folder)
    return quality.row_counts({f"silver.{t}": clean(t, wh.read(f"bronze.{t}")) for t in COLUMNS})


def bronze_reviews(spark, d):
    """Reviews, whose messages hold line breaks, through CSV, bronze and cleaning."""
    folder, wh = _folder(spark), warehouse(spark)
    _write_csv(BINDINGS["reviews"](spark, d), f"{folder}/reviews.csv")
    load_bronze(wh, folder, tables=["reviews"], multiline="blocks")
    return clean("reviews", wh.read("bronze.reviews"))


def seed_load(spark, d):
    """Parts as a seed file with a type override."""
    path, wh = _folder(spark), warehouse(spark)
    _write_csv(table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice"), path)
    load_seed(wh, "gold.parts", path, column_types={"p_size": "string"})
    return wh.read("gold.parts")


def table_copy(spark, d):
    wh = warehouse(spark)
    wh.write_table("gold.old", old_rows(spark, d))
    wh.write_table("gold.new", new_rows(spark, d))
    wh.copy(["gold.old", "gold.new"], "gold.both")
    wh.copy(["gold.old"], "gold.both", mode="incremental")
    return wh.read("gold.both")


def table_clone(spark, d):
    """A clone stays as it was when its source changes."""
    wh = warehouse(spark)
    wh.write_table("gold.orders", all_orders(spark, d), BY_MONTH)
    wh.clone("gold.orders", "silver.orders")
    inc.apply(wh, "gold.orders", new_rows(spark, d), Incremental("append", partition=BY_MONTH))
    wh.clone("gold.orders", "silver.orders")
    return wh.read("silver.orders")


def stored_view(spark, d):
    wh = warehouse(spark)
    wh.write_table("gold.orders", all_orders(spark, d))
    wh.create_view("silver.by_status", f"SELECT order_status, count(*) AS n FROM {wh.full_name('gold.orders')} GROUP BY 1")
    return wh.read("silver.by_status")


def silver_view(spark, d):
    """Reviews as loaded, read through their cleaning view in the catalog; another layer has a view of the same name."""
    wh = warehouse(spark)
    raw = BINDINGS["reviews"](spark, d)
    wh.write_table("bronze.reviews", raw.select(*[F.col(c).cast("string") for c in raw.columns]))
    model, = [m for m in STAGING if m.name == "stg_reviews"]
    wh.create_view("gold.stg_reviews", "SELECT 'another layer' AS note")
    build_all([[model]], Context(wh, STAGING))
    return spark.table(f"{wh.full_name('silver.stg_reviews')}")


def materialized_view(spark, d):
    wh = warehouse(spark)
    wh.write_table("gold.orders", old_rows(spark, d))
    view = wh.materialized_view("gold.by_status", lambda: wh.read("gold.orders").groupBy("order_status").agg(F.count("*").alias("n")),
                                cluster=["order_status"])
    wh.write_table("gold.orders", all_orders(spark, d))
    return view.refresh()


def rollup_refreshed(spark, d):
    """Orders, first and last purchase per status from partials by month, refreshed after a merge and after two years of orders
    are gone."""
    wh, how = warehouse(spark), Incremental("merge", ("order_id",), BY_MONTH)
    wh.write_table("gold.orders", old_rows(spark, d), BY_MONTH)
    kept = rollup(wh, "gold.by_status", "gold.orders", ["order_status"], {
        "orders": Total("count(*)"), "first_order": Total(f"min({PLACED})", "min"), "last_order": Total(f"max({PLACED})", "max")})
    inc.apply(wh, "gold.orders", new_rows(spark, d), how)
    kept.refresh()
    wh.drop_partitions("gold.orders", [v for v in wh.partition_values("gold.orders") if v.year in (1995, 1999)])
    kept.refresh()
    return kept.read()


def audited_cleaning(spark, d):
    """Sellers cleaned and stamped with a run."""
    return clean("sellers", BINDINGS["sellers"](spark, d), Run(datetime(2024, 5, 1, 1, 2, 3), "run-1"))


def stored_partitions(spark, d):
    """Partition values of a table by month, and rows in each."""
    wh = warehouse(spark)
    wh.write_table("gold.orders", all_orders(spark, d), BY_MONTH, ["order_status", "customer_id"])
    return wh.read("gold.orders", technical=True).groupBy(BY_MONTH.column).agg(F.count("*").alias("n")).withColumnRenamed(BY_MONTH.column, "month")


def stored_ranges(spark, d):
    wh, part = warehouse(spark), RangePartition("c_nationkey", 5, 20, 5)
    wh.write_table("gold.customers", table(spark, d, "customer"), part)
    return wh.read("gold.customers", technical=True).select("c_custkey", F.col(part.column).cast("bigint").alias("part"))


def stored_ingestion_time(spark, d):
    """The event time only lives on as the partition."""
    wh, part = warehouse(spark), TimePartition("ts", "day", drop_field=True)
    wh.write_table("gold.events", table(spark, d, "events").select("event_id", "ts", "event_type"), part)
    return wh.read("gold.events", technical=True).withColumnRenamed("_partition_time", "day")


def shard_scan(spark, d):
    """Events written as one table per day, read as a family."""
    folder = _folder(spark)
    day = F.date_format("ts", "yyyyMMdd")
    events = table(spark, d, "events").select("event_id", day.alias("day"))
    events.hint("rebalance", F.col("day")).withColumn("shard", F.concat(F.lit("events_"), "day")).write.partitionBy("shard").parquet(folder)
    # partition folders are named shard=events_YYYYMMDD: a family with the prefix "shard=events"
    return shard_summary(read_shards(spark, folder, "shard=events")).drop("bytes")


def stored_delete_insert(spark, d):
    wh, how = warehouse(spark), Incremental("delete_insert", ("order_id",), BY_MONTH)
    wh.write_table("gold.orders", old_rows(spark, d), BY_MONTH)
    inc.apply(wh, "gold.orders", new_rows(spark, d), how)
    return wh.read("gold.orders")


def stored_copy_partitions(spark, d):
    wh, how = warehouse(spark), Incremental("insert_overwrite", partition=BY_MONTH, copy_partitions=True)
    wh.write_table("gold.orders", old_rows(spark, d), BY_MONTH)
    inc.apply(wh, "gold.orders", new_rows(spark, d), how)
    return wh.read("gold.orders")


def stored_microbatch(spark, d):
    wh, how = warehouse(spark), Incremental("microbatch", partition=BY_MONTH)
    wh.write_table("gold.orders", old_rows(spark, d), BY_MONTH)
    inc.microbatch(wh, "gold.orders", lambda lo, hi: new_rows(spark, d), how, datetime(1999, 3, 10), datetime(1999, 9, 20), one_pass=True)
    return wh.read("gold.orders")


def stored_watermark(spark, d):
    """Orders above the newest stored one; only the newest partition is read for it."""
    wh = warehouse(spark)
    wh.write_table("gold.orders", old_rows(spark, d), BY_MONTH)
    return inc.newer_than_table(wh, "gold.orders", Bound(spark, d).source("orders").select(*ORDER_COLUMNS), PLACED, BY_MONTH)


def stored_schema_sync(spark, d):
    """Merge after the new rows gained, lost and retyped a column."""
    wh = warehouse(spark)
    how = Incremental("merge", ("order_id",), BY_MONTH, on_schema_change="sync_all_columns")
    wh.write_table("gold.orders", old_rows(spark, d), BY_MONTH)
    new = new_rows(spark, d).withColumn("order_id", F.col("order_id").cast("bigint")).drop("customer_id").withColumn("note", F.lit("late"))
    inc.apply(wh, "gold.orders", new, how)
    return wh.read("gold.orders")


def stored_history(spark, d):
    wh, how = warehouse(spark), TRACKED["scd2_deleted_record"]
    for state, now in zip(_states(spark, d), (FIRST_RUN, SECOND_RUN)):
        history.apply_history(wh, "gold.history", state, how, now)
    return wh.read("gold.history").drop(history.STORED_BY.column)


def schema_difference(spark, d):
    """Columns that orders and customers do not share, with their types."""
    diff = schema_diff(Bound(spark, d).source("orders").schema, Bound(spark, d).source("customers").schema)
    orders = Bound(spark, d).source("orders")
    return orders.select(*diff.added).agg(*[F.count(c).alias(c) for c in diff.added])


def stored_failures(spark, d):
    wh = warehouse(spark)
    quality.store_failures(wh, "gold.failures", quality.not_null(Bound(spark, d).source("orders"), "order_approved_at", whole_rows=True))
    return wh.read("gold.failures")


def python_models(spark, d):
    """Two models as Python functions: a table, and one that adds what is newer on its second run."""
    wh = warehouse(spark)
    orders = Model("all_orders", lambda c, s: Bound(s, d).source("orders").select(*ORDER_COLUMNS))
    recent = Model("recent", lambda c, s: c.newer(c.ref("all_orders"), PLACED) if c.is_incremental
                   else c.ref("all_orders").where(F.col(PLACED) < time_literal(c.config["until"])),
                   "incremental", how=Incremental("append", partition=BY_MONTH), config={"until": datetime(1999, 1, 1)})
    context = Context(wh, [orders, recent])
    build_all([[orders], [recent], [recent]], context)
    return context.ref("recent")


QUERIES = {f.__name__: f for f in (
    csv_scan, csv_scan_in_blocks, bronze_load, bronze_reviews, seed_load, table_copy, table_clone, stored_view, silver_view,
    materialized_view, rollup_refreshed, audited_cleaning, stored_partitions, stored_ranges, stored_ingestion_time, shard_scan, stored_delete_insert,
    stored_copy_partitions, stored_microbatch, stored_watermark, stored_schema_sync, stored_history, schema_difference,
    stored_failures, python_models,
)}

_HEAD = sql("SELECT * FROM src_orders").removesuffix("SELECT * FROM src_orders").rstrip()
_STATES = MAINTENANCE["append"].removesuffix("SELECT * FROM t UNION ALL SELECT * FROM s").rstrip()
_ROWS = {
    "customers": "customer", "orders": "orders", "order_items": "lineitem", "order_payments": "lineitem", "reviews": "events",
    "products": "part", "sellers": "supplier", "geolocations": "customer",
}
_NEW = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date"]

ORACLE = {
    # an empty text and a missing one are the same in a CSV file
    "csv_scan": "SELECT doc_id, nullif(text, '') AS text, lang FROM documents",
    "csv_scan_in_blocks": "SELECT doc_id, nullif(text, '') AS text, lang FROM documents",
    "bronze_load": " UNION ALL ".join(
        f"SELECT 'silver' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {v}" for t, v in _ROWS.items())
    + " UNION ALL SELECT 'silver', 'product_category_name_translation', count(DISTINCT p_type) FROM part WHERE p_type <> 'PROMO'",
    "bronze_reviews": sql("SELECT * FROM reviews"),
    "seed_load": "SELECT cast(p_partkey AS integer) AS p_partkey, cast(p_size AS varchar) AS p_size, p_retailprice FROM part",
    "table_copy": f"{_STATES} SELECT * FROM t UNION ALL SELECT * FROM s UNION ALL SELECT * FROM t",
    "table_clone": f"{_STATES} SELECT * FROM o",
    "stored_view": f"{_STATES} SELECT order_status, count(*) AS n FROM o GROUP BY 1",
    "silver_view": sql("SELECT * FROM reviews"),
    "materialized_view": f"{_STATES} SELECT order_status, count(*) AS n FROM o GROUP BY 1",
    "rollup_refreshed": f"""{_STATES}
        SELECT order_status, count(*) AS orders, min({PLACED}) AS first_order, max({PLACED}) AS last_order
        FROM (SELECT * FROM t WHERE order_id NOT IN (SELECT order_id FROM s) UNION ALL SELECT * FROM s)
        WHERE year({PLACED}) NOT IN (1995, 1999) GROUP BY 1""",
    "audited_cleaning": sql("SELECT *, TIMESTAMP '2024-05-01 01:02:03' AS _loaded_at, 'run-1' AS _run_id FROM sellers"),
    "stored_partitions": f"{_STATES} SELECT cast(date_trunc('month', order_purchase_timestamp) AS date) AS month, count(*) AS n FROM o GROUP BY 1",
    "stored_ranges": """
        SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 0 WHEN c_nationkey < 10 THEN 1 WHEN c_nationkey < 15 THEN 2
               WHEN c_nationkey < 20 THEN 3 ELSE 4 END::bigint AS part FROM customer""",
    "stored_ingestion_time": "SELECT event_id, event_type, cast(ts AS date) AS day FROM events",
    "shard_scan": """
        SELECT min(strftime(ts, '%Y%m%d')) AS shard_min, max(strftime(ts, '%Y%m%d')) AS shard_max,
               count(DISTINCT strftime(ts, '%Y%m%d')) AS shard_count, count(*) AS row_count FROM events""",
    "stored_delete_insert": MAINTENANCE["merge_upsert"],
    "stored_copy_partitions": MAINTENANCE["overwrite_dynamic"],
    "stored_microbatch": MAINTENANCE["microbatch"],
    "stored_watermark": MAINTENANCE["high_watermark"],
    "stored_schema_sync": f"""{_STATES}
        SELECT cast(order_id AS bigint) AS order_id, order_status, order_purchase_timestamp, NULL::varchar AS note
        FROM t WHERE order_id NOT IN (SELECT order_id FROM s)
        UNION ALL SELECT cast(order_id AS bigint), order_status, order_purchase_timestamp, 'late' FROM s""",
    "stored_history": MAINTENANCE["scd2_deleted_record"],
    "schema_difference": f"{_HEAD} SELECT {', '.join(f'count({c}) AS {c}' for c in _NEW if c != 'customer_id')} FROM src_orders",
    "stored_failures": sql("SELECT * FROM src_orders WHERE order_approved_at IS NULL"),
    "python_models": sql("SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM src_orders"),
}
