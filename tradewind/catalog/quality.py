"""Registered queries for checks."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tradewind.catalog.bound import Bound, sql
from tradewind.catalog.maintenance import warehouse
from tradewind.catalog.models import SOURCE_VIEWS
from tradewind.operators import quality
from tradewind.operators.quality import Check
from tradewind.plans import declared
from tradewind.sources.bindings import table
from tradewind.sources.schemas import COLUMNS


def test_unique(spark, d):
    """Orders with more than one item."""
    return quality.unique(Bound(spark, d).items(), "order_id")


def test_not_null(spark, d):
    return quality.not_null(Bound(spark, d).source("orders"), "order_approved_at", whole_rows=True)


def test_accepted_values(spark, d):
    return quality.accepted_values(Bound(spark, d).source("orders"), "order_status", ["delivered", "created"])


def test_relationships(spark, d):
    """Items of orders that are not among the delivered ones."""
    b = Bound(spark, d)
    return quality.relationships(b.items(), "order_id", b.source("orders").where("order_status = 'delivered'"), "order_id")


def test_between(spark, d):
    return quality.between(Bound(spark, d).orders_enriched(), "hours_to_approval", 10, 40).select("order_id", "hours_to_approval")


def test_minimum(spark, d):
    return quality.minimum_at_least(Bound(spark, d).items(), "freight_value", 0.5)


def test_delivered_has_items(spark, d):
    b = Bound(spark, d)
    return quality.delivered_without_items(b.source("orders"), b.items())


def test_negative_values(spark, d):
    """Order facts below zero, after one order in 97 was given back twice."""
    given_back = F.when(F.regexp_extract("order_id", "[0-9]+", 0).cast("bigint") % 97 == 0, -F.col("total_payment_value"))
    facts = Bound(spark, d).orders_enriched().select("order_id", F.coalesce(given_back, "total_payment_value").alias("total_payment_value"))
    return quality.negative_order_values(facts)


def row_count_match(spark, d):
    return quality.row_count_mismatch(table(spark, d, "lineitem"), table(spark, d, "orders"))


WATCHED = ["order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_id"]


def aggregated_not_null(spark, d):
    return quality.aggregated_not_null(Bound(spark, d).source("orders"), WATCHED)


def aggregated_unique(spark, d):
    return quality.aggregated_unique(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"], skip=["l_returnflag"])


def aggregated_unique_rows(spark, d):
    return quality.aggregated_unique_rows(table(spark, d, "lineitem"), ["l_orderkey", "l_suppkey"])


def verdicts(spark, d):
    """Counts of failures with thresholds, a filter, a limit and another measure."""
    b = Bound(spark, d)
    orders, items = b.source("orders"), b.items()
    many = quality.unique(items, "order_id")
    return quality.run_checks([
        Check("not_null", quality.not_null(orders, "order_approved_at")),
        Check("few", quality.not_null(orders, "order_approved_at"), warn_if="> 100000", error_if="> 1000000"),
        Check("warning", quality.not_null(orders, "order_delivered_customer_date"), severity="warn"),
        Check("filtered", quality.not_null(orders, "order_delivered_customer_date", whole_rows=True), where="order_status = 'delivered'"),
        Check("limited", many, limit=5),
        Check("extra_items", many, fail_calc="sum(n_records)"),
    ])


def declared_checks(spark, d):
    """Every check declared for the cleaned tables."""
    b = Bound(spark, d)
    frames = {f"stg_{t}": b.source(t) for t in COLUMNS}
    return quality.declared_verdicts(frames, declared.STAGING)


def declared_layers(spark, d):
    """Every check declared for the intermediate models, the star schema and the analytics."""
    b = Bound(spark, d)
    frames = {n: getattr(b, n)() for n in (*declared.INTERMEDIATE, "dim_customers", "dim_products", "dim_sellers", "fct_order_items",
                                           "customer_metrics", "product_performance", "seller_performance")}
    frames |= {"fct_orders": b.orders_enriched(), "stg_customers": b.source("customers")}
    return quality.declared_verdicts(frames, declared.INTERMEDIATE).unionByName(quality.declared_verdicts(frames, declared.GOLD))


def observed_checks(spark, d):
    """Checks of single rows counted by the job that writes the order fact, some of whose keys and values are bad."""
    wh, rules = warehouse(spark), declared.GOLD["fct_orders"]
    key = F.col("order_id").cast("bigint")
    facts = Bound(spark, d).orders_enriched().withColumns({
        "order_id": F.when(key % 31 != 0, F.col("order_id")), "total_payment_value": F.when(key % 17 == 0, -1.0).otherwise(F.col("total_payment_value"))})
    seen = wh.write_table("gold.fct_orders", facts, measures=quality.row_measures("fct_orders", rules))
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("test"), F.lit(c).cast("bigint").alias("failures")) for n, c in seen.items()])))


def empty_tables(spark, d):
    """Of three tables the one without rows."""
    b = Bound(spark, d)
    return quality.empty_tables({"orders": b.source("orders"), "none": b.source("orders").where("order_status = 'no such status'"), "items": b.items()})


def inconsistent_orders(spark, d):
    """Cleaning that loses canceled orders, and a fact with a row per item."""
    b = Bound(spark, d)
    return quality.inconsistent_orders(table(spark, d, "orders"), b.source("orders").where("order_status <> 'canceled'"), b.items())


def contract_broken(spark, d):
    """Differences between the cleaned orders and the columns declared for the fact."""
    found = quality.contract_violations(Bound(spark, d).source("orders").schema, DataType.fromDDL(ORDER_FACT))
    return Bound(spark, d).source("orders").agg(F.count("*").alias("orders")).select(
        "orders", F.explode(F.array(*[F.lit(f) for f in found])).alias("violation"))


def row_counts(spark, d):
    b = Bound(spark, d)
    return quality.row_counts({
        "bronze.orders": table(spark, d, "orders"), "bronze._ext_orders": table(spark, d, "orders"),
        "silver.order_items": b.items(), "gold.order_payments": b.order_payments(),
    })


NOW = datetime(2024, 2, 1)


def freshness(spark, d):
    return quality.freshness(table(spark, d, "events"), "ts", NOW, timedelta(hours=24), timedelta(hours=48))


def freshness_filtered(spark, d):
    return quality.freshness(table(spark, d, "events"), "ts", NOW, timedelta(hours=1), timedelta(hours=24), where="event_type = 'error' AND ts < '2024-01-20'")


ORDER_FACT = """order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, order_approved_at timestamp,
    order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp,
    total_payment_value double, payment_count bigint, max_installments bigint, payment_methods_used string, unique_products bigint,
    total_item_value double, total_freight_value double, avg_item_price double, total_items bigint, order_total double,
    delivery_days bigint, delivery_status string, hours_to_approval bigint"""


def contract(spark, d):
    """Order facts in the columns and types declared for them, whatever their order."""
    df = Bound(spark, d).orders_enriched()
    return quality.require_contract(df.select(*reversed(df.columns)), DataType.fromDDL(ORDER_FACT))


def compare_with_expected(spark, d):
    """Payments per order against payments per order without returned lines."""
    b = Bound(spark, d)
    counts = lambda df: df.groupBy("order_id").agg(F.count("*").alias("n"))
    pays = b.source("order_payments")
    return quality.compare_with_expected(counts(pays), counts(pays.where("payment_type <> 'R'")))


QUERIES = {f.__name__: f for f in (
    test_unique, test_not_null, test_accepted_values, test_relationships, test_between, test_minimum,
    test_delivered_has_items, test_negative_values, row_count_match, aggregated_not_null, aggregated_unique,
    aggregated_unique_rows, verdicts, declared_checks, declared_layers, observed_checks, empty_tables, inconsistent_orders,
    contract_broken, row_counts, freshness, freshness_filtered, contract,
    compare_with_expected,
)}


def _per_column(table_name: str, columns: list[str], failures: str) -> str:
    parts = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {failures.format(c=c, t=table_name)} AS failures" for c in columns)
    return f"SELECT *, true AS should_warn, true AS should_error FROM ({parts}) WHERE failures > 0"


_REPEATS = "SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"


def _verdict(name: str, count: str, warn: str = "<> 0", error: str = "<> 0") -> str:
    return (f"SELECT '{name}' AS test, f AS failures, f {warn} AS should_warn, f {error} AS should_error "
            f"FROM (SELECT cast(({count}) AS bigint) AS f)")


def _declared_sql(layer: dict, view: dict[str, str]) -> str:
    parts = []
    for t, columns in layer.items():
        for c, rule in columns.items():
            n = f"{t}_{c}"
            if rule.unique:
                parts.append(_verdict(f"unique_{n}", _REPEATS.format(c=c, t=view[t])))
            if rule.not_null:
                parts.append(_verdict(f"not_null_{n}", f"SELECT count(*) FROM {view[t]} WHERE {c} IS NULL"))
            if rule.low is not None or rule.high is not None:
                outside = " OR ".join([f"{c} < {rule.low}"] * (rule.low is not None) + [f"{c} > {rule.high}"] * (rule.high is not None))
                parts.append(_verdict(f"between_{n}", f"SELECT count(*) FROM {view[t]} WHERE {outside}", error="<> 0" if rule.range_severity == "error" else "< 0"))
            if rule.accepted:
                listed = ", ".join(f"'{v}'" for v in rule.accepted)
                parts.append(_verdict(f"accepted_values_{n}", f"SELECT count(DISTINCT {c}) FROM {view[t]} WHERE {c} NOT IN ({listed})"))
            if rule.parent:
                p, field = rule.parent
                parts.append(_verdict(f"relationships_{n}", f"SELECT count(*) FROM {view[t]} a WHERE {c} IS NOT NULL AND NOT EXISTS "
                                      f"(SELECT 1 FROM {view[p]} b WHERE a.{c} = b.{field})"))
    return " UNION ALL ".join(parts)


_MODEL_VIEWS = {t: t for t in (*declared.INTERMEDIATE, *declared.GOLD)} | {"fct_orders": "orders_enriched", "stg_customers": "customers"}
_NULL_APPROVALS = "SELECT count(*) FROM src_orders WHERE order_approved_at IS NULL"
_ENRICHED = sql("SELECT * FROM orders_enriched")

ORACLE = {
    "test_unique": sql("SELECT order_id AS unique_field, count(*) AS n_records FROM order_items GROUP BY 1 HAVING count(*) > 1"),
    "test_not_null": sql("SELECT * FROM src_orders WHERE order_approved_at IS NULL"),
    "test_accepted_values": sql("""
        SELECT order_status AS value_field, count(*) AS n_records FROM src_orders
        WHERE order_status NOT IN ('delivered', 'created') GROUP BY 1"""),
    "test_relationships": sql("""
        SELECT order_id AS from_field FROM order_items
        WHERE order_id NOT IN (SELECT order_id FROM src_orders WHERE order_status = 'delivered')"""),
    "test_between": sql("""
        SELECT order_id, hours_to_approval FROM orders_enriched WHERE NOT (hours_to_approval BETWEEN 10 AND 40)"""),
    "test_minimum": sql("SELECT min(freight_value) AS minimum FROM order_items HAVING min(freight_value) < 0.5"),
    "test_delivered_has_items": sql("""
        SELECT order_id FROM src_orders WHERE order_status = 'delivered' AND order_id NOT IN (SELECT order_id FROM order_items)"""),
    "test_negative_values": sql("""
        SELECT order_id, -total_payment_value AS total_payment_value FROM orders_enriched
        WHERE cast(regexp_extract(order_id, '[0-9]+') AS bigint) % 97 = 0 AND total_payment_value > 0"""),
    "row_count_match": "SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders) AS row_count_diff",
    "aggregated_not_null": sql(_per_column("src_orders", WATCHED, "(SELECT count(*) FROM {t} WHERE {c} IS NULL)")),
    "aggregated_unique": _per_column("lineitem", ["l_orderkey", "l_partkey", "l_suppkey"], f"({_REPEATS})"),
    "aggregated_unique_rows": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, cast({c} AS varchar) AS unique_field, count(*) AS n_records FROM lineitem GROUP BY {c} HAVING count(*) > 1"
        for c in ("l_orderkey", "l_suppkey")),
    "verdicts": sql(" UNION ALL ".join([
        _verdict("not_null", _NULL_APPROVALS),
        _verdict("few", _NULL_APPROVALS, "> 100000", "> 1000000"),
        _verdict("warning", "SELECT count(*) FROM src_orders WHERE order_delivered_customer_date IS NULL", error="<> 0 AND false"),
        _verdict("filtered", "SELECT count(*) FROM src_orders WHERE order_delivered_customer_date IS NULL AND order_status = 'delivered'"),
        _verdict("limited", "SELECT 5"),
        _verdict("extra_items", "SELECT sum(n) FROM (SELECT count(*) AS n FROM order_items GROUP BY order_id HAVING count(*) > 1)"),
    ])),
    "declared_checks": sql(_declared_sql(declared.STAGING, {f"stg_{t}": v for t, v in SOURCE_VIEWS.items()})),
    "declared_layers": sql(_declared_sql({**declared.INTERMEDIATE, **declared.GOLD}, _MODEL_VIEWS)),
    "observed_checks": sql("""
        SELECT unnest(['rows', 'not_null_fct_orders_order_id', 'not_null_fct_orders_customer_id', 'between_fct_orders_total_payment_value',
                       'between_fct_orders_hours_to_approval']) AS test,
               unnest([count(*), count(*) FILTER (WHERE cast(order_id AS bigint) % 31 = 0), count(*) FILTER (WHERE customer_id IS NULL),
                       count(*) FILTER (WHERE cast(order_id AS bigint) % 17 = 0 OR total_payment_value < 0 OR total_payment_value > 100000),
                       count(*) FILTER (WHERE hours_to_approval < 0 OR hours_to_approval > 8760)]) AS failures FROM orders_enriched"""),
    "empty_tables": "SELECT 'none' AS table_name",
    "inconsistent_orders": sql("""
        WITH n AS (SELECT (SELECT count(*) FROM orders) AS b, (SELECT count(*) FROM src_orders WHERE order_status <> 'canceled') AS s,
                          (SELECT count(*) FROM order_items) AS g)
        SELECT 'bronze and silver' AS rule, b AS expected, s AS found FROM n WHERE b <> s
        UNION ALL SELECT 'gold at most silver', s, g FROM n WHERE g > s""").replace(" WITH n AS", ", n AS"),
    "contract_broken": """
        SELECT orders, unnest([%s]) AS violation FROM (SELECT count(*) AS orders FROM orders)""" % ", ".join(
        f"'missing column {c}'" for c in ("total_payment_value", "payment_count", "max_installments", "payment_methods_used", "unique_products",
                                          "total_item_value", "total_freight_value", "avg_item_price", "total_items", "order_total", "delivery_days",
                                          "delivery_status", "hours_to_approval")),
    "row_counts": """
        SELECT 'bronze' AS layer, 'orders' AS table_name, count(*) AS row_count FROM orders
        UNION ALL SELECT 'silver', 'order_items', count(*) FROM lineitem
        UNION ALL SELECT 'gold', 'order_payments', count(DISTINCT l_orderkey) FROM lineitem""",
    "freshness": """
        SELECT max(ts) AS max_loaded_at, TIMESTAMP '2024-02-01' AS snapshotted_at,
               date_sub('second', max(ts), TIMESTAMP '2024-02-01') AS age_seconds,
               CASE WHEN date_sub('second', max(ts), TIMESTAMP '2024-02-01') > 172800 THEN 'error'
                    WHEN date_sub('second', max(ts), TIMESTAMP '2024-02-01') > 86400 THEN 'warn' ELSE 'pass' END AS status
        FROM events""",
    "freshness_filtered": """
        SELECT max(ts) AS max_loaded_at, TIMESTAMP '2024-02-01' AS snapshotted_at,
               date_sub('second', max(ts), TIMESTAMP '2024-02-01') AS age_seconds, 'error' AS status
        FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-20'""",
    "contract": _ENRICHED,
    "compare_with_expected": sql("""
        SELECT * FROM (
            (SELECT order_id, count(*) AS n, 'actual' AS actual_or_expected FROM order_pays GROUP BY order_id
             EXCEPT ALL SELECT order_id, count(*), 'actual' FROM order_pays WHERE payment_type <> 'R' GROUP BY order_id)
            UNION ALL
            (SELECT order_id, count(*), 'expected' FROM order_pays WHERE payment_type <> 'R' GROUP BY order_id
             EXCEPT ALL SELECT order_id, count(*), 'expected' FROM order_pays GROUP BY order_id))"""),
}
