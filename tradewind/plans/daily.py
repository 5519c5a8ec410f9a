"""The daily run: raw files to tables, cleaning, star schema, analytics, with checks in between."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tradewind.operators import quality
from tradewind.operators.incremental import Incremental
from tradewind.plans import customers, declared, orders, products, sellers
from tradewind.plans.models import Context, Model, build_all
from tradewind.plans.params import Params, Run
from tradewind.plans.staging import clean, clean_sql, with_audit
from tradewind.sources.raw import load_bronze
from tradewind.sources.schemas import COLUMNS
from tradewind.sources.tables import TimePartition, Warehouse

BY_DAY = TimePartition("order_purchase_timestamp", "day")
CLUSTER = ("order_status", "customer_id")


def _staging(table: str) -> Model:
    # stored and listed under the short name of the translation table
    name = "stg_product_category_translation" if table == "product_category_name_translation" else f"stg_{table}"
    return Model(name, lambda c, s: clean(table, c.source(table), c.run), "view", "silver",
                 sql=lambda c: clean_sql(table, c.warehouse.full_name(f"bronze.{table}"), c.run))


def _plain(c: Context, name: str) -> DataFrame:
    """A model without its audit columns."""
    return c.ref(name).drop(*(c.run.columns if c.run else ()))


def _orders_fact(c: Context, spark) -> DataFrame:
    placed, payments, items = _plain(c, "stg_orders"), c.ref("stg_order_payments"), c.ref("stg_order_items")
    if c.is_incremental:
        # only the payments and items of new orders need to be aggregated
        placed = c.newer(placed, "order_purchase_timestamp")
        payments = payments.join(placed.select("order_id"), "order_id", "left_semi")
        items = items.join(placed.select("order_id"), "order_id", "left_semi")
    enriched = orders.enriched_orders(
        placed, orders.order_payments(payments, c.params), orders.order_items_aggregated(items, c.params))
    return with_audit(enriched, c.run)


STAGING = [_staging(t) for t in COLUMNS]

INTERMEDIATE = [
    Model("order_payments", lambda c, s: orders.order_payments(c.ref("stg_order_payments"), c.params), "inline"),
    Model("order_items_agg", lambda c, s: orders.order_items_aggregated(c.ref("stg_order_items"), c.params), "inline"),
    Model("orders_enriched", lambda c, s: orders.enriched_orders(
        _plain(c, "stg_orders"), c.ref("order_payments"), c.ref("order_items_agg")), "inline"),
    Model("customer_history", lambda c, s: customers.customer_history(c.ref("orders_enriched"), c.params), "inline"),
    Model("products_with_categories", lambda c, s: products.products_with_categories(
        _plain(c, "stg_products"), c.ref("stg_product_category_translation"), c.params), "inline"),
    Model("sellers_with_locations", lambda c, s: sellers.sellers_with_locations(
        _plain(c, "stg_sellers"), c.ref("stg_geolocations")), "inline"),
]

CORE = [
    Model("dim_customers", lambda c, s: with_audit(customers.customer_dimension(
        _plain(c, "stg_customers"), c.ref("customer_history"), c.params), c.run)),
    Model("dim_products", lambda c, s: with_audit(products.product_dimension(c.ref("products_with_categories")), c.run)),
    Model("dim_sellers", lambda c, s: with_audit(sellers.seller_dimension(c.ref("sellers_with_locations")), c.run)),
    Model("fct_orders", _orders_fact, "incremental", how=Incremental("merge", ("order_id",), BY_DAY, CLUSTER)),
    Model("fct_order_items", lambda c, s: with_audit(orders.order_items_fact(
        _plain(c, "stg_order_items"), c.ref("stg_orders"), c.ref("products_with_categories"),
        c.ref("sellers_with_locations")), c.run),
        "incremental", how=Incremental("merge", ("order_id", "order_item_id"), BY_DAY, CLUSTER)),
]

ANALYTICS = [
    Model("customer_metrics", lambda c, s: customers.customer_metrics(
        c.ref("fct_orders"), c.ref("stg_reviews"), c.ref("dim_customers"), c.params)),
    Model("product_performance", lambda c, s: with_audit(products.product_performance(
        c.ref("dim_products"), c.ref("fct_order_items"), c.params), c.run)),
    Model("seller_performance", lambda c, s: with_audit(sellers.seller_performance(
        c.ref("dim_sellers"), c.ref("fct_order_items"), c.params), c.run)),
]

GOLD_TABLES = tuple(m.name for m in (*CORE, *ANALYTICS))


@dataclass
class Outcome:
    verdicts: list
    report: DataFrame


def run_daily(warehouse: Warehouse, raw_folder: str, run: Run, *, files: Mapping[str, str] | None = None,
              params: Params = Params(), full_refresh: bool = False, extra_models: Iterable[Model] = (),
              multiline: bool | str = "blocks", load: bool = True) -> Outcome:
    """One run. A failed check raises before the next layer is built. What a job that writes a table can count on the way (rows, NULLs,
    values out of bounds) is not looked for again."""
    extra = list(extra_models)
    context = Context(warehouse, [*STAGING, *INTERMEDIATE, *CORE, *ANALYTICS, *extra], run, params, full_refresh, declared.GOLD)
    loaded = load_bronze(warehouse, raw_folder, files, multiline=multiline) if load else {}
    bronze = {f"bronze.{t}": warehouse.read(f"bronze.{t}") for t in COLUMNS}
    quality.require_rows(bronze, {f"bronze.{t}": n for t, n in loaded.items()})

    build_all([STAGING], context)
    silver = {m.name: context.ref(m.name) for m in STAGING}
    quality.require_rows(silver)
    verdicts = quality.require(quality.declared_verdicts(silver, declared.STAGING))

    inline = {m.name: context.ref(m.name) for m in INTERMEDIATE}
    verdicts += quality.require(quality.declared_verdicts({**silver, **inline}, declared.INTERMEDIATE))
    build_all([CORE, ANALYTICS, extra], context)
    gold = {t: context.ref(t) for t in GOLD_TABLES}
    quality.require_rows(gold, {t: seen["rows"] for t, seen in context.observed.items() if "rows" in seen})
    verdicts += quality.require(quality.declared_verdicts(gold, declared.GOLD, context.observed).unionByName(quality.run_checks([
        quality.Check("delivered_order_has_items", quality.delivered_without_items(gold["fct_orders"], gold["fct_order_items"])),
        quality.Check("no_negative_order_value", quality.negative_order_values(gold["fct_orders"])),
    ])))
    quality.require_consistent_orders(bronze["bronze.orders"], silver["stg_orders"], gold["fct_orders"])
    report = quality.row_counts({
        **bronze, **{f"silver.{n}": d for n, d in silver.items()}, **{f"gold.{n}": d for n, d in gold.items()}})
    return Outcome(verdicts, report)
