"""The daily run over hand-made CSV files: first run, an incremental second run, and failing checks."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradewind.operators import quality
from tradewind.plans import declared
from tradewind.plans.daily import GOLD_TABLES, run_daily
from tradewind.plans.models import Context, Model, build_model
from tradewind.plans.params import Run
from tradewind.operators.incremental import Incremental
from tradewind.sources.raw import load_bronze, load_seed, raw_table
from tradewind.sources.tables import Warehouse

FILES = {
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01001,"\tsao paulo  ",SP
c2,u2,01002,rio,RJ
c3,u3,99999,"a ""quoted"", city",MG
""",
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2024-01-01 10:00:00,2024-01-01 11:59:00,2024-01-02 00:00:00,2024-01-03 09:59:59,2024-01-03 09:59:59
o2,c1,delivered,2024-01-02 10:00:00,,,2024-02-03 00:00:00,2024-01-10 00:00:00
o3,c2,canceled,2024-01-02 12:00:00,2024-01-02 12:10:00,,,2024-01-10 00:00:00
o4,c2,shipped,2024-01-03 12:00:00
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2024-01-05 00:00:00,10.10,1.05
o1,2,p1,s1,2024-01-05 00:00:00,10.10,1.05
o2,1,p2,s2,2024-01-05 00:00:00,99.90,0
o4,1,p2,s1,2024-01-05 00:00:00,5,2.5
""",
    "order_payments": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,voucher,1,2.30
o1,2,credit_card,3,20.00
o1,3,voucher,1,0
o2,1,boleto,1,99.90
o3,1,,1,7
""",
    "reviews": """review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,5,good,"line one
line two",2024-01-04 00:00:00,2024-01-05 00:00:00
r1,o2,2,,,2024-01-04 00:00:00,2024-01-05 00:00:00
r2,o1,4,ok,fine,2024-01-04 00:00:00,2024-01-05 00:00:00
""",
    "products": """product_id,product_category_name,n,d,q,w,l,h,b
p1,beleza,10,20,1,100,2000,2000,2000
p2,unheard_of,10,20,1,100,2,3,
p3,,,,,,,,
""",
    "sellers": """seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,01001,sao paulo,SP
s2,55555,nowhere,XX
s3,01001,sao paulo,SP
""",
    "geolocations": """zip,lat,lng,city,state
01001,-23.5,-46.6,b,SP
01001,-23.6,-46.7,a,SP
01001,,-50,c,SP
""",
    "product_category_name_translation": "﻿product_category_name,product_category_name_english\nbeleza,health_beauty",
}


def write(folder, **changes):
    for name, text in {**FILES, **changes}.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def by(df, key, *cols):
    return {r[key]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("daily")
    wh = Warehouse(spark, str(base / "wh"), {"bronze": "d_bronze", "silver": "d_silver", "gold": "d_gold"})
    (base / "raw").mkdir()
    first = run_daily(wh, write(base / "raw"), Run(datetime(2024, 1, 4), "run-1"))
    return wh, base, first


def test_first_run(built):
    wh, _, outcome = built
    assert len([v for v in outcome.verdicts]) == 62 + 2
    report = {(r.layer, r.table_name): r.row_count for r in outcome.report.collect()}
    assert report["bronze", "orders"] == report["silver", "stg_orders"] == report["gold", "fct_orders"] == 4
    assert len(report) == 9 + 9 + 8


def test_cleaning(built):
    wh, _, _ = built
    assert by(wh.read("silver.stg_customers"), "customer_id", "customer_city", "customer_zip_code_prefix") == {
        "c1": ("sao paulo", "01001"), "c2": ("rio", "01002"), "c3": ('a "quoted", city', "99999")}
    assert wh.read("silver.stg_reviews").where("review_comment_message = 'line one\nline two'").count() == 1
    assert wh.read("silver.stg_orders").where("order_id = 'o4' and order_estimated_delivery_date is null").count() == 1
    assert {r["_run_id"] for r in wh.read("silver.stg_sellers").collect()} == {"run-1"}
    assert wh.read("bronze.product_category_name_translation").columns == ["product_category_name", "product_category_name_english"]


def test_orders(built):
    wh, _, _ = built
    got = by(wh.read("gold.fct_orders"), "order_id", "total_payment_value", "payment_count", "max_installments",
             "payment_methods_used", "unique_products", "total_items", "order_total", "delivery_days", "delivery_status",
             "hours_to_approval")
    assert got["o1"] == (pytest.approx(22.3), 3, 3, "credit_card, voucher", 1, 2, pytest.approx(22.3), 1, "On Time", 1)
    assert got["o2"] == (99.9, 1, 1, "boleto", 1, 1, 99.9, 31, "Delayed", None)
    assert got["o3"] == (7.0, 1, 1, None, 0, 0, 0.0, None, "Not Delivered", 0)
    assert got["o4"] == (0.0, 0, None, None, 1, 1, 7.5, None, "Not Delivered", None)
    assert wh.partition_columns("gold.fct_orders") == ["order_purchase_timestamp_day"]
    assert "order_purchase_timestamp_day" not in wh.read("gold.fct_orders").columns


def test_dimensions(built):
    wh, _, _ = built
    assert by(wh.read("gold.dim_customers"), "customer_id", "total_orders", "total_spend", "days_since_first_order", "customer_segment") == {
        "c1": (2, pytest.approx(122.2), 1, "Repeat"), "c2": (1, 0.0, 0, "One-time"), "c3": (0, 0.0, 0, "No Orders")}
    assert by(wh.read("gold.dim_products"), "product_id", "product_category_name_english", "product_volume_cm3") == {
        "p1": ("health_beauty", 8_000_000_000), "p2": ("Unknown", None), "p3": ("Unknown", None)}
    assert by(wh.read("gold.dim_sellers"), "seller_id", "seller_lat", "seller_lng") == {
        "s1": (-23.6, -46.7), "s2": (None, None), "s3": (-23.6, -46.7)}


def test_analytics(built):
    wh, _, _ = built
    assert by(wh.read("gold.customer_metrics"), "customer_id", "total_orders", "customer_lifetime_days", "delivered_orders",
              "canceled_orders", "cancellation_rate", "total_reviews", "avg_review_score", "customer_segment") == {
        "c1": (2, 1, 2, 0, 0.0, 2, pytest.approx(11 / 3), "Repeat"), "c2": (2, 1, 0, 1, 0.5, 0, None, "Repeat")}
    assert by(wh.read("gold.product_performance"), "product_id", "total_orders", "total_items_sold", "total_revenue", "unique_sellers", "product_performance_tier") == {
        "p1": (1, 2, 20.2, 1, "Low Volume"), "p2": (2, 2, pytest.approx(104.9), 2, "Low Volume"), "p3": (0, 1, None, 0, "Low Volume")}
    assert by(wh.read("gold.seller_performance"), "seller_id", "total_orders", "total_items_sold", "unique_products_sold", "unique_categories", "unique_customers", "days_active", "avg_item_price") == {
        "s1": (2, 3, 2, 2, 2, 2, pytest.approx(25.2 / 3)), "s2": (1, 1, 1, 1, 1, 0, 99.9), "s3": (0, 1, 0, 0, 0, None, None)}


def test_second_run_adds_new_orders(built):
    wh, base, _ = built
    late = "o0,c3,shipped,2024-01-01 00:00:00\n"
    new = "o5,c3,delivered,2024-01-09 12:00:00,,,2024-01-10 11:00:00,2024-01-11 00:00:00\n"
    folder = base / "raw2"
    folder.mkdir()
    write(folder, orders=FILES["orders"].replace("o4,c2,shipped", "o4,c2,canceled") + late + new,
          order_items=FILES["order_items"] + "o5,1,p3,s3,2024-01-05 00:00:00,1,1\n")
    run_daily(wh, str(folder), Run(datetime(2024, 1, 10), "run-2"))
    got = by(wh.read("gold.fct_orders"), "order_id", "order_status", "_run_id")
    # the late order and the changed status stay below the high-water mark
    assert got == {**{o: (s, "run-1") for o, s in [("o1", "delivered"), ("o2", "delivered"), ("o3", "canceled"), ("o4", "shipped")]},
                   "o5": ("delivered", "run-2")}
    items = by(wh.read("gold.fct_order_items"), "order_id", "order_status", "_run_id")
    assert items["o4"] == ("canceled", "run-2") and items["o5"] == ("delivered", "run-2")
    run_daily(wh, str(folder), Run(datetime(2024, 1, 11), "run-3"), full_refresh=True)
    assert wh.read("gold.fct_orders").count() == 6


def test_checks_stop_the_run(built, tmp_path):
    wh = Warehouse(built[0].spark, str(tmp_path / "wh"), {"bronze": "e_bronze", "silver": "e_silver", "gold": "e_gold"})
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw, order_items=FILES["order_items"] + "nope,1,p1,s1,2024-01-05 00:00:00,1,1\n")
    with pytest.raises(quality.CheckFailed, match="relationships_stg_order_items_order_id"):
        run_daily(wh, str(raw), Run(datetime(2024, 1, 4), "x"))
    assert not any(wh.exists(f"gold.{t}") for t in GOLD_TABLES)
    write(raw, orders=FILES["orders"].replace("2024-01-01 10:00:00", "not a time"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_daily(wh, str(raw), Run(datetime(2024, 1, 4), "x"))
    write(raw, sellers="seller_id,zip,city,state\n")
    with pytest.raises(quality.CheckFailed, match="bronze.sellers"):
        run_daily(wh, str(raw), Run(datetime(2024, 1, 4), "x"))


def test_declared_counts():
    assert declared.count_by_kind() == {"unique": 17, "not_null": 33, "relationships": 8, "accepted_values": 1, "between": 3}


def test_python_models(spark, tmp_path):
    import pandas as pd

    wh = Warehouse(spark, str(tmp_path), {"gold": "py_gold"})
    small = Model("small", lambda c, s: pd.DataFrame({"id": [1, 2], "v": [c.config["v"], 3]}), config={"v": 9})
    doubled = Model("doubled", lambda c, s: (
        c.ref("small").where(F.col("id") > c.this.agg(F.max("id")).first()[0]) if c.is_incremental else c.ref("small").where("id = 1")
    ), "incremental", how=Incremental("append"))
    ctx = Context(wh, [small, doubled])
    for m in (small, doubled, doubled):
        build_model(m, ctx)
    assert sorted(r.v for r in wh.read("gold.doubled").collect()) == [3, 9]
    with pytest.raises(ValueError):
        Model("x", lambda c, s: None, "nonsense")


def test_seed(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), {"gold": "seed_gold"})
    path = tmp_path / "s.csv"
    path.write_text("zip;n\n01;1\n02;2\n")
    load_seed(wh, "gold.seed", str(path), delimiter=";", column_types={"zip": "string"})
    assert dict(wh.read("gold.seed").dtypes) == {"zip": "string", "n": "int"}
    assert {r.zip for r in wh.read("gold.seed").collect()} == {"01", "02"}
    path.write_text("zip;n\n03;3\n")
    load_seed(wh, "gold.seed", str(path), delimiter=";", column_types={"zip": "string", "n": "bigint"})
    assert dict(wh.read("gold.seed").dtypes)["n"] == "int" and wh.read("gold.seed").count() == 1
    load_seed(wh, "gold.seed", str(path), delimiter=";", column_types={"zip": "string", "n": "bigint"}, full_refresh=True)
    assert dict(wh.read("gold.seed").dtypes)["n"] == "bigint"
