"""Checks on small frames, verdict rules, stored failures, contracts."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewind.operators import quality
from tradewind.operators.quality import Check, CheckFailed, ColumnRule
from tradewind.sources.tables import Warehouse


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, None), ("b", 200)], "k string, v int").cache()


def rows(frame):
    return sorted([tuple(r) for r in frame.collect()], key=str)


def test_rows_of_checks(spark, df):
    assert rows(quality.unique(df, "k")) == [("a", 2)]
    assert rows(quality.not_null(df, "k")) == [(None,), (None,)]
    assert rows(quality.not_null(df, "k", whole_rows=True)) == [(None, 3), (None, None)]
    assert rows(quality.accepted_values(df, "k", ["a"])) == [("b", 1)]
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert rows(quality.relationships(df, "k", parent, "id")) == [("b",)]
    assert rows(quality.between(df, "v", 1, 3)) == [("b", 200)]
    assert rows(quality.between(df, "v", low=2)) == [("a", 1)] and quality.between(df, "v").count() == 0
    assert rows(quality.minimum_at_least(df, "v", 2)) == [(1,)] and quality.minimum_at_least(df, "v", 1).isEmpty()
    assert rows(quality.row_count_mismatch(df, parent)) == [(2,)] and quality.row_count_mismatch(df, df).isEmpty()


def test_many_columns(df):
    assert rows(quality.aggregated_not_null(df, ["k", "v"])) == [("k", 2, True, True), ("v", 1, True, True)]
    assert rows(quality.aggregated_not_null(df, ["k", "v"], skip=["k"])) == [("v", 1, True, True)]
    assert rows(quality.aggregated_unique(df, ["k", "v"])) == [("k", 1, True, True)]


def test_verdicts(df):
    bad = quality.not_null(df, "k", whole_rows=True)
    got = {r.test: (r.failures, r.should_warn, r.should_error) for r in quality.run_checks([
        Check("plain", bad), Check("warn", bad, severity="warn"), Check("high", bad, warn_if="> 1", error_if="> 2"),
        Check("where", bad, where="v = 3"), Check("limit", bad, limit=1), Check("calc", bad, fail_calc="coalesce(max(v), 0)"),
        Check("none", bad.where("false")),
    ]).collect()}
    assert got == {"plain": (2, True, True), "warn": (2, True, False), "high": (2, True, False), "where": (1, True, True),
                   "limit": (1, True, True), "calc": (3, True, True), "none": (0, False, False)}
    with pytest.raises(CheckFailed, match="plain"):
        quality.require(quality.run_checks([Check("plain", bad)]))
    assert len(quality.require(quality.run_checks([Check("warn", bad, severity="warn")]))) == 1


def test_declared_equals_single_checks(spark, df):
    parent = spark.createDataFrame([("a",)], "id string")
    declared = {"t": {"k": ColumnRule(unique=True, not_null=True, accepted=("a",), parent=("p", "id")),
                      "v": ColumnRule(not_null=True, low=0, high=100, range_severity="warn")}}
    got = {r.test: (r.failures, r.should_error) for r in quality.declared_verdicts({"t": df, "p": parent}, declared).collect()}
    assert got == {"unique_t_k": (1, True), "not_null_t_k": (2, True), "accepted_values_t_k": (1, True),
                   "relationships_t_k": (1, True), "not_null_t_v": (1, True), "between_t_v": (1, False)}


def test_store_failures(spark, df, tmp_path):
    wh = Warehouse(spark, str(tmp_path), {"audit": "audit_q"})
    quality.store_failures(wh, "audit.bad", quality.not_null(df, "k", whole_rows=True))
    assert wh.read("audit.bad").count() == 2
    quality.store_failures(wh, "audit.bad_view", quality.not_null(df, "v"), "view")
    assert wh.read("audit.bad_view").count() == 1
    with pytest.raises(ValueError):
        quality.store_failures(wh, "audit.x", df, "ephemeral")


def test_freshness(spark):
    now = datetime(2024, 1, 3)
    df = spark.createDataFrame([(datetime(2024, 1, 1, 12), "x"), (datetime(2023, 1, 1), "y")], "at timestamp, k string")
    status = lambda **kw: quality.freshness(df, "at", now, **kw).first()
    assert tuple(status(warn_after=timedelta(hours=24), error_after=timedelta(hours=48)))[2:] == (36 * 3600, "warn")
    assert status(warn_after=timedelta(hours=36)).status == "pass"
    assert status(error_after=timedelta(hours=48), where="k = 'y'").status == "error"
    assert status(error_after=timedelta(hours=48), where="k = 'z'").status == "error"


def test_contract(df):
    same = StructType.fromDDL("v int, k string")
    assert quality.require_contract(df, same).columns == ["v", "k"]
    for bad in ("k string", "k string, v bigint", "k string, v int, w int", "k string, x int"):
        with pytest.raises(CheckFailed):
            quality.require_contract(df, StructType.fromDDL(bad))


def test_compare(spark, df):
    assert quality.compare_with_expected(df, df.select("v", "k")).isEmpty()
    other = df.where("k is not null").unionByName(df.where("v = 200"))
    assert rows(quality.compare_with_expected(df, other)) == [("b", 200, "expected"), (None, 3, "actual"), (None, None, "actual")]


def test_layers(spark, df):
    empty = df.where("false")
    counts = quality.row_counts({"bronze.a": df, "bronze._ext_a": df, "gold.b": empty})
    assert rows(counts) == [("bronze", "a", 5), ("gold", "b", 0)]
    quality.require_rows({"a": df})
    with pytest.raises(CheckFailed, match="b"):
        quality.require_rows({"a": df, "b": empty})
    quality.require_consistent_orders(df, df, empty)
    with pytest.raises(CheckFailed):
        quality.require_consistent_orders(df, empty, empty)
    with pytest.raises(CheckFailed):
        quality.require_consistent_orders(empty, empty, df)
    orders = spark.createDataFrame([("o1", "delivered", -1.0), ("o2", "delivered", 1.0), ("o3", "shipped", None)], "order_id string, order_status string, total_payment_value double")
    items = spark.createDataFrame([("o2",), ("o2",), (None,)], "order_id string")
    assert rows(quality.delivered_without_items(orders, items)) == [("o1",)]
    assert quality.negative_order_values(orders).count() == 1
