"""Plans and skew: what must hold at any size."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tradewind.catalog.bound import Bound
from tradewind.functions import aggregates
from tradewind.operators import incremental as inc, merge, sets
from tradewind.operators.incremental import Incremental
from tradewind.plans import orders, products, sellers
from tradewind.plans.params import Params
from tradewind.sources.tables import TimePartition, Warehouse

SMALL = "/root/testdata/sf0.001"
# queries whose plan is built only after writing tables or running a stream
WRITERS = {"stored_merge", "stored_overwrite", "stream_upsert", "stream_replace_days", "stream_day_totals"}


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def settings(spark):
    before = {}

    def change(**kv):
        for k, v in kv.items():
            key = "spark.sql." + k.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, v)

    yield change
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {"autoBroadcastJoinThreshold": "-1", "adaptive__autoBroadcastJoinThreshold": "-1"}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - WRITERS))
def test_no_query_pairs_rows_or_runs_python_per_row(spark, settings, name):
    settings(**NO_BROADCAST)
    text = plan(entry.queries()[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in text
    # without broadcasts nothing may need one: a hand-made hint would show here
    assert "BroadcastExchange" not in text
    # a window over the whole table would gather it in one task
    assert not re.search(r"Window .*\n.*Exchange SinglePartition", text)


def test_scans_read_only_needed_columns(spark):
    text = plan(Bound(spark, SMALL).order_payments())
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double,l_returnflag:string>" in text
    text = plan(Bound(spark, SMALL).customer_metrics())
    assert "p_type" not in text and "l_shipdate" not in text.split("== Physical Plan ==")[1]


def test_limited_list_cuts_groups_before_the_shuffle(spark):
    text = plan(aggregates.listagg_first(spark.read.parquet(f"{SMALL}/events.parquet"), ["user_id"], "event_type", ",", ["ts"], 5))
    physical = text.split("== Physical Plan ==")[1]
    assert physical.count("WindowGroupLimit") == 2
    assert physical.rindex("WindowGroupLimit") > physical.index("Exchange")


def test_watermark_reaches_the_scan_and_reads_one_partition(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), {"gold": "scale_mark"})
    day = TimePartition("at", "day")
    rows = spark.range(100).select(F.col("id"), F.timestamp_add("DAY", F.col("id").cast("int"), F.lit(datetime(2024, 1, 1))).alias("at"))
    wh.write_table("gold.t", rows, day)
    assert inc.highest(wh, "gold.t", "at", day) == datetime(2024, 4, 9)
    newest = max(wh.partition_values("gold.t"))
    read = wh.read("gold.t", technical=True).where(F.col("at_day") == F.lit(newest))
    assert len(read.inputFiles()) == 1 and "PartitionFilters: [isnotnull(at_day" in plan(read)
    source = tmp_path / "source"
    rows.write.parquet(str(source))
    newer = inc.newer_than_table(wh, "gold.t", spark.read.parquet(str(source)), "at", day)
    assert re.search(r"PushedFilters: \[IsNotNull\(at\), GreaterThan\(at,", plan(newer))


def hot_items(spark, n=60_000):
    """A third of all items belong to one order, one product and one seller."""
    hot = F.col("id") % 3 == 0
    return spark.range(n, numPartitions=8).select(
        F.when(hot, "hot").otherwise((F.col("id") % 5000).cast("string")).alias("order_id"),
        F.col("id").alias("order_item_id"),
        F.when(hot, F.when(F.col("id") % 2 == 0, "p_hot").otherwise((F.col("id") % 9000).cast("string")))
        .otherwise((F.col("id") % 300).cast("string")).alias("product_id"),
        F.when(hot, "s_hot").otherwise((F.col("id") % 50).cast("string")).alias("seller_id"),
        F.lit(1.25).alias("price"), F.lit(0.5).alias("freight_value"),
    )


def hot_orders(spark):
    ids = spark.range(5000).select(F.col("id").cast("string").alias("order_id")).unionByName(
        spark.createDataFrame([("hot",)], "order_id string"))
    return ids.select("order_id", F.concat(F.lit("c"), F.col("order_id")).alias("customer_id"), F.lit("delivered").alias("order_status"),
                      F.lit(datetime(2024, 1, 1)).alias("order_purchase_timestamp"))


def test_hot_order_join_is_split(spark, settings):
    settings(**NO_BROADCAST, adaptive__skewJoin__skewedPartitionThresholdInBytes="2k",
             adaptive__skewJoin__skewedPartitionFactor="2", adaptive__advisoryPartitionSizeInBytes="2k",
             adaptive__coalescePartitions__enabled="false")
    items = hot_items(spark)
    fact = orders.items_with_orders(items, hot_orders(spark))
    totals = fact.groupBy("seller_id").agg(F.count("*").alias("n"), F.count("customer_id").alias("known"), F.sum("order_item_id").alias("ids"))
    got = {r.seller_id: (r.n, r.known) for r in totals.collect()}
    assert got["s_hot"] == (20_000, 20_000) and sum(n for n, _ in got.values()) == 60_000
    assert "skew=true" in totals._jdf.queryExecution().executedPlan().toString()


def test_hot_groups_give_whole_results(spark):
    p = Params(money_scale=2)
    items = hot_items(spark)
    agg = {r.order_id: r for r in orders.order_items_aggregated(items, p).collect()}
    want = items.where("order_id = 'hot'").agg(F.count_distinct("product_id")).first()[0]
    assert agg["hot"].unique_products == want and agg["hot"].total_items == 20_000
    assert agg["hot"].total_item_value == 25_000.0 and agg["hot"].order_total == 35_000.0
    fact = orders.items_with_orders(items, hot_orders(spark))
    dim = items.select("product_id").distinct().select(
        "product_id", F.lit("x").alias("product_category_name_english"), F.lit(1).alias("product_weight_g"), F.lit(1).alias("product_volume_cm3"))
    perf = {r.product_id: r for r in products.product_performance(dim, fact, p).collect()}
    assert perf["p_hot"].total_items_sold == 10_000 and perf["p_hot"].total_revenue == 12_500.0
    assert sum(r.total_items_sold for r in perf.values()) == 60_000


def test_repeated_dimension_rows_repeat_sales(spark):
    """Joining sums to a dimension equals joining first, also where the dimension repeats a row."""
    fact = orders.items_with_orders(hot_items(spark, 600), hot_orders(spark)).withColumn("product_category_name_english", F.lit("x"))
    one = spark.createDataFrame([("s_hot", "a"), ("s_hot", "a"), ("s_hot", "b"), ("1", "a"), ("none", "z"), ("none", "z"), (None, "n")],
                                "seller_id string, seller_city string")
    dim = one.select("*", F.lit("S").alias("seller_state"), F.lit(1.0).alias("seller_lat"), F.lit(2.0).alias("seller_lng"))
    keys = ["seller_id", "seller_city", "seller_state", "seller_lat", "seller_lng"]
    direct = dim.join(fact.drop("seller_city"), "seller_id", "left").groupBy(*keys).agg(
        F.count_distinct("order_id").alias("total_orders"), F.count("*").alias("total_items_sold"),
        F.sum("price").alias("total_revenue"), F.avg("price").alias("avg_item_price"))
    got = sellers.seller_performance(dim, fact, Params(money_scale=2)).select(*direct.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, direct.collect()), key=str)


def test_repeats_combine_before_the_shuffle_of_set_operations(spark):
    a = spark.range(100_000, numPartitions=8).select((F.col("id") % 3).alias("k"))
    b = spark.range(1000).select((F.col("id") % 2).alias("k"))
    out = sets.except_distinct(a, b)
    assert [r.k for r in out.collect()] == [2]
    assert plan(out).split("== Physical Plan ==")[1].count("Exchange hashpartitioning") <= 2


def test_merge_by_key_reads_and_writes_only_touched_buckets(spark, tmp_path):
    """In a table partitioned by its key no scan looks for matched rows: a few changed rows are broadcast to the
    partitions they belong to, whose stored rows are not shuffled before they are laid out again."""
    from tradewind.sources.tables import KeyPartition

    wh = Warehouse(spark, str(tmp_path), {"gold": "scale_keys"})
    by = KeyPartition(("id",), 32)
    how = Incremental("merge", ("id",), by)
    wh.write_table("gold.t", spark.range(5000).selectExpr("id", "'old' AS status"), by)
    files = lambda: {r[0]: r[1] for r in wh.read("gold.t", technical=True).select("_key_bucket", "_metadata.file_path").distinct().collect()}
    before, changed = files(), []
    replace = wh.replace_partitions

    def watched(table, rows, *rest):
        changed.append(plan(rows).split("== Physical Plan ==")[1])
        return replace(table, rows, *rest)

    wh.replace_partitions = watched
    inc.apply(wh, "gold.t", spark.createDataFrame([(7, "new"), (4000, "new"), (9999, "added")], "id long, status string"), how)
    after = files()
    assert len([b for b in before if before[b] != after[b]]) <= 3 and len(before) == len(after) == 32
    assert wh.read("gold.t").count() == 5001 and wh.read("gold.t").where("status <> 'old'").count() == 3
    assert re.search(r"PartitionFilters: \[.*_key_bucket#\d+ IN", changed[0]) and "BroadcastHashJoin" in changed[0] and "Exchange hashpartitioning(id" not in changed[0].split("Union")[1].split("FileScan")[0]
    assert wh.layout("gold.t") == (by, ())
    # keys that are not whole in the hash: the table's keys are read
    inc.apply(wh, "gold.t", spark.createDataFrame([(7, "again")], "id long, status string"), Incremental("delete_insert", ("status",), by))
    assert wh.read("gold.t").where("id = 7").count() == 2


def test_merge_with_many_missing_keys(spark):
    rows = lambda n, v: spark.range(n).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.lit(v).alias("v"), F.col("id").alias("i"))
    out = merge.merge_rows(rows(2000, "old"), rows(3000, "new"), "k", update=["v"])
    assert out.count() == 1000 + 1000 + 500 + 1500  # matched, old and new rows without a key, added
    assert out.where("k IS NULL").count() == 2500 and out.where("v = 'new' AND k < 2000").count() == 1000


def test_history_closed_versions_are_not_rewritten(spark, tmp_path):
    from tradewind.operators.history import Tracking, apply_history

    wh = Warehouse(spark, str(tmp_path), {"gold": "scale_hist"})
    how = Tracking(("id",), updated_at="at")
    state = lambda day: spark.range(50).select("id", F.lit(datetime(2024, 1, day)).alias("at"))
    files = lambda: {r[0] for r in wh.read("gold.h").where("_open_bucket < 0").select("_metadata.file_path").distinct().collect()}
    for day in (1, 2):
        apply_history(wh, "gold.h", state(day), how, datetime(2024, 1, day))
    before = files()
    apply_history(wh, "gold.h", state(3), how, datetime(2024, 1, 3))
    assert before and before < files()
    assert wh.read("gold.h").count() == 150


def test_working_folder_on_a_cluster(spark, monkeypatch):
    from tradewind import session

    assert session.working_folder(spark) == spark.conf.get("spark.checkpoint.dir")

    class Conf:
        get = staticmethod(lambda key, default=None: None)

    class Context:
        master = "yarn"

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.working_folder(Cluster())


def test_replaced_partitions_are_not_read_again(spark, tmp_path, monkeypatch):
    """January is replaced row by row, February in part; only the old rows of February meet the new ones."""
    wh, how = Warehouse(spark, str(tmp_path), {"gold": "scale_gone"}), Incremental("merge", ("id",), TimePartition("at", "month"))
    rows = spark.range(60).select("id", F.timestamp_add("DAY", F.col("id").cast("int"), F.lit(datetime(2024, 1, 1))).alias("at"), F.lit("old").alias("v"))
    whole, seen = merge.merge_rows, []
    monkeypatch.setattr(merge, "merge_rows", lambda old, *a, **k: seen.append(old.count()) or whole(old, *a, **k))
    for kind in (True, False):
        wh.write_table("gold.t", rows, how.partition)
        inc.apply(wh, "gold.t", rows.where("id < 40").withColumn("v", F.lit("new")), Incremental("merge", ("id",), how.partition, stage=kind))
        assert {r.id: r.v for r in wh.read("gold.t").collect()} == {i: "new" if i < 40 else "old" for i in range(60)}
    assert seen == [29, 29]
    # columns that keep their value are read from the old rows
    inc.apply(wh, "gold.t", rows.where("id < 40").select("id", "at", F.lit("third").alias("v")), Incremental("merge", ("id",), how.partition, update=("v",)))
    assert seen[-1] == 60 and wh.read("gold.t").where("v = 'third'").count() == 40


@pytest.mark.parametrize("name", ["stored_fct_orders", "stored_fct_order_items"])
def test_facts_of_two_runs_are_joined_once(spark, monkeypatch, name):
    files, build = [], inc.build
    monkeypatch.setattr(inc, "build", lambda wh, t, rows, how: build(wh, t, lambda change: files.append(rows(change).inputFiles()) or rows(change), how))
    assert entry.queries()[name](spark, SMALL).count() > 0
    assert len(files) == 2 and not [f for run in files for f in run if "lineitem" in f or "orders.parquet" in f]


def test_pairs_of_seller_and_product_meet_after_the_shuffle(spark):
    items = spark.read.schema("seller_id string, product_id string").parquet(f"{SMALL}/lineitem.parquet")
    text = plan(sellers.assortment(items, spark.createDataFrame([("p", "c")], "product_id string, product_category_name_english string")))
    below = text.split("== Physical Plan ==")[1].split("REPARTITION_BY_COL")[1].split("FileScan")[0]
    assert "Aggregate" not in below


def test_tasks_read_small_parts_of_a_shuffle(spark, settings):
    settings(adaptive__advisoryPartitionSizeInBytes="64m")
    entry.queries()["declared_layers"](spark, SMALL)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def kept_shuffles(spark, before, seconds=10):
    """Shuffle files that are new and stay: executors delete those of an ended job a moment later."""
    import time

    until = time.time() + seconds
    while (new := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return new


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    from tradewind.session import FREE_SHUFFLES, fixed, staged

    wh, rows = Warehouse(spark, str(tmp_path), {"gold": "scale_free"}), spark.range(3000).selectExpr("id", "id % 7 AS k", "'x' AS v")
    total = rows.groupBy("k").agg(F.count("*").alias("n"))
    before, was = shuffle_files(spark), spark.conf.get(FREE_SHUFFLES)
    wh.write_table("gold.t", total)
    wh.append("gold.t", total)
    wh.write_table("gold.by", rows, None, ("k",))
    inc.apply(wh, "gold.by", rows.where("k = 3").withColumn("v", F.lit("new")), Incremental("merge", ("id",)))
    with staged(total), staged(total):
        kept = fixed(total)
    assert not kept_shuffles(spark, before)
    assert spark.conf.get(FREE_SHUFFLES) == was and kept.count() == 7 and wh.read("gold.t").count() == 14
    assert wh.read("gold.by").where("v = 'new'").count() == 429 and wh.read("gold.by").count() == 3000


def test_item_fact_leaves_only_its_table(spark):
    """The joined fact and the shuffles of both runs are gone when the query returns; the merge of whole partitions joins nothing."""
    import os

    from tradewind.session import working_folder

    here = lambda kind: {f for f in os.listdir(f"{working_folder(spark)}/{kind}")} if os.path.isdir(f"{working_folder(spark)}/{kind}") else set()
    fixed, staged, before = here("fixed"), here("staged"), shuffle_files(spark)
    df = entry.queries()["stored_fct_order_items"](spark, SMALL)
    left = [spark.read.parquet(f"{working_folder(spark)}/fixed/{f}").columns for f in here("fixed") - fixed]
    assert left in ([], [["_many_order_id"]]) and here("staged") == staged  # keys of large groups may stay
    assert not kept_shuffles(spark, before)
    assert df.count() == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()


def test_whole_partitions_and_new_ones_meet_no_old_rows(spark, tmp_path):
    wh, how = Warehouse(spark, str(tmp_path), {"gold": "scale_whole"}), Incremental("merge", ("id",), TimePartition("at", "month"))
    rows = spark.range(90).select("id", F.timestamp_add("DAY", F.col("id").cast("int"), F.lit(datetime(2024, 1, 1))).alias("at"), F.lit("old").alias("v"))
    wh.write_table("gold.t", rows.where("id < 60"), how.partition)
    seen, replace = [], wh.replace_partitions
    wh.replace_partitions = lambda table, new, *rest: seen.append(new._jdf.queryExecution().optimizedPlan().toString()) or replace(table, new, *rest)
    inc.apply(wh, "gold.t", rows.withColumn("v", F.lit("new")), how)
    assert "Join" not in seen[0]
    assert {r.id: r.v for r in wh.read("gold.t").collect()} == {i: "new" for i in range(90)}


def test_item_total_does_not_travel(spark):
    text = plan(Bound(spark, SMALL).fct_order_items()).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "item_total" not in text[text.index("Join"):]
