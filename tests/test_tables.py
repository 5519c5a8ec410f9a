"""Stored tables: two and three runs of every strategy, on small states with awkward rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tradewind.operators import incremental as inc
from tradewind.operators.incremental import AmbiguousMerge, Incremental
from tradewind.operators.schema_drift import SchemaChanged
from tradewind.sources.tables import RangePartition, TimePartition, Warehouse

D1, D2, D3 = datetime(2024, 1, 1, 5), datetime(2024, 1, 2, 6), datetime(2024, 1, 3, 7)
SCHEMA = "id string, at timestamp, status string, value bigint"
DAY = TimePartition("at", "day")


@pytest.fixture
def wh(spark, tmp_path, request):
    name = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    return Warehouse(spark, str(tmp_path), {"gold": name, "silver": f"{name}_s", "bronze": f"{name}_b"})


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def make(spark, data):
    return spark.createDataFrame(data, SCHEMA)


BASE = [("a", D1, "new", 1), ("b", D2, "new", 2), ("c", D3, "new", 3), (None, D1, "nokey", 4), ("d", None, "noday", 5)]


def start(wh, how):
    wh.write_table("gold.t", make(wh.spark, BASE), how.partition, how.cluster)


@pytest.mark.parametrize("partition", [DAY, None])
def test_merge_moves_updates_inserts(wh, partition):
    how = Incremental("merge", ("id",), partition, ("status",))
    start(wh, how)
    change = make(wh.spark, [("a", D2, "moved", 10), ("e", D3, "added", 11), (None, D1, "nokey2", 12), ("d", D3, "dated", 13)])
    want = [("a", D2, "moved", 10), ("b", D2, "new", 2), ("c", D3, "new", 3), (None, D1, "nokey", 4),
            ("d", D3, "dated", 13), ("e", D3, "added", 11), (None, D1, "nokey2", 12)]
    inc.apply(wh, "gold.t", change, how)
    assert rows(wh.read("gold.t")) == sorted(want, key=str)
    # merging the same rows again changes nothing, but for rows without a key, which never match
    inc.apply(wh, "gold.t", change.where("id is not null"), how)
    assert rows(wh.read("gold.t")) == sorted(want, key=str)


def test_merge_drops_emptied_partition(wh):
    how = Incremental("merge", ("id",), DAY)
    start(wh, how)
    inc.apply(wh, "gold.t", make(wh.spark, [("b", D3, "moved", 2)]), how)
    assert date(2024, 1, 2) not in wh.partition_values("gold.t")
    assert inc.max_partition(wh, "gold.t") == date(2024, 1, 3)
    assert wh.read("gold.t").where("id = 'b'").count() == 1


def test_merge_rewrites_only_touched_partitions(wh):
    how = Incremental("merge", ("id",), DAY)
    start(wh, how)
    files = lambda: {r[0]: r[1] for r in wh.read("gold.t", technical=True).select("at_day", "_metadata.file_path").distinct().collect()}
    before = files()
    inc.apply(wh, "gold.t", make(wh.spark, [("b", D2, "upd", 9)]), how)
    after = files()
    changed = {d for d in before if before[d] != after[d]}
    assert changed == {date(2024, 1, 2)}


def test_merge_refuses_repeated_keys_only_on_match(wh):
    how = Incremental("merge", ("id",), DAY)
    start(wh, how)
    with pytest.raises(AmbiguousMerge):
        inc.apply(wh, "gold.t", make(wh.spark, [("a", D1, "x", 1), ("a", D1, "y", 2)]), how)
    inc.apply(wh, "gold.t", make(wh.spark, [("n", D1, "x", 1), ("n", D1, "y", 2)]), how)
    assert wh.read("gold.t").where("id = 'n'").count() == 2


def test_merge_column_choice_and_predicates(wh):
    how = Incremental("merge", ("id",), DAY, update=("value",))
    start(wh, how)
    inc.apply(wh, "gold.t", make(wh.spark, [("a", D2, "ignored", 10)]), how)
    assert rows(wh.read("gold.t").where("id = 'a'")) == [("a", D1, "new", 10)]
    how = Incremental("merge", ("id",), DAY, exclude=("status", "at"))
    inc.apply(wh, "gold.t", make(wh.spark, [("a", D2, "ignored", 11)]), how)
    assert rows(wh.read("gold.t").where("id = 'a'")) == [("a", D1, "new", 11)]
    with pytest.raises(ValueError):
        inc.apply(wh, "gold.t", make(wh.spark, BASE[:1]), Incremental("merge", ("id",), DAY, update=("value",), exclude=("at",)))
    # a row that fails the predicate is not matched: the new row is added beside it
    how = Incremental("merge", ("id",), DAY, predicates=("target.value > 100",))
    inc.apply(wh, "gold.t", make(wh.spark, [("b", D2, "twin", 1)]), how)
    assert wh.read("gold.t").where("id = 'b'").count() == 2


def test_append_and_delete_insert(wh):
    how = Incremental("append", partition=DAY)
    start(wh, how)
    inc.apply(wh, "gold.t", make(wh.spark, BASE[:1]), how)
    assert wh.read("gold.t").where("id = 'a'").count() == 2
    how = Incremental("delete_insert", ("id",), DAY)
    inc.apply(wh, "gold.t", make(wh.spark, [("a", D3, "p", 1), ("a", D3, "q", 2), (None, D3, "r", 3)]), how)
    assert rows(wh.read("gold.t").where("id = 'a'")) == [("a", D3, "p", 1), ("a", D3, "q", 2)]
    assert wh.read("gold.t").where("id is null").count() == 2
    how = Incremental("delete_insert", ("id",), DAY, predicates=("target.status = 'p'",))
    inc.apply(wh, "gold.t", make(wh.spark, [("a", D3, "s", 9)]), how)
    assert {r.status for r in wh.read("gold.t").where("id = 'a'").collect()} == {"q", "s"}


@pytest.mark.parametrize("copy", [False, True])
def test_insert_overwrite_dynamic(wh, copy):
    how = Incremental("insert_overwrite", partition=DAY, copy_partitions=copy)
    start(wh, how)
    inc.apply(wh, "gold.t", make(wh.spark, [("z", D2, "new", 1), ("y", None, "noday", 2)]), how)
    got = {(r.id, r.value) for r in wh.read("gold.t").collect()}
    # the day of b is replaced; the row without a day is added and replaces nothing
    assert got == {("a", 1), ("z", 1), ("c", 3), (None, 4), ("d", 5), ("y", 2)}


def test_insert_overwrite_static(wh):
    how = Incremental("insert_overwrite", partition=DAY, partitions=(date(2024, 1, 1), date(2024, 1, 3)))
    start(wh, how)
    inc.apply(wh, "gold.t", make(wh.spark, [("z", D1, "new", 1), ("y", D2, "other", 2)]), how)
    got = {(r.id, r.value) for r in wh.read("gold.t").collect()}
    assert got == {("z", 1), ("b", 2), ("y", 2), ("d", 5)}


def test_strategy_needs():
    with pytest.raises(ValueError):
        Incremental("insert_overwrite")
    with pytest.raises(ValueError):
        Incremental("merge", ("id",), DAY, copy_partitions=True)
    with pytest.raises(ValueError):
        Incremental("no_such")


@pytest.mark.parametrize("one_pass", [False, True])
def test_microbatch(wh, one_pass):
    how = Incremental("microbatch", partition=DAY)
    start(wh, how)
    new = make(wh.spark, [("z", D1, "again", 1), ("y", D3, "again", 2), ("x", datetime(2024, 1, 9), "outside", 3)])
    n = inc.microbatch(wh, "gold.t", lambda lo, hi: new, how, datetime(2024, 1, 1, 12), datetime(2024, 1, 4), one_pass)
    assert n == 3
    # the day of b had no rows in its batch, so its partition is gone
    assert {(r.id, r.value) for r in wh.read("gold.t").collect()} == {("z", 1), ("y", 2), ("d", 5)}


def test_build_decision_and_watermark(wh):
    how = Incremental("merge", ("id",), DAY)
    asked = []

    def query(change):
        asked.append(change)
        src = make(wh.spark, [*BASE, ("late", D1, "late", 6), ("tie", D3, "tie", 7)] if change else BASE)
        return inc.newer_than_table(wh, "gold.t", src, "at", DAY) if change else src

    assert inc.build(wh, "gold.t", query, how) == "rebuild"
    assert inc.build(wh, "gold.t", query, how) == "merge"
    assert wh.read("gold.t").count() == len(BASE)  # late rows and ties stay out
    assert inc.build(wh, "gold.t", query, how, full_refresh=True) == "rebuild"
    assert asked == [False, True, False]
    wh.drop("gold.t")
    wh.create_view("gold.t", "SELECT 1 AS id")
    assert not inc.is_incremental(wh, "gold.t")
    assert inc.build(wh, "gold.t", query, how) == "rebuild" and not wh.is_view("gold.t")


def test_watermark_of_empty_table(wh):
    how = Incremental("merge", ("id",), DAY)
    wh.write_table("gold.t", make(wh.spark, []), DAY)
    assert inc.newer_than_table(wh, "gold.t", make(wh.spark, BASE), "at", DAY).count() == 0


def test_schema_policies(wh):
    spark = wh.spark
    start(wh, Incremental("merge", ("id",), DAY))
    wider = make(spark, [("a", D1, "x", 50)]).withColumn("extra", F.lit(7))
    inc.apply(wh, "gold.t", wider, Incremental("merge", ("id",), DAY))
    assert wh.read("gold.t").columns == ["id", "at", "status", "value"]
    with pytest.raises(SchemaChanged):
        inc.apply(wh, "gold.t", wider, Incremental("merge", ("id",), DAY, on_schema_change="fail"))
    with pytest.raises(SchemaChanged):
        inc.apply(wh, "gold.t", wider.drop("value"), Incremental("merge", ("id",), DAY))
    # a new column is added; a column the new rows lack keeps its value
    inc.apply(wh, "gold.t", wider.drop("value"), Incremental("merge", ("id",), DAY, on_schema_change="append_new_columns"))
    assert rows(wh.read("gold.t").where("id = 'a'").select("id", "status", "value", "extra")) == [("a", "x", 50, 7)]
    assert wh.read("gold.t").where("id = 'b' and extra is null").count() == 1
    synced = make(spark, [("a", D1, "x", 60)]).withColumn("value", F.col("value").cast("string")).withColumn("other", F.lit(True))
    inc.apply(wh, "gold.t", synced, Incremental("merge", ("id",), DAY, on_schema_change="sync_all_columns"))
    assert dict(wh.read("gold.t").dtypes) == {"id": "string", "at": "timestamp", "status": "string", "value": "string", "other": "boolean"}
    assert wh.read("gold.t").where("id = 'a' and value = '60' and other").count() == 1
    assert wh.read("gold.t").count() == 5
    inc.change_column_type(wh, "gold.t", "value", "bigint", Incremental("merge", ("id",), DAY))
    assert dict(wh.read("gold.t").dtypes)["value"] == "bigint"


def test_range_and_ingestion_partitions(wh):
    spark = wh.spark
    part = RangePartition("value", 0, 10, 5)
    wh.write_table("gold.r", spark.range(-2, 20).select(F.col("id").alias("value")), part)
    assert sorted(wh.partition_values("gold.r")) == [0, 1, 2, 3]
    assert wh.read("gold.r").columns == ["value"] and wh.read("gold.r").count() == 22
    part = TimePartition("at", "day", drop_field=True)
    how = Incremental("merge", ("id",), part)
    wh.write_table("gold.i", make(spark, BASE), part)
    assert wh.read("gold.i").columns == ["id", "status", "value"]
    inc.apply(wh, "gold.i", make(spark, [("a", D3, "moved", 9)]), how)
    assert wh.read("gold.i", technical=True).where("id = 'a'").select("_partition_time", "value").first() == (date(2024, 1, 3), 9)
    assert wh.read("gold.i").count() == 5


@pytest.mark.parametrize("granularity", ["hour", "day", "month", "year"])
def test_time_granularities(wh, granularity):
    part = TimePartition("at", granularity)
    how = Incremental("merge", ("id",), part)
    start(wh, how)
    inc.apply(wh, "gold.t", make(wh.spark, [("b", D1, "moved", 9)]), how)
    assert wh.read("gold.t").count() == 5
    assert len(wh.partition_values("gold.t")) == {"hour": 3, "day": 3, "month": 2, "year": 2}[granularity]
    with pytest.raises(ValueError):
        TimePartition("at", "week")


def test_views_copies_clones(wh):
    start(wh, Incremental())
    with pytest.raises(ValueError):
        wh.create_view("gold.t", "SELECT 1 AS one")
    wh.create_view("gold.v", f"SELECT id FROM {wh.full_name('gold.t')}")
    wh.create_view("gold.v", f"SELECT id, value FROM {wh.full_name('gold.t')}")
    assert wh.read("gold.v").columns == ["id", "value"]
    wh.create_view("silver.session_view", wh.read("gold.t").select("id"))
    wh.create_view("gold.session_view", wh.read("gold.t").where("value > 3").select("value"))
    assert wh.read("silver.session_view").count() == 5 and wh.read("gold.session_view").count() == 2
    assert wh.is_view("silver.session_view")
    wh.copy(["gold.t", "gold.t"], "gold.copy")
    assert wh.read("gold.copy").count() == 10
    wh.copy(["gold.t"], "gold.copy", mode="incremental")
    assert wh.read("gold.copy").count() == 15
    wh.clone("gold.t", "gold.clone")
    wh.write_table("gold.t", make(wh.spark, BASE[:1]))
    wh.clone("gold.t", "gold.clone")
    assert wh.read("gold.clone").count() == 5
    wh.clone("gold.t", "gold.clone", full_refresh=True)
    assert wh.read("gold.clone").count() == 1
    wh.clone("gold.t", "gold.pointer", as_view=True)
    assert wh.is_view("gold.pointer") and wh.read("gold.pointer").count() == 1
    wh.create_view("gold.clone", "SELECT 1 AS one", full_refresh=True)
    assert wh.is_view("gold.clone")


def test_materialized_view(wh):
    start(wh, Incremental())
    query = lambda: wh.read("gold.t").groupBy("status").count()
    view = wh.materialized_view("gold.mv", query, cluster=["status"])
    assert wh.read("gold.mv").count() == 3
    wh.write_table("gold.t", make(wh.spark, BASE[:1]))
    wh.materialized_view("gold.mv", query, cluster=["status"])
    assert wh.read("gold.mv").count() == 3  # unchanged layout: not rebuilt until refreshed
    assert view.refresh().count() == 1
    wh.write_table("gold.t", make(wh.spark, BASE))
    wh.materialized_view("gold.mv", query)
    assert wh.read("gold.mv").count() == 3  # changed layout: rebuilt


def test_hot_partition_is_split_over_files(wh):
    spark = wh.spark
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        df = spark.range(200_000, numPartitions=16).select(
            F.sha2(F.col("id").cast("string"), 256).alias("id"), F.lit(D1).alias("at"), F.lit("s").alias("status"), F.col("id").alias("value"))
        wh.write_table("gold.hot", df, DAY, ["value"])
    finally:
        spark.conf.set(key, before)
    files = wh.read("gold.hot").select("_metadata.file_path").distinct().count()
    assert files > 1 and wh.read("gold.hot").count() == 200_000


def test_changes_of_two_tables_at_once(wh):
    from tradewind.sources.raw import in_parallel

    how = Incremental("merge", ("id",), DAY)
    for t in ("gold.p", "gold.q", "gold.r"):
        wh.write_table(t, make(wh.spark, BASE), DAY)
    change = make(wh.spark, [("e", D3, "added", 1)])
    in_parallel(lambda t=t: inc.apply(wh, t, change, how) for t in ("gold.p", "gold.q", "gold.r"))
    assert [wh.read(t).count() for t in ("gold.p", "gold.q", "gold.r")] == [6, 6, 6]


def test_staged_rows_are_removed(wh, tmp_path):
    from tradewind.session import staged, working_folder

    with staged(make(wh.spark, BASE)) as df:
        assert df.count() == 5
        files = df.inputFiles()
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND"):
        wh.spark.read.parquet(files[0]).count()
    assert working_folder(wh.spark)


def test_alter_columns(wh):
    how = Incremental("merge", ("id",), DAY)
    start(wh, how)
    inc.alter_columns(wh, "gold.t", add={"note": "string", "n": "int"}, how=how)
    assert wh.read("gold.t").where("note IS NULL AND n IS NULL").count() == 5
    inc.alter_columns(wh, "gold.t", drop=["note", "value"], how=how)
    assert wh.read("gold.t").columns == ["id", "at", "status", "n"] and wh.read("gold.t").count() == 5


def test_readers_see_a_whole_table_between_any_two_steps(spark, tmp_path, monkeypatch):
    """Before and after every catalog command and write of a rebuild, SQL and ``read`` give all old or all new rows."""
    wh = Warehouse(spark, str(tmp_path), {"gold": "swap_gold"})
    by = TimePartition("t", "day")
    rows = lambda n: spark.range(n).selectExpr("id", "timestamp'2024-01-01' + make_dt_interval(CAST(id AS INT)) AS t")
    wh.write_table("gold.a", rows(3), by)
    plain, commands, seen = type(spark).sql, [], []

    def look():
        seen.append((plain(spark, "SELECT count(*) FROM swap_gold.a").first()[0], wh.read("gold.a").count()))

    def watched(self, text, *args, **kwargs):
        commands.append(text.split()[0] + " " + text.split()[1])
        if commands[-1] in ("CREATE TABLE", "ALTER TABLE", "ALTER VIEW", "DROP TABLE"):
            look()
            out = plain(self, text, *args, **kwargs)
            look()
            return out
        return plain(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", watched)
    wh.write_table("gold.a", rows(5), by)
    monkeypatch.undo()
    assert set(seen) == {(3, 3), (5, 5)} and seen == sorted(seen) and "ALTER VIEW" in commands
    assert not {"MSCK REPAIR", "SHOW PARTITIONS"} & set(commands)  # no folder is listed
    assert len(wh.partition_values("gold.a")) == 5 and wh.layout("gold.a") == (by, ())


def test_a_reader_keeps_its_version_through_a_rebuild(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), {"gold": "keep_gold"})
    wh.write_table("gold.a", spark.range(3))
    reader = wh.read("gold.a")
    wh.write_table("gold.a", spark.range(5))
    assert reader.count() == 3 and wh.read("gold.a").count() == 5
    # a table made of itself, and no version but the current and the one before
    for _ in range(3):
        wh.write_table("gold.a", wh.read("gold.a").selectExpr("id + 1 AS id"))
    assert [r.id for r in wh.read("gold.a").orderBy("id").collect()] == [3, 4, 5, 6, 7]
    assert spark.sql("SHOW TABLES IN keep_gold LIKE 'a__v*'").count() == 2
    wh.drop("gold.a")
    assert not wh.exists("gold.a") and spark.sql("SHOW TABLES IN keep_gold").where("NOT isTemporary").count() == 0


@pytest.mark.parametrize("step", ["_write_files", "_set_properties", "_point"])
def test_a_failed_rebuild_leaves_the_old_table(spark, tmp_path, step):
    wh = Warehouse(spark, str(tmp_path), {"gold": "fail" + step.lower()})
    by = TimePartition("t", "day")
    rows = lambda n: spark.range(n).selectExpr("id", "timestamp'2024-01-01' + make_dt_interval(CAST(id AS INT)) AS t")
    wh.write_table("gold.a", rows(3), by)
    work = getattr(wh, step)

    def killed(*args, **kwargs):
        raise RuntimeError("killed")

    setattr(wh, step, killed)
    with pytest.raises(RuntimeError):
        wh.write_table("gold.a", rows(5), by)
    setattr(wh, step, work)
    assert wh.read("gold.a").count() == 3 and spark.table(f"{wh.full_name('gold.a')}").count() == 3
    wh = Warehouse(spark, str(tmp_path), {"gold": "fail" + step.lower()})
    wh.write_table("gold.a", rows(5), by)
    assert wh.read("gold.a").count() == 5 and len(wh.partition_values("gold.a")) == 5 and wh.layout("gold.a") == (by, ())
    assert spark.sql(f"SHOW TABLES IN {wh.full_name('gold.a').split('.')[0]} LIKE 'a__v*'").count() == 2


def test_files_of_a_partition_do_not_overlap(spark, tmp_path):
    """A day with a third of the rows becomes several files whose ranges of the cluster column are disjoint, so that a value is
    in one of them."""
    import pyarrow.parquet as pq

    wh = Warehouse(spark, str(tmp_path), {"gold": "cluster_gold"})
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")  # as with ranges too large to be put together
    try:
        df = spark.range(60_000, numPartitions=16).select(
            F.col("id"), F.format_string("c%05d", F.col("id") * 7919 % 20011).alias("customer"),
            F.timestamp_add("DAY", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 9).cast("int"), F.lit(D1)).alias("at"))
        wh.write_table("gold.t", df, DAY, ("customer",))
    finally:
        spark.conf.set(key, before)
    hot = [f for f in wh.read("gold.t", technical=True).where("at_day = DATE'2024-01-01'").inputFiles()]
    column = pq.ParquetFile(hot[0].removeprefix("file://")).schema.names.index("customer")
    ranges = sorted((s.min, s.max) for f in hot for g in [pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(0)]
                    for s in [g.column(column).statistics])
    assert len(ranges) > 2 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    assert sum(lo <= "c10000" <= hi for lo, hi in ranges) == 1
    assert wh.read("gold.t").count() == 60_000 and wh.layout("gold.t") == (DAY, ("customer",))


def test_copies_and_changed_columns_keep_the_layout(spark, tmp_path):
    from tradewind.operators import incremental as inc

    wh = Warehouse(spark, str(tmp_path), {"gold": "layout_gold"})
    by = TimePartition("t", "day")
    rows = spark.range(4).selectExpr("id", "id AS other", "timestamp'2024-01-01' + make_dt_interval(CAST(id % 2 AS INT)) AS t")
    wh.write_table("gold.a", rows, by, ("id",))
    wh.clone("gold.a", "gold.b")
    wh.copy(["gold.a", "gold.b"], "gold.c")
    wh.copy(["gold.a"], "gold.c", "incremental")
    inc.change_column_type(wh, "gold.a", "id", "string")
    inc.alter_columns(wh, "gold.a", drop=["other"])
    for name, count in (("a", 4), ("b", 4), ("c", 12)):
        table = f"gold.{name}"
        assert wh.layout(table) == (by, ("id",)) and wh.partition_columns(table) == ["t_day"], name
        assert len(wh.partition_values(table)) == 2 and wh.read(table).count() == count
    assert dict(wh.read("gold.a").dtypes) == {"id": "string", "t": "timestamp"}
    with pytest.raises(ValueError, match="stored by"):
        inc.change_column_type(wh, "gold.a", "id", "int", inc.Incremental(partition=TimePartition("t", "month"), keys=("id",)))


def test_silver_views_outlive_the_session(spark, tmp_path):
    """The nine cleaning views are in the catalog: another session reads them, with the settings of the session that made them."""
    from tradewind.plans.daily import STAGING
    from tradewind.plans.models import Context, build_all
    from tradewind.plans.params import Run
    from tradewind.plans.staging import clean
    from tradewind.sources.schemas import COLUMNS

    wh = Warehouse(spark, str(tmp_path), {"gold": "views_g", "silver": "views_s", "bronze": "views_b"})
    values = {"text": "'\\u00a0 a b\\t'", "string": "' x '", "bigint": "'12'", "double": "'1.5'", "timestamp": "'2024-01-31 22:30:00.25'"}
    for table, columns in COLUMNS.items():
        row = ", ".join(f"{values[t]} AS {c}" for c, t in columns.items())
        empty = ", ".join(f"CAST(NULL AS STRING) AS {c}" for c in columns)
        wh.write_table(f"bronze.{table}", spark.sql(f"SELECT {row} UNION ALL SELECT {empty}"))
    run = Run(datetime(2024, 5, 1, 1, 2, 3, 4), "it's run\\1")
    context = Context(wh, STAGING, run)
    build_all([STAGING], context)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    for table, model in zip(COLUMNS, STAGING, strict=True):
        want = clean(table, wh.read(f"bronze.{table}"), run)
        assert rows(context.ref(model.name)) == rows(want) and context.ref(model.name).dtypes == want.dtypes
        seen = other.table(wh.full_name(model.table))
        assert seen.dtypes == want.dtypes and sorted(map(str, seen.collect())) == sorted(map(str, want.collect()))
    # a new load of the tables below shows at once, and a column of another type is refused
    wh.write_table("bronze.customers", wh.read("bronze.customers").limit(0))
    assert other.table("views_s.stg_customers").count() == 0
    # views of one name in two layers, from text or frames
    wh.create_view("gold.stg_sellers", "SELECT 1 AS one")
    wh.create_view("gold.stg_orders", spark.range(3))
    assert wh.read("gold.stg_sellers").columns == ["one"] and wh.read("gold.stg_orders").count() == 3
    assert wh.read("silver.stg_sellers").count() == wh.read("silver.stg_orders").count() == 2


@pytest.mark.parametrize("at_once", [1, 3])
def test_only_failed_windows_run_again(wh, at_once):
    """One of five windows fails: the others are done, and the second call runs that window alone."""
    how, asked, broken = Incremental("microbatch", partition=DAY), [], {datetime(2024, 1, 3)}
    source = make(wh.spark, [(f"r{i}", datetime(2024, 1, 1 + i % 5, i % 24), "new", i) for i in range(50)])

    def query(lo, hi):
        asked.append(lo)
        if lo in broken:
            raise RuntimeError("source not there yet")
        return source

    days = (datetime(2024, 1, 1), datetime(2024, 1, 6))
    with pytest.raises(inc.WindowsFailed, match="1 of 5 .*source not there yet"):
        inc.microbatch(wh, "gold.t", query, how, *days, ledger="gold.windows", at_once=at_once)
    assert sorted(asked) == [datetime(2024, 1, d) for d in range(1, 6)] and wh.read("gold.t").count() == 40
    states = {r.begin_at.day: r.state for r in wh.read("gold.windows").collect()}
    assert states == {1: "done", 2: "done", 3: "failed", 4: "done", 5: "done"}
    broken.clear()
    asked.clear()
    assert inc.microbatch(wh, "gold.t", query, how, *days, ledger="gold.windows", at_once=at_once) == 1
    assert asked == [datetime(2024, 1, 3)] and rows(wh.read("gold.t")) == rows(source)
    assert inc.microbatch(wh, "gold.t", query, how, *days, ledger="gold.windows", at_once=at_once) == 0


def test_rows_are_counted_by_the_job_that_writes(wh, spark):
    from tradewind.operators import quality
    from tradewind.operators.quality import ColumnRule

    rules = {"id": ColumnRule(not_null=True), "value": ColumnRule(low=2, high=4)}
    seen = wh.write_table("gold.t", make(spark, BASE), DAY, ("status",), quality.row_measures("t", rules))
    assert seen == {"rows": 5, "not_null_t_id": 1, "between_t_value": 2}
    assert wh.write_table("gold.empty", make(spark, []), DAY, (), quality.row_measures("t", rules)) == {"rows": 0, "not_null_t_id": 0, "between_t_value": 0}
    group, tracker, frames = "rows of a written table", spark.sparkContext.statusTracker(), {"t": wh.read("gold.t")}
    spark.sparkContext.setJobGroup(group, group)
    try:
        quality.require_rows({"gold.t": frames["t"]}, {"gold.t": seen["rows"]})
        verdicts = quality.declared_verdicts(frames, {"t": rules}, {"t": seen})
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # no job for the rows, and no scan for the checks
    assert not tracker.getJobIdsForGroup(group) and "FileScan" not in verdicts._jdf.queryExecution().toString()
    assert {r.test: (r.failures, r.should_error) for r in verdicts.collect()} == {"not_null_t_id": (1, True), "between_t_value": (2, True)}
    with pytest.raises(quality.CheckFailed, match="gold.empty"):
        quality.require_rows({"gold.t": frames["t"], "gold.empty": wh.read("gold.empty")}, {"gold.t": 5})


def test_rollup_reads_only_changed_partitions(wh, spark):
    """After inserts, updates, moved rows and removed partitions the totals equal those of all rows, and only touched days are read."""
    from tradewind.operators.rollup import Total, rollup

    day = lambda n: datetime(2024, 1, n, 5)
    how = Incremental("merge", ("id",), DAY)
    wh.write_table("gold.t", make(spark, [(f"r{i}", day(1 + i % 6), f"s{i % 3}", i) for i in range(60)] + [("x", None, "s0", 5)]), DAY)
    totals = {"n": Total("count(*)"), "total": Total("sum(value)"), "last": Total("max(at)", "max")}
    kept = rollup(wh, "gold.totals", "gold.t", ["status"], totals)

    def check(touched):
        assert sorted(kept.refresh(), key=str) == sorted(touched, key=str)
        direct = wh.read("gold.t").groupBy("status").agg(F.expr("count(*) AS n"), F.expr("sum(value) AS total"), F.expr("max(at) AS last"))
        assert rows(kept.read()) == rows(direct)

    check([])
    inc.apply(wh, "gold.t", make(spark, [("r0", day(1), "s9", 100), ("new", day(9), "s1", 1)]), how)
    check(["2024-01-01", "2024-01-09"])
    inc.apply(wh, "gold.t", make(spark, [("r1", day(4), "s1", 7), ("y", None, "s0", 6)]), how)
    check(["2024-01-02", "2024-01-04", None])
    wh.drop_partitions("gold.t", [date(2024, 1, 3)])
    check([])
    assert date(2024, 1, 3) not in {r.day for r in wh.read("gold.totals").selectExpr("CAST(_source_partition AS DATE) AS day").collect()}
    # other totals: made anew
    kept = rollup(wh, "gold.totals", "gold.t", ["status"], {"n": Total("count(*)")})
    assert kept.read().columns == ["status", "n"] and kept.read().agg(F.sum("n")).first()[0] == wh.read("gold.t").count()
    with pytest.raises(ValueError, match="combine"):
        Total("avg(value)", "avg")
