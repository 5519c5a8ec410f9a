"""Registered queries for table changes and history.

Old and new states are made of the orders: the table holds those placed before 2000, the new rows are
those placed from 1998 on with a changed status, so some keys match and some are new.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.catalog.bound import Bound, sql
from tradewind.functions.dates import time_literal
from tradewind.operators import history, incremental as inc, merge
from tradewind.operators.history import Tracking
from tradewind.operators.incremental import Incremental
from tradewind.operators.schema_drift import reconcile
from tradewind.session import fixed, staged, until_the_end, working_folder
from tradewind.sources.bindings import TABLES, table
from tradewind.sources.tables import KeyPartition, TimePartition, Warehouse
from tradewind.streaming.sinks import replace_batches_stream, totals_stream, upsert_stream

OLD_UNTIL, NEW_FROM = datetime(2000, 1, 1), datetime(1998, 1, 1)
PLACED = "order_purchase_timestamp"
COLUMNS = ["order_id", "customer_id", "order_status", PLACED]


def all_orders(spark: SparkSession, d: str) -> DataFrame:
    return Bound(spark, d).source("orders").select(*COLUMNS)


def old_rows(spark: SparkSession, d: str) -> DataFrame:
    return all_orders(spark, d).where(F.col(PLACED) < time_literal(OLD_UNTIL))


def new_rows(spark: SparkSession, d: str) -> DataFrame:
    """Some orders are placed a day later than the table says."""
    moved = F.when(F.col("order_status") == "canceled", F.col(PLACED) + F.make_dt_interval(F.lit(1))).otherwise(F.col(PLACED))
    return all_orders(spark, d).where(F.col(PLACED) >= time_literal(NEW_FROM)).select(
        "order_id", "customer_id", F.concat(F.lit("new "), "order_status").alias("order_status"), moved.alias(PLACED))


def merge_upsert(spark, d):
    return merge.merge_rows(old_rows(spark, d), new_rows(spark, d), "order_id")


def merge_update_columns(spark, d):
    return merge.merge_rows(old_rows(spark, d), new_rows(spark, d), "order_id", update=["order_status"])


def merge_exclude_columns(spark, d):
    return merge.merge_rows(old_rows(spark, d), new_rows(spark, d), "order_id", exclude=[PLACED])


def merge_predicates(spark, d):
    return merge.merge_rows(old_rows(spark, d), new_rows(spark, d), ["order_id", "customer_id"],
                            predicates=["target.order_status <> 'shipped'"])


def merge_ambiguous_keys(spark, d):
    """Items as new rows of orders: keys of orders with several items."""
    items = Bound(spark, d).items()
    return merge.ambiguous_keys(old_rows(spark, d), items, "order_id")


def merge_without_key(spark, d):
    """Nothing matches: all new rows are added."""
    return merge.merge_rows(old_rows(spark, d), new_rows(spark, d), None)


def append(spark, d):
    return merge.append_rows(old_rows(spark, d), new_rows(spark, d))


def _payments(spark, d):
    """Payments of the orders, with an amount of 0 before they are loaded again."""
    p = Bound(spark, d).source("order_payments").select("order_id", "payment_type", "payment_value")
    return p.withColumn("payment_value", F.lit(0.0)), p.where("payment_type <> 'N'")


def delete_insert(spark, d):
    """All payments of an order are replaced by those of types A and R."""
    old, new = _payments(spark, d)
    return merge.delete_insert_rows(old, new, "order_id")


def delete_insert_predicate(spark, d):
    old, new = _payments(spark, d)
    return merge.delete_insert_rows(old, new, "order_id", predicates=["target.payment_type <> 'R'"])


def _month():
    return F.date_trunc("month", F.col(PLACED))


def overwrite_static(spark, d):
    months = [time_literal(datetime(1998, m, 1)) for m in (3, 4, 5)]
    return merge.overwrite_static_rows(old_rows(spark, d), new_rows(spark, d), _month(), months)


def overwrite_dynamic(spark, d):
    return merge.overwrite_dynamic_rows(old_rows(spark, d), new_rows(spark, d), _month())


def microbatch(spark, d):
    return merge.microbatch_rows(old_rows(spark, d), new_rows(spark, d), PLACED,
                                 datetime(1999, 3, 10), datetime(1999, 9, 20), "month")


def high_watermark(spark, d):
    return merge.newer_rows(all_orders(spark, d), old_rows(spark, d), PLACED)


def schema_append_columns(spark, d):
    new = new_rows(spark, d).drop("customer_id").withColumn("note", F.lit("late"))
    old, new = reconcile(old_rows(spark, d), new, "append_new_columns")
    return merge.append_rows(old, new)


def schema_sync_columns(spark, d):
    new = new_rows(spark, d).drop("customer_id").withColumn(PLACED, F.col(PLACED).cast("date")).withColumn("note", F.lit("late"))
    old, new = reconcile(old_rows(spark, d), new, "sync_all_columns")
    return merge.append_rows(old, new)


# -- stored tables ----------------------------------------------------------------------------------


def own_folder(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder that goes when the application ends."""
    return until_the_end(spark, f"{working_folder(spark)}/{kind}/{uuid.uuid4().hex}")


def warehouse(spark: SparkSession) -> Warehouse:
    """Databases of one query; their files go when the application ends."""
    name = f"tw_{uuid.uuid4().hex}"
    databases = {"gold": name, "silver": f"{name}_s", "bronze": f"{name}_b"}
    for database in databases.values():
        until_the_end(spark, f"{working_folder(spark)}/{database}")
    return Warehouse(spark, working_folder(spark), databases)


BY_MONTH = TimePartition(PLACED, "month")


def stored_merge(spark, d):
    """The merge on a stored, partitioned table; only touched partitions are rewritten."""
    wh, how = warehouse(spark), Incremental("merge", ("order_id",), BY_MONTH, ("order_status", "customer_id"))
    wh.write_table("gold.orders", old_rows(spark, d), BY_MONTH, how.cluster)
    inc.apply(wh, "gold.orders", new_rows(spark, d), how)
    return wh.read("gold.orders")


def stored_key_merge(spark, d):
    """The merge on a table partitioned by a hash of its key: the new rows alone tell what to rewrite."""
    by = KeyPartition(("order_id",), 8)
    wh, how = warehouse(spark), Incremental("merge", ("order_id",), by)
    wh.write_table("gold.orders", old_rows(spark, d), by)
    inc.apply(wh, "gold.orders", new_rows(spark, d), how)
    return wh.read("gold.orders")


def stored_overwrite(spark, d):
    wh, how = warehouse(spark), Incremental("insert_overwrite", partition=BY_MONTH)
    wh.write_table("gold.orders", old_rows(spark, d), BY_MONTH)
    inc.apply(wh, "gold.orders", new_rows(spark, d), how)
    return wh.read("gold.orders")


EVENT = ["event_id", "ts", "user_id", "event_type", "value"]


def _event_batches(spark, d) -> list[DataFrame]:
    """All events, with a later version of every fourth in the same batch; then a third of them a month later with another
    value, and outdated versions of every sixth; then a fifth as they were but corrected, one in seven of those without a time."""
    events = table(spark, d, "events").select(*EVENT, F.lit(1).alias("version"))
    changed = lambda every, version, **columns: events.where(f"event_id % {every} = 0").withColumns(
        {"version": F.lit(version), **columns})
    return [
        events.unionByName(changed(4, 2, event_type=F.concat("event_type", F.lit(" again")))),
        changed(3, 3, ts=F.col("ts") + F.expr("interval 31 days"), value=F.col("value") + 100)
        .unionByName(changed(6, 0, event_type=F.lit("outdated"))),
        changed(5, 4, event_type=F.lit("corrected"), ts=F.when(F.col("event_id") % 7 != 0, F.col("ts"))),
    ]


def _stream_in(spark, batches: list[DataFrame], run) -> str:
    """Writes one folder of files after the other and lets ``run(stream, folder)`` take what is new after each."""
    folder = own_folder(spark, "files")
    for number, batch in enumerate(batches):
        batch.write.parquet(f"{folder}/{number}")
        run(spark.readStream.schema(batches[0].schema).parquet(f"{folder}/*"), folder).awaitTermination()
    return folder


def stream_upsert(spark, d):
    """Three batches of events stream into a table of each event's latest version."""
    wh, checkpoint = warehouse(spark), own_folder(spark, "checkpoints")
    how = Incremental("merge", ("event_id",), TimePartition("ts", "month"))
    _stream_in(spark, _event_batches(spark, d), lambda stream, _: upsert_stream(
        stream, wh, "gold.events", how, checkpoint, once=True, order_by=("version",)))
    return wh.read("gold.events")


def stream_replace_days(spark, d):
    """New events make the totals of their days run again, over all that has arrived until then: after three batches they
    are the totals of all files."""
    wh, checkpoint = warehouse(spark), own_folder(spark, "checkpoints")
    how = Incremental("microbatch", partition=TimePartition("day", "day"))

    def run(stream, folder):
        def totals(touched) -> DataFrame:
            rows = spark.read.parquet(f"{folder}/*").where(touched("ts"))
            return rows.groupBy(F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("users"))

        return replace_batches_stream(stream.select(F.date_trunc("day", "ts").alias("day")), wh, "gold.days", totals, how, checkpoint, once=True)

    _stream_in(spark, _event_batches(spark, d), run)
    return wh.read("gold.days")


def stream_day_totals(spark, d):
    """The same totals from the stream's own state: no file is read for a second time."""
    wh, checkpoint = warehouse(spark), own_folder(spark, "checkpoints")
    _stream_in(spark, _event_batches(spark, d), lambda stream, _: totals_stream(
        stream, wh, "gold.days", TimePartition("ts", "day"), {"events": "count(*)"}, checkpoint, {"users": ["user_id"]}, "day", once=True))
    return wh.read("gold.days")


# -- facts kept up to date ------------------------------------------------------------------------------


def _second_state(df: DataFrame) -> DataFrame:
    return df.withColumn("order_status", F.concat(F.lit("new "), "order_status"))


def stored_fct_orders(spark, d):
    """The order fact in two runs: the second takes orders placed after the newest stored one, and leaves changes of
    older orders out."""
    wh, how = warehouse(spark), Incremental("merge", ("order_id",), BY_MONTH, ("order_status", "customer_id"))
    # both runs and the sampling for their layout read it: joined and aggregated once
    fact = fixed(Bound(spark, d).orders_enriched())
    inc.build(wh, "gold.fct_orders", lambda change: fact.where(F.col(PLACED) < time_literal(OLD_UNTIL)), how)
    inc.build(wh, "gold.fct_orders", lambda change: inc.newer_than_table(wh, "gold.fct_orders", _second_state(fact), PLACED, BY_MONTH), how)
    return wh.read("gold.fct_orders")


def stored_fct_order_items(spark, d):
    """The item fact in two runs: the second merges all items, those of stored orders with a new price."""
    wh, how = warehouse(spark), Incremental("merge", ("order_id", "order_item_id"), BY_MONTH, ("order_status", "customer_id"), stage=False)
    # both runs and the sampling for their layout read it: joined once, gone after the second run
    with staged(Bound(spark, d).fct_order_items()) as fact:
        inc.build(wh, "gold.fct_order_items", lambda change: fact.where(F.col(PLACED) < time_literal(OLD_UNTIL)), how)
        inc.build(wh, "gold.fct_order_items", lambda change: fact.withColumn("price", F.col("price") + 1), how)
    return wh.read("gold.fct_order_items")


def stored_changed_columns(spark, d):
    """A column in another type, another one dropped: the table keeps its partitions."""
    wh = warehouse(spark)
    wh.write_table("gold.events", table(spark, d, "events").select(*EVENT), TimePartition("ts", "month"))
    inc.change_column_type(wh, "gold.events", "event_id", "string")
    inc.alter_columns(wh, "gold.events", drop=["value"])
    return wh.read("gold.events", technical=True)


def newest_partition(spark, d):
    """Events per type in the newest partition, which the catalog names."""
    wh, by = warehouse(spark), TimePartition("ts", "month")
    wh.write_table("gold.events", table(spark, d, "events").select(*EVENT), by)
    newest = wh.read("gold.events", technical=True).where(F.col(by.column) == F.lit(inc.max_partition(wh, "gold.events")))
    return newest.groupBy("event_type").agg(F.count("*").alias("events"))


def stored_update_nothing(spark, d):
    """A merge all of whose columns to update are missing in the new rows: stored rows stay, new ones are added."""
    wh, how = warehouse(spark), Incremental("merge", ("order_id",), BY_MONTH, update=("customer_id",), on_schema_change="append_new_columns")
    wh.write_table("gold.orders", old_rows(spark, d), BY_MONTH)
    inc.apply(wh, "gold.orders", new_rows(spark, d).drop("customer_id"), how)
    return wh.read("gold.orders")


# -- history ----------------------------------------------------------------------------------------

FIRST_RUN, SECOND_RUN = datetime(2010, 1, 1), datetime(2010, 1, 2)


def _states(spark, d):
    """Two states of the orders: in the second one delivered orders are later, and early ones are gone."""
    o = all_orders(spark, d)
    first = o.where(F.col(PLACED) < time_literal(OLD_UNTIL))
    second = o.where(F.col(PLACED) >= time_literal(NEW_FROM)).withColumn(
        PLACED, F.when(F.col("order_status") == "delivered", F.col(PLACED) + F.make_dt_interval(F.lit(2))).otherwise(F.col(PLACED)))
    return first, second


def _history(how: Tracking):
    def query(spark, d):
        first, second = _states(spark, d)
        return history.next_history(history.first_history(first, how, FIRST_RUN), second, how, SECOND_RUN)

    return query


TRACKED = {
    "scd2_timestamp": Tracking(("order_id",), updated_at=PLACED),
    "scd2_check": Tracking(("order_id",), check=(PLACED, "order_status")),
    "scd2_hard_delete": Tracking(("order_id",), updated_at=PLACED, hard_deletes="invalidate"),
    "scd2_deleted_record": Tracking(("order_id",), updated_at=PLACED, hard_deletes="new_record"),
    "scd2_open_end": Tracking(("order_id", "customer_id"), check="all", open_end=datetime(9999, 12, 31)),
}


def scd2_first_build(spark, d):
    return history.first_history(all_orders(spark, d), TRACKED["scd2_timestamp"], FIRST_RUN)


def scd2_new_column(spark, d):
    """The second state has a column that the history lacks: it is NULL in the versions there were."""
    first, second = _states(spark, d)
    how = TRACKED["scd2_timestamp"]
    return history.next_history(history.first_history(first, how, FIRST_RUN), second.withColumn("note", F.lit("late")), how, SECOND_RUN)


QUERIES = {f.__name__: f for f in (
    merge_upsert, merge_update_columns, merge_exclude_columns, merge_predicates, merge_ambiguous_keys, merge_without_key, append,
    delete_insert, delete_insert_predicate, overwrite_static, overwrite_dynamic, microbatch, high_watermark,
    schema_append_columns, schema_sync_columns, stored_merge, stored_key_merge, stored_overwrite, stream_upsert, stream_replace_days, stream_day_totals,
    stored_fct_orders, stored_fct_order_items, stored_update_nothing,
    stored_changed_columns, newest_partition, scd2_first_build, scd2_new_column,
)} | {name: _history(how) for name, how in TRACKED.items()}


# -- the same in SQL --------------------------------------------------------------------------------

_STATES = """
    o AS (SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM src_orders),
    t AS (SELECT * FROM o WHERE order_purchase_timestamp < TIMESTAMP '2000-01-01'),
    s AS (SELECT order_id, customer_id, 'new ' || order_status AS order_status,
                 CASE WHEN order_status = 'canceled' THEN order_purchase_timestamp + to_days(1)
                      ELSE order_purchase_timestamp END AS order_purchase_timestamp
          FROM o WHERE order_purchase_timestamp >= TIMESTAMP '1998-01-01')
"""


def _state_sql(body: str) -> str:
    head = sql("SELECT * FROM src_orders").removesuffix("SELECT * FROM src_orders").rstrip()
    return f"{head}, {_STATES} {body}"


def _column_merge(columns: str) -> str:
    return _state_sql(f"""
        SELECT t.order_id, {columns} FROM t LEFT JOIN s ON t.order_id = s.order_id
        UNION ALL SELECT * FROM s WHERE order_id NOT IN (SELECT order_id FROM t)""")


_PAYMENTS = """SELECT order_id, payment_type, payment_value FROM order_pays WHERE payment_type <> 'N'"""


def _replaced_payments(condition: str) -> str:
    return sql(f"""
        SELECT order_id, payment_type, 0.0::double AS payment_value FROM order_pays
        WHERE NOT (order_id IN (SELECT order_id FROM order_pays WHERE payment_type <> 'N') AND {condition})
        UNION ALL {_PAYMENTS}""")


_MONTH = "date_trunc('month', order_purchase_timestamp)"
_MERGED = "SELECT * FROM t WHERE order_id NOT IN (SELECT order_id FROM s) UNION ALL SELECT * FROM s"
_DYNAMIC = f"SELECT * FROM t WHERE {_MONTH} NOT IN (SELECT {_MONTH} FROM s) UNION ALL SELECT * FROM s"


def _history_sql(keys: list[str], changed: str, at: str, first_at: str, gone: str = "", extra: str = "", end: str = "NULL") -> str:
    """``at`` and ``first_at``: time of a version of the second and first state. ``gone``: end of a
    removed version. ``extra``: rows for removed keys."""
    on = " AND ".join(f"h.{k} = v2.{k}" for k in keys)
    key_text = " || '|' || ".join(keys)
    flag = ", 'False' AS is_deleted" if extra else ""
    stamp = lambda time, src: f"""
        SELECT *, md5({key_text} || '|' || strftime({time}, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id,
               {time} AS changed_at, {time} AS valid_from, cast({end} AS timestamp) AS valid_to{flag} FROM {src}"""
    closing = f"WHEN v2.order_id IS NULL THEN {gone}" if gone else ""
    head = sql("SELECT * FROM src_orders").removesuffix("SELECT * FROM src_orders").rstrip()
    return f"""{head},
        o AS (SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM src_orders),
        one AS (SELECT * FROM o WHERE order_purchase_timestamp < TIMESTAMP '2000-01-01'),
        two AS (SELECT order_id, customer_id, order_status,
                       CASE WHEN order_status = 'delivered' THEN order_purchase_timestamp + to_days(2)
                            ELSE order_purchase_timestamp END AS order_purchase_timestamp
                FROM o WHERE order_purchase_timestamp >= TIMESTAMP '1998-01-01'),
        h AS ({stamp(first_at, 'one')}), v2 AS ({stamp(at, 'two')})
        SELECT h.* REPLACE (CASE WHEN v2.order_id IS NOT NULL AND ({changed}) THEN v2.valid_from {closing}
                            ELSE h.valid_to END AS valid_to)
        FROM h LEFT JOIN v2 ON {on}
        UNION ALL SELECT v2.* FROM v2 LEFT JOIN h ON {on} WHERE h.order_id IS NULL OR ({changed})
        {extra}"""


_NOW, _THEN = "TIMESTAMP '2010-01-02'", "TIMESTAMP '2010-01-01'"
_LATER = "h.valid_from < v2.valid_from"
_OTHER = ("h.order_purchase_timestamp IS DISTINCT FROM v2.order_purchase_timestamp OR "
          "h.order_status IS DISTINCT FROM v2.order_status")
_GRAVE = f"""UNION ALL
    SELECT order_id, customer_id, order_status, order_purchase_timestamp,
           md5(scd_id || '|' || strftime({_NOW}, '%Y-%m-%d %H:%M:%S.%f')), {_NOW}, {_NOW}, valid_to, 'True'
    FROM h WHERE order_id NOT IN (SELECT order_id FROM v2)"""

_EVENT_VERSIONS = """
    WITH e AS (SELECT event_id, ts, user_id, event_type, value FROM events),
    v AS (SELECT *, 1 AS version FROM e
          UNION ALL SELECT event_id, ts, user_id, event_type || ' again', value, 2 FROM e WHERE event_id % 4 = 0
          UNION ALL SELECT event_id, ts + INTERVAL 31 DAY, user_id, event_type, value + 100, 3 FROM e WHERE event_id % 3 = 0
          UNION ALL SELECT event_id, ts, user_id, 'outdated', value, 0 FROM e WHERE event_id % 6 = 0
          UNION ALL SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN ts END, user_id, 'corrected', value, 4 FROM e WHERE event_id % 5 = 0)"""
_DAY_TOTALS = "SELECT date_trunc('day', ts) AS day, count(*) AS events, count(DISTINCT user_id) AS users FROM v GROUP BY 1"

ORACLE = {
    "merge_upsert": _state_sql(_MERGED),
    "stored_merge": _state_sql(_MERGED),
    "stored_key_merge": _state_sql(_MERGED),
    "merge_update_columns": _column_merge(
        "t.customer_id, coalesce(s.order_status, t.order_status) AS order_status, t.order_purchase_timestamp"),
    "merge_exclude_columns": _column_merge(
        "coalesce(s.customer_id, t.customer_id) AS customer_id, coalesce(s.order_status, t.order_status) AS order_status, "
        "t.order_purchase_timestamp"),
    "merge_predicates": _state_sql("""
        SELECT * FROM t WHERE order_status = 'shipped' OR order_id NOT IN (SELECT order_id FROM s)
        UNION ALL SELECT * FROM s"""),
    "merge_ambiguous_keys": sql("""
        SELECT order_id FROM order_items WHERE order_id IN
            (SELECT order_id FROM src_orders WHERE order_purchase_timestamp < TIMESTAMP '2000-01-01')
        GROUP BY order_id HAVING count(*) > 1"""),
    "merge_without_key": _state_sql("SELECT * FROM t UNION ALL SELECT * FROM s"),
    "append": _state_sql("SELECT * FROM t UNION ALL SELECT * FROM s"),
    "delete_insert": _replaced_payments("true"),
    "delete_insert_predicate": _replaced_payments("payment_type <> 'R'"),
    "overwrite_static": _state_sql(f"""
        SELECT * FROM t WHERE {_MONTH} NOT IN (DATE '1998-03-01', DATE '1998-04-01', DATE '1998-05-01')
        UNION ALL SELECT * FROM s"""),
    "overwrite_dynamic": _state_sql(_DYNAMIC),
    "stored_overwrite": _state_sql(_DYNAMIC),
    "microbatch": _state_sql("""
        SELECT * FROM t WHERE NOT (order_purchase_timestamp >= TIMESTAMP '1999-03-01' AND order_purchase_timestamp < TIMESTAMP '1999-10-01')
        UNION ALL
        SELECT * FROM s WHERE order_purchase_timestamp >= TIMESTAMP '1999-03-01' AND order_purchase_timestamp < TIMESTAMP '1999-10-01'"""),
    "high_watermark": _state_sql("SELECT * FROM o WHERE order_purchase_timestamp > (SELECT max(order_purchase_timestamp) FROM t)"),
    "schema_append_columns": _state_sql("""
        SELECT *, NULL::varchar AS note FROM t
        UNION ALL SELECT order_id, NULL, order_status, order_purchase_timestamp, 'late' FROM s"""),
    "schema_sync_columns": _state_sql("""
        SELECT order_id, order_status, cast(order_purchase_timestamp AS date) AS order_purchase_timestamp, NULL::varchar AS note FROM t
        UNION ALL SELECT order_id, order_status, cast(order_purchase_timestamp AS date), 'late' FROM s"""),
    "stream_upsert": f"""{_EVENT_VERSIONS}
        SELECT event_id, ts, user_id, event_type, value, version FROM v QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY version DESC) = 1""",
    "stream_replace_days": f"{_EVENT_VERSIONS} {_DAY_TOTALS}",
    "stream_day_totals": f"{_EVENT_VERSIONS} {_DAY_TOTALS}",
    "stored_changed_columns": """
        SELECT cast(event_id AS varchar) AS event_id, ts, user_id, event_type, cast(date_trunc('month', ts) AS date) AS ts_month FROM events""",
    "newest_partition": """
        SELECT event_type, count(*) AS events FROM events
        WHERE date_trunc('month', ts) = (SELECT max(date_trunc('month', ts)) FROM events) GROUP BY 1""",
    "stored_fct_orders": sql(f"""
        SELECT * REPLACE (CASE WHEN {PLACED} > (SELECT max({PLACED}) FROM orders_enriched WHERE {PLACED} < TIMESTAMP '2000-01-01')
                               THEN 'new ' || order_status ELSE order_status END AS order_status) FROM orders_enriched
        WHERE {PLACED} IS NOT NULL"""),
    "stored_fct_order_items": sql("SELECT * REPLACE (price + 1 AS price) FROM fct_order_items"),
    "stored_update_nothing": sql(f"""
        SELECT order_id, customer_id, order_status, {PLACED} FROM src_orders WHERE {PLACED} < TIMESTAMP '2000-01-01' UNION ALL
        SELECT order_id, NULL, 'new ' || order_status, CASE WHEN order_status = 'canceled' THEN {PLACED} + INTERVAL 1 DAY ELSE {PLACED} END
        FROM src_orders WHERE {PLACED} >= TIMESTAMP '2000-01-01'"""),
    "scd2_first_build": sql("""
        SELECT order_id, customer_id, order_status, order_purchase_timestamp,
               md5(order_id || '|' || strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id,
               order_purchase_timestamp AS changed_at, order_purchase_timestamp AS valid_from, NULL::timestamp AS valid_to
        FROM src_orders"""),
    "scd2_timestamp": _history_sql(["order_id"], _LATER, PLACED, PLACED),
    "scd2_new_column": _history_sql(["order_id"], _LATER, PLACED, PLACED).replace("one AS (SELECT *", "one AS (SELECT *, NULL::varchar AS note").replace(
        "END AS order_purchase_timestamp", "END AS order_purchase_timestamp, 'late' AS note"),
    "scd2_check": _history_sql(["order_id"], _OTHER, _NOW, _THEN),
    "scd2_hard_delete": _history_sql(["order_id"], _LATER, PLACED, PLACED, gone=_NOW),
    "scd2_deleted_record": _history_sql(["order_id"], _LATER, PLACED, PLACED, gone=_NOW, extra=_GRAVE),
    "scd2_open_end": _history_sql(["order_id", "customer_id"], _OTHER, _NOW, _THEN, end="TIMESTAMP '9999-12-31'"),
}
