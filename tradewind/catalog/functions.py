"""Registered queries for functions, aggregates, windows, sets and partitions."""

from __future__ import annotations

from datetime import timedelta

import pandas as pd
from pyspark.sql import functions as F

from tradewind.catalog.bound import Bound, sql
from tradewind.functions import aggregates, casts, dates, predicates, text
from tradewind.operators import functions as user_functions, sets
from tradewind.plans.sellers import zip_locations
from tradewind.sources.bindings import table
from tradewind.sources.shards import group_shards
from tradewind.sources.tables import RangePartition, TimePartition


def elapsed_vs_boundary(spark, d):
    """Both differences between a user's first and last event."""
    span = table(spark, d, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return span.select(
        "user_id",
        *[dates.elapsed("b", "a", u).alias(f"elapsed_{u}") for u in ("day", "hour")],
        dates.elapsed("a", "b", "day").alias("elapsed_back"),
        *[dates.boundaries("a", "b", u).alias(f"border_{u}")
          for u in ("day", "hour", "minute", "week", "isoweek", "month", "quarter", "year")],
    )


def date_functions(spark, d):
    ts = F.col("ts")
    return table(spark, d, "events").select(
        "event_id",
        *[dates.truncate(p, ts).alias(f"trunc_{p}") for p in ("hour", "day", "week", "isoweek", "month", "quarter", "year")],
        *[dates.last_day(ts, p).alias(f"last_day_{p}") for p in ("month", "quarter", "year")],
        dates.date_add("day", -40, ts).alias("minus_40_days"),
        dates.date_add("month", 1, ts).alias("next_month"),
        dates.date_add("hour", (F.col("event_id") % 100).cast("int"), ts).alias("plus_hours"),
        dates.make_date(F.year("ts"), F.month("ts"), 1).alias("first_of_month"),
        dates.to_timestamp(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).alias("from_text"),
    )


def _order_days(spark, d):
    first, last = table(spark, d, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    return first, last + timedelta(days=1)


def date_spine(spark, d):
    """Orders per day, with every day from the first to the last."""
    first, end = _order_days(spark, d)
    spine = dates.date_spine(spark, "day", str(first), str(end))
    orders = table(spark, d, "orders").groupBy(F.col("o_orderdate").alias("date_day")).agg(F.count("*").alias("n"))
    return spine.join(orders, "date_day", "left").select("date_day", F.coalesce("n", F.lit(0)).alias("orders"))


def date_spine_month(spark, d):
    first, end = _order_days(spark, d)
    spine = dates.date_spine(spark, "month", str(first), str(end))
    month = F.date_trunc("month", "o_orderdate").alias("date_month")
    orders = table(spark, d, "orders").groupBy(month).agg(aggregates.money_sum("o_totalprice", 2).alias("total"))
    return spine.join(orders, "date_month", "left").select("date_month", "total")


def partition_days(spark, d):
    """Orders of the days named by a partition range."""
    return table(spark, d, "orders").where(dates.in_days("o_orderdate", "19980301,19980331"))


def generate_series(spark, d):
    """Lines per line number, for every number up to the largest."""
    n = table(spark, d, "lineitem").agg(F.max("l_linenumber")).first()[0] + 2
    lines = table(spark, d, "lineitem").groupBy(F.col("l_linenumber").alias("generated_number")).agg(F.count("*").alias("n"))
    return dates.generate_series(spark, n).join(lines, "generated_number", "left").select(
        "generated_number", F.coalesce("n", F.lit(0)).alias("lines"))


def string_functions(spark, d):
    name, props = F.col("p_name"), F.col("p_brand")
    return table(spark, d, "part").select(
        "p_partkey",
        text.clean_string(F.concat(F.lit("\t  "), name, F.lit("   \n"))).alias("cleaned"),
        text.concat(name, F.when(F.col("p_size") > 10, props)).alias("joined"),
        text.length(name).cast("bigint").alias("len"),
        text.position("i", name).cast("bigint").alias("pos"),
        text.replace(name, "ring", "loop").alias("replaced"),
        *[text.right(name, n).alias(f"right_{n}") for n in (0, 3, 99)],
        *[text.split_part(name, " ", n).alias(f"part_{'m' if n < 0 else 'p'}{abs(n)}") for n in (1, 2, 3, -1, -2, -3)],
        text.split_part(props, "#", 2).alias("brand_number"),
        text.hash_text("p_size").alias("hashed"),
        text.regexp_extract(props, r"([0-9]+)$").alias("digits"),
        text.regexp_contains(name, "^(red|blue) ").alias("is_red_or_blue"),
    )


def document_functions(spark, d):
    """Text functions over whole documents."""
    return table(spark, d, "documents").select(
        "doc_id",
        text.hash_text("text").alias("hashed"),
        text.length("text").cast("bigint").alias("len"),
        text.split_part("text", ".", 2).alias("second"),
        text.split_part("text", ".", -1).alias("last"),
        text.hash_text(text.replace("text", "a", "")).alias("without_a"),
        text.position("the", "text").cast("bigint").alias("pos"),
    )


def array_functions(spark, d):
    made = casts.array_construct("p_size", F.length("p_name"), type_name="bigint")
    return table(spark, d, "part").select(
        "p_partkey",
        casts.array_to_string(casts.array_append(made, F.lit(7).cast("bigint")), "/").alias("appended"),
        casts.array_to_string(casts.array_concat(made, made), "-").alias("doubled"),
        F.size(casts.array_construct(type_name="string")).cast("bigint").alias("empty_size"),
    )


def safe_cast(spark, d):
    number = text.split_part("p_brand", "#", 2)
    maybe = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(number)
    return table(spark, d, "part").select(
        "p_partkey",
        casts.safe_cast(maybe, "int").alias("as_int"),
        casts.safe_cast(F.concat(number, F.lit(".5")), "float").alias("as_float"),
        casts.safe_cast(F.when(F.col("p_size") > 25, "2024-02-30").otherwise("2024-02-28"), "date").alias("as_date"),
        casts.cast("p_retailprice", "numeric").cast("double").alias("as_numeric"),
        casts.bool_to_text(F.col("p_size") > 10).alias("bool_text"),
        casts.array_to_string(casts.safe_cast(F.array(number, F.col("p_name")), "array<int>").cast("array<string>"), ",")
        .alias("as_array"),
        casts.typed_null("int").alias("no_int"),
    )


def safe_json(spark, d):
    """Event properties as JSON, and NULL for text that is none."""
    json = casts.safe_cast(F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.col("event_type")), "json")
    return table(spark, d, "events").select(
        "event_id", json.isNotNull().alias("is_json"), F.try_variant_get(json, "$.k", "bigint").alias("k"))


def safe_divide(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_linenumber").cast("bigint")).alias("a"),
        F.count_if(F.col("l_returnflag") == "R").alias("b"),
    ).select("l_orderkey", casts.safe_divide("a", "b").alias("ratio"), predicates.equals("a", "b").alias("same"))


def null_safe_equals(spark, d):
    """Orders whose approval equals a time that is sometimes NULL."""
    other = F.when(F.col("order_status") == "shipped", F.col("order_purchase_timestamp"))
    return Bound(spark, d).source("orders").select(
        "order_id", predicates.equals("order_approved_at", other).alias("plain"),
        predicates.equals("order_approved_at", other, null_safe=True).alias("null_safe"))


def range_bucket(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", predicates.range_bucket("c_acctbal", 0, 9000, 1000).alias("bucket"))


def range_partition(spark, d):
    """Customers per range partition of their nation."""
    part = RangePartition("c_nationkey", 5, 20, 5)
    return table(spark, d, "customer").groupBy(part.value().alias("part")).agg(F.count("*").alias("n"))


def time_partitions(spark, d):
    ts = TimePartition("ts", "hour"), TimePartition("ts", "month"), TimePartition("ts", "year")
    return table(spark, d, "events").groupBy(*[p.value().alias(p.granularity) for p in ts]).agg(F.count("*").alias("n"))


def listagg_limit(spark, d):
    """First five event types of every user, by time."""
    return aggregates.listagg_first(table(spark, d, "events"), ["user_id"], "event_type", ", ", ["ts"], 5, "first_types")


def listagg_per_order(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        aggregates.listagg(F.col("l_linenumber").cast("string"), "|", ["l_linenumber"]).alias("numbers"),
        aggregates.ordered_list("l_returnflag", F.struct("l_shipdate", "l_returnflag"), "").alias("flags"),
    )


def distinct_list(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(aggregates.distinct_list("event_type").alias("types"))


def any_row(spark, d):
    """One location per zip code."""
    return zip_locations(Bound(spark, d).source("geolocations"))


def bool_or(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        aggregates.bool_or(F.col("l_returnflag") == "R").alias("any_returned"))


def distinct_partitions(spark, d):
    return table(spark, d, "orders").select(F.date_trunc("month", "o_orderdate").alias("month")).distinct()


def number_in_group(spark, d):
    """Lines of an order numbered by ship date."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_partkey", "l_suppkey", "l_linenumber")
    return sets.number_in_group(lines, ["l_orderkey"], ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"], "item_number")


def except_distinct(spark, d):
    """Suppliers and parts of all lines, without those that were ever returned."""
    li = table(spark, d, "lineitem")
    return sets.except_distinct(li.select("l_suppkey", "l_partkey"), li.where("l_returnflag = 'R'").select("l_suppkey", "l_partkey"))


def intersect_distinct(spark, d):
    li = table(spark, d, "lineitem")
    return sets.intersect_distinct(
        li.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber"),
        li.where("l_returnflag <> 'R'").select("l_orderkey", "l_linenumber"))


def union_all(spark, d):
    return sets.union_all(table(spark, d, "customer").select(F.col("c_nationkey").alias("nation")),
                          table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation")))


def tuple_in(spark, d):
    """Lines whose order and part occur among the returned ones."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    return sets.rows_in(li, ["l_orderkey", "l_partkey"], li.where("l_returnflag = 'R'"))


def tuple_not_in(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    return sets.rows_not_in(li, ["l_orderkey", "l_partkey"], li.where("l_returnflag = 'R'"))


def preview(spark, d):
    """The ten highest orders."""
    return sets.preview(table(spark, d, "orders"), 10, [F.desc("o_totalprice"), "o_orderkey"])


def date_shards(spark, d):
    """A listing of daily tables folded to one row per family."""
    day = F.date_format("o_orderdate", "yyyyMMdd")
    listing = table(spark, d, "orders").groupBy(
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.concat(F.lit("orders_"), day)).alias("table_name")
    ).agg(F.count("*").alias("row_count"), (F.count("*") * 8).alias("size_bytes"))
    return group_shards(listing)


def scalar_function(spark, d):
    user_functions.create_scalar_function(
        spark, "tw_net", {"price": "float64", "discount": "float64"}, "float64", "price * (1 - discount)")
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.expr("tw_net(l_extendedprice, l_discount)").alias("net"))


WEIGHTED_MEAN = user_functions.Aggregate(
    "tw_weighted_mean", {"value": "float64", "weight": "float64"}, "float64", {"total": ("double", "sum"), "weight": ("double", "sum")},
    lambda rows: {"total": float((rows["value"] * rows["weight"]).sum()), "weight": float(rows["weight"].sum())},
    lambda states: states["total"] / states["weight"])


def aggregate_function(spark, d):
    """Mean quantity weighted by line number, by an aggregate that SQL calls by its name."""
    WEIGHTED_MEAN.register(spark)
    table(spark, d, "lineitem").createOrReplaceTempView("tw_lines")
    return spark.sql("SELECT l_suppkey, tw_weighted_mean(l_quantity, l_linenumber) AS mean_quantity FROM tw_lines GROUP BY l_suppkey")


def aggregate_function_over(spark, d):
    """The same aggregate in bounded memory, whatever the size of a group."""
    found = WEIGHTED_MEAN.over(table(spark, d, "lineitem"), ["l_suppkey"], "l_quantity", "l_linenumber")
    return found.withColumnRenamed("tw_weighted_mean", "mean_quantity")


def python_aggregate(spark, d):
    """Events per user and their latest hour, with a first step in pandas."""
    def partial(batch: pd.DataFrame) -> pd.DataFrame:
        hour = batch["ts"].dt.hour
        return batch.assign(hour=hour).groupby("user_id", as_index=False).agg(n=("event_id", "count"), hour=("hour", "max"))

    return user_functions.python_aggregate(
        table(spark, d, "events").select("event_id", "user_id", "ts"), ["user_id"], partial,
        "user_id bigint, n bigint, hour int", {"n": F.sum("n"), "hour": F.max("hour")},
        {"events": F.col("n"), "latest_hour": F.col("hour")})


QUERIES = {f.__name__: f for f in (
    elapsed_vs_boundary, date_functions, date_spine, date_spine_month, partition_days, generate_series,
    string_functions, document_functions, array_functions, safe_cast, safe_json, safe_divide, null_safe_equals,
    range_bucket, range_partition, time_partitions, listagg_limit, listagg_per_order, distinct_list, any_row, bool_or,
    distinct_partitions, number_in_group, except_distinct, intersect_distinct, union_all, tuple_in, tuple_not_in, preview,
    date_shards, scalar_function, aggregate_function, aggregate_function_over, python_aggregate,
)}

_SPACE = "' ' || chr(9) || chr(10) || chr(160) || chr(8195)"
_TRUNC = ", ".join(f"cast(date_trunc('{p}', ts) AS timestamp) AS trunc_{p}" for p in ("hour", "day", "month", "quarter", "year"))


def _nth(col: str, delimiter: str, n: int) -> str:
    """DuckDB lists count from 1 and, backwards, from -1; out of range is NULL."""
    return f"string_split({col}, '{delimiter}')[{n}]"


ORACLE = {
    "elapsed_vs_boundary": """
        WITH s AS (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events GROUP BY user_id)
        SELECT user_id, date_sub('day', a, b) AS elapsed_day, date_sub('hour', a, b) AS elapsed_hour,
               date_sub('day', b, a) AS elapsed_back, date_diff('day', a, b) AS border_day, date_diff('hour', a, b) AS border_hour,
               date_diff('minute', a, b) AS border_minute,
               date_diff('day', date_trunc('week', a + to_days(1)), date_trunc('week', b + to_days(1))) // 7 AS border_week,
               date_diff('day', date_trunc('week', a), date_trunc('week', b)) // 7 AS border_isoweek,
               date_diff('month', a, b) AS border_month, date_diff('quarter', a, b) AS border_quarter,
               date_diff('year', a, b) AS border_year
        FROM s""",
    "date_functions": f"""
        SELECT event_id, {_TRUNC}, cast(date_trunc('week', ts) AS timestamp) AS trunc_isoweek,
               cast(date_trunc('week', ts + to_days(1)) AS timestamp) - to_days(1) AS trunc_week,
               cast(date_trunc('month', ts) + to_months(1) - to_days(1) AS date) AS last_day_month,
               cast(date_trunc('quarter', ts) + to_months(3) - to_days(1) AS date) AS last_day_quarter,
               cast(date_trunc('year', ts) + to_months(12) - to_days(1) AS date) AS last_day_year,
               ts - to_days(40) AS minus_40_days, ts + to_months(1) AS next_month,
               ts + to_hours(event_id % 100) AS plus_hours, make_date(year(ts), month(ts), 1) AS first_of_month,
               date_trunc('second', ts) AS from_text
        FROM events""",
    "date_spine": """
        SELECT day AS date_day, (SELECT count(*) FROM orders WHERE o_orderdate = day) AS orders
        FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders),
                                            INTERVAL 1 DAY)) AS day)""",
    "date_spine_month": """
        SELECT month AS date_month, (SELECT cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) FROM orders WHERE date_trunc('month', o_orderdate) = month) AS total
        FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders),
              (SELECT max(o_orderdate) FROM orders) + INTERVAL 1 DAY - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS month)""",
    "partition_days": "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-04-01'",
    "generate_series": """
        SELECT i AS generated_number, (SELECT count(*) FROM lineitem WHERE l_linenumber = i) AS lines
        FROM (SELECT unnest(range(1, (SELECT max(l_linenumber) + 3 FROM lineitem))) AS i)""",
    "string_functions": f"""
        SELECT p_partkey, trim(chr(9) || '  ' || p_name || ' ' || chr(160) || chr(8195) || chr(10), {_SPACE}) AS cleaned,
               p_name || CASE WHEN p_size > 10 THEN p_brand END AS joined, length(p_name) AS len,
               position('i' IN p_name) AS pos, replace(p_name, 'ring', 'loop') AS replaced,
               '' AS right_0, right(p_name, 3) AS right_3, p_name AS right_99,
               {", ".join(f"{_nth('p_name', ' ', n)} AS part_{'m' if n < 0 else 'p'}{abs(n)}" for n in (1, 2, 3, -1, -2, -3))},
               {_nth('p_brand', '#', 2)} AS brand_number, md5(cast(p_size AS varchar)) AS hashed,
               regexp_extract(p_brand, '([0-9]+)$', 1) AS digits, regexp_matches(p_name, '^(red|blue) ') AS is_red_or_blue
        FROM part""",
    "document_functions": f"""
        SELECT doc_id, md5(text) AS hashed, length(text) AS len, {_nth('text', '.', 2)} AS second, {_nth('text', '.', -1)} AS last,
               md5(replace(text, 'a', '')) AS without_a, position('the' IN text) AS pos
        FROM documents""",
    "array_functions": """
        SELECT p_partkey, concat_ws('/', p_size, length(p_name), 7) AS appended,
               concat_ws('-', p_size, length(p_name), p_size, length(p_name)) AS doubled, 0::bigint AS empty_size
        FROM part""",
    "safe_cast": """
        SELECT p_partkey,
               try_cast(CASE WHEN p_size % 3 = 0 THEN p_name ELSE string_split(p_brand, '#')[2] END AS bigint) AS as_int,
               cast(string_split(p_brand, '#')[2] || '.5' AS double) AS as_float,
               CASE WHEN p_size <= 25 THEN DATE '2024-02-28' END AS as_date, p_retailprice AS as_numeric,
               CASE WHEN p_size > 10 THEN 'true' ELSE 'false' END AS bool_text, string_split(p_brand, '#')[2] AS as_array,
               NULL::bigint AS no_int
        FROM part""",
    "safe_json": """
        SELECT event_id, event_id % 2 = 0 AS is_json,
               CASE WHEN event_id % 2 = 0 THEN cast(regexp_extract(props, '"k": ([0-9]+)', 1) AS bigint) END AS k
        FROM events""",
    "safe_divide": """
        SELECT l_orderkey, sum(l_linenumber)::double / nullif(count(*) FILTER (l_returnflag = 'R'), 0) AS ratio,
               sum(l_linenumber) = count(*) FILTER (l_returnflag = 'R') AS same
        FROM lineitem GROUP BY l_orderkey""",
    "null_safe_equals": sql("""
        SELECT order_id, order_approved_at = (CASE WHEN order_status = 'shipped' THEN order_purchase_timestamp END) AS plain,
               order_approved_at IS NOT DISTINCT FROM (CASE WHEN order_status = 'shipped' THEN order_purchase_timestamp END) AS null_safe
        FROM src_orders"""),
    "range_bucket": """
        SELECT c_custkey, cast(least(greatest(floor(c_acctbal / 1000) + 1, 0), 10) AS bigint) AS bucket FROM customer""",
    "range_partition": """
        SELECT CASE WHEN c_nationkey < 5 THEN 0 WHEN c_nationkey < 10 THEN 1 WHEN c_nationkey < 15 THEN 2
                    WHEN c_nationkey < 20 THEN 3 ELSE 4 END::bigint AS part, count(*) AS n
        FROM customer GROUP BY 1""",
    "time_partitions": """
        SELECT strftime(ts, '%Y-%m-%d-%H') AS hour, cast(date_trunc('month', ts) AS date) AS month,
               cast(date_trunc('year', ts) AS date) AS year, count(*) AS n
        FROM events GROUP BY 1, 2, 3""",
    "listagg_limit": """
        SELECT user_id, string_agg(event_type, ', ' ORDER BY ts, event_type) AS first_types FROM (
            SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type) <= 5)
        GROUP BY user_id""",
    "listagg_per_order": """
        SELECT l_orderkey, string_agg(cast(l_linenumber AS varchar), '|' ORDER BY l_linenumber) AS numbers,
               string_agg(l_returnflag, '' ORDER BY l_shipdate, l_returnflag) AS flags
        FROM lineitem GROUP BY l_orderkey""",
    "distinct_list": "SELECT user_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS types FROM events GROUP BY user_id",
    "any_row": sql("""
        SELECT * FROM geolocations QUALIFY row_number() OVER (PARTITION BY geolocation_zip_code_prefix
            ORDER BY geolocation_lat, geolocation_lng, geolocation_city, geolocation_state) = 1"""),
    "bool_or": "SELECT l_orderkey, bool_or(l_returnflag = 'R') AS any_returned FROM lineitem GROUP BY l_orderkey",
    "distinct_partitions": "SELECT DISTINCT cast(date_trunc('month', o_orderdate) AS timestamp) AS month FROM orders",
    "number_in_group": """
        SELECT l_orderkey, l_shipdate, l_partkey, l_suppkey, l_linenumber,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber) AS item_number
        FROM lineitem""",
    "except_distinct": """
        SELECT l_suppkey, l_partkey FROM lineitem
        EXCEPT SELECT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag = 'R'""",
    "intersect_distinct": """
        SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'
        INTERSECT SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'R'""",
    "union_all": "SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier",
    "tuple_in": """
        SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem
        WHERE (l_orderkey, l_partkey) IN (SELECT (l_orderkey, l_partkey) FROM lineitem WHERE l_returnflag = 'R')""",
    "tuple_not_in": """
        SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem
        WHERE (l_orderkey, l_partkey) NOT IN (SELECT (l_orderkey, l_partkey) FROM lineitem WHERE l_returnflag = 'R')""",
    "preview": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "date_shards": """
        WITH t AS (SELECT CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'orders_' || strftime(o_orderdate, '%Y%m%d') END AS name,
                          count(*) AS n FROM orders GROUP BY 1)
        SELECT CASE WHEN name = 'pending' THEN name ELSE 'orders_' END AS table_family, name <> 'pending' AS is_sharded,
               min(CASE WHEN name <> 'pending' THEN right(name, 8) END) AS shard_min,
               max(CASE WHEN name <> 'pending' THEN right(name, 8) END) AS shard_max,
               count(CASE WHEN name <> 'pending' THEN 1 END) AS shard_count,
               cast(sum(n) AS bigint) AS row_count, cast(sum(n) * 8 AS bigint) AS size_bytes
        FROM t GROUP BY 1, 2""",
    "scalar_function": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * (1 - l_discount) AS net FROM lineitem""",
    "aggregate_function": """
        SELECT l_suppkey, sum(l_quantity * l_linenumber) / sum(l_linenumber) AS mean_quantity FROM lineitem GROUP BY l_suppkey""",
    "aggregate_function_over": """
        SELECT l_suppkey, sum(l_quantity * l_linenumber) / sum(l_linenumber) AS mean_quantity FROM lineitem GROUP BY l_suppkey""",
    "python_aggregate": "SELECT user_id, count(*) AS events, cast(max(hour(ts)) AS integer) AS latest_hour FROM events GROUP BY user_id",
}
