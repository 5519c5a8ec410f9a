"""Functions on values where engines differ."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tradewind.functions import aggregates, casts, dates, predicates, text
from tradewind.operators import functions as user_functions, sets


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def ts(s):
    return F.lit(s).cast("timestamp")


def test_elapsed_truncates_toward_zero(spark):
    a, b = ts("2024-01-01 10:00:00"), ts("2024-01-03 09:59:59")
    assert one(spark, dates.elapsed(b, a), dates.elapsed(a, b), dates.elapsed(b, a, "hour"), dates.boundaries(a, b)) == (1, -1, 47, 2)
    a, b = ts("2024-01-01 00:00:00"), ts("2023-12-31 22:30:00")
    assert one(spark, dates.elapsed(b, a, "hour"), dates.elapsed(b, a), dates.boundaries(a, b), dates.boundaries(a, b, "hour")) == (-1, 0, -1, -2)
    assert one(spark, dates.elapsed(F.lit(None).cast("timestamp"), a)) == (None,)


def test_boundaries_of_parts(spark):
    a, b = ts("2023-12-30 23:59:59"), ts("2024-01-01 00:00:00")  # Saturday to Monday
    got = one(spark, *[dates.boundaries(a, b, p) for p in ("day", "week", "isoweek", "month", "quarter", "year", "minute", "second")])
    assert got == (2, 1, 1, 1, 1, 1, 1441, 86401)
    with pytest.raises(ValueError):
        dates.boundaries(a, b, "fortnight")


def test_dates(spark):
    d = ts("2024-02-29 13:00:00")
    assert one(spark, *[dates.last_day(d, p) for p in ("month", "quarter", "year")]) == (date(2024, 2, 29), date(2024, 3, 31), date(2024, 12, 31))
    assert one(spark, dates.date_add("month", 12, d), dates.date_add("hour", F.lit(-14), d)) == (datetime(2025, 2, 28, 13), datetime(2024, 2, 28, 23))
    assert one(spark, dates.truncate("week", d), dates.truncate("isoweek", d)) == (datetime(2024, 2, 25), datetime(2024, 2, 26))
    assert one(spark, dates.make_date(2024, 2, 1)) == (date(2024, 2, 1),)


def test_series(spark):
    spine = [r[0] for r in dates.date_spine(spark, "month", "2024-01-31", "2024-04-01").collect()]
    assert sorted(spine) == [datetime(2024, 1, 31), datetime(2024, 2, 29), datetime(2024, 3, 31)]
    assert dates.date_spine(spark, "day", "2024-01-02", "2024-01-02").count() == 0
    assert dates.date_spine(spark, "day", "2024-01-03", "2024-01-02").count() == 0
    assert dates.intervals_between(spark, "2024-01-01", "2024-03-01", "day") == 60
    assert sorted(r[0] for r in dates.generate_series(spark, 3).collect()) == [1, 2, 3]
    with pytest.raises(ValueError):
        dates.generate_series(spark, 0)


def test_day_ranges(spark):
    assert [r.day for r in dates.day_range(spark, "20240228,20240301").collect()] == ["20240228", "20240229", "20240301"]
    assert [r.day for r in dates.day_range(spark, "2024-01-01", "%Y-%m-%d", "dd/MM").collect()] == ["01/01"]
    assert [r.day for r in dates.day_range(spark, 20240101, out=None).collect()] == [date(2024, 1, 1)]
    df = spark.sql("SELECT explode(array(timestamp'2023-12-31 23:59:59', timestamp'2024-01-01', timestamp'2024-01-02 23:59:59.999999', timestamp'2024-01-03')) AS t")
    assert df.where(dates.in_days("t", "20240101, 20240102")).count() == 2
    for bad in ("20240102,20240101", "a", "1,2,3"):
        with pytest.raises(ValueError):
            dates.in_days("t", bad)


def test_day_ranges_reach_the_scan(spark, tmp_path):
    spark.sql("SELECT timestamp'2024-01-01' AS t").write.parquet(str(tmp_path / "t"))
    plan = spark.read.parquet(str(tmp_path / "t")).where(dates.in_days("t", "20240101"))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(t," in plan and "LessThan(t," in plan


def test_clean_string(spark):
    assert one(spark, text.clean_string(F.lit(" \t a b 　\n")), text.clean_string(F.lit("  ")), text.clean_string(F.lit(5))) == ("a b", "", "5")


def test_split_part(spark):
    c = F.lit("a.b..c")
    assert one(spark, *[text.split_part(c, ".", n) for n in (1, 3, 4, 5, -1, -4, -5, 0)]) == ("a", "", "c", None, "c", "a", None, None)
    assert one(spark, text.split_part(F.lit("a||b||c"), "||", -1), text.split_part(F.lit("a\\Eb"), "\\E", 2)) == ("c", "b")


def test_text(spark):
    assert one(spark, text.position("lo", F.lit("hello")), text.position("x", F.lit("hello")), text.position(F.lit("e"), F.lit("hello"))) == (4, 0, 2)
    assert one(spark, text.right(F.lit("abc"), 0), text.right(F.lit("abc"), 2), text.right(F.lit("abc"), 9)) == ("", "bc", "abc")
    assert one(spark, text.concat(F.lit("a"), F.lit(1)), text.concat(F.lit("a"), F.lit(None))) == ("a1", None)
    assert one(spark, text.regexp_extract(F.lit("t_20240101"), r"^(.+)[0-9]{8}$"), text.regexp_extract(F.lit("t"), r"^(.+)[0-9]{8}$")) == ("t_", None)
    assert one(spark, text.replace(F.lit("a.a"), ".", "-"), text.length(F.lit("né")), text.hash_text(F.lit(7))) == ("a-a", 2, "8f14e45fceea167a5a36dedd4bea2543")


def test_casts(spark):
    assert one(spark, casts.safe_cast(F.lit("12.7"), "int"), casts.safe_cast(F.lit("9999999999"), "int")) == (None, 9999999999)
    assert one(spark, casts.safe_cast(F.array(F.lit("1"), F.lit("x"), F.lit(None)), "array<int64>")) == ([1, None, None],)
    assert one(spark, casts.safe_cast(F.lit('{"a": 1}'), "json").isNotNull(), casts.safe_cast(F.lit("{"), "json").isNotNull()) == (True, False)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, casts.cast(F.lit("12.7"), "int"))
    assert one(spark, casts.safe_divide(F.lit(1), F.lit(0)), casts.safe_divide(F.lit(1), F.lit(4)), casts.bool_to_text(F.lit(True))) == (None, 0.25, "true")
    assert spark.range(1).select(casts.cast("id", "numeric").alias("n"), casts.typed_null("date").alias("d")).dtypes == [("n", "decimal(28,6)"), ("d", "date")]


def test_predicates(spark):
    null = F.lit(None).cast("int")
    assert one(spark, predicates.equals(null, null), predicates.equals(null, null, True), predicates.equals(F.lit(1), F.lit(1))) == (None, True, True)
    steps = ((5, "high"), (2, "mid"))
    assert one(spark, *[predicates.tier(v, steps, "low") for v in (F.lit(5), F.lit(4), F.lit(1), null)]) == ("high", "mid", "low", "low")
    assert one(spark, *[predicates.range_bucket(F.lit(v), 0, 10, 5) for v in (-1, 0, 4, 5, 9, 10, 99)]) == (0, 1, 1, 2, 2, 3, 3)
    assert one(spark, predicates.range_bucket(null, 0, 10, 5)) == (None,)


def test_aggregates(spark):
    df = spark.createDataFrame([("k", "b", 2, 0.1), ("k", "a", 1, 0.2), ("k", None, 0, None), ("k", "b", 3, 0.3), ("n", None, 1, None)], "k string, v string, o int, m double")
    got = {r.k: r for r in df.groupBy("k").agg(
        aggregates.distinct_list("v").alias("d"), aggregates.listagg("v", "-", ["o"]).alias("l"),
        aggregates.ordered_list("v", "o", "").alias("o"), aggregates.money_sum("m", 2).alias("s"),
        aggregates.money_avg("m", 2).alias("a"), aggregates.money_sum("m").alias("f"), aggregates.bool_or(F.col("o") > 2).alias("any")).collect()}
    assert got["k"][1:] == ("a, b", "a-b-b", "abb", 0.6, pytest.approx(0.2), pytest.approx(0.6), True)
    assert got["n"][1:] == (None, None, None, None, None, None, False)
    first = {r.k: r.first for r in aggregates.listagg_first(df, ["k"], "v", ",", ["o"], 2, "first").collect()}
    assert first == {"k": "a,b", "n": None}


def test_any_row_takes_one_row(spark):
    df = spark.createDataFrame([(1, None, "z"), (1, 2.0, "b"), (1, 2.0, "a"), (1, 3.0, "c"), (2, None, None)], "k int, x double, y string")
    got = {r.k: (r.r.x, r.r.y) for r in df.groupBy("k").agg(aggregates.any_row("x", "y").alias("r")).collect()}
    assert got == {1: (2.0, "a"), 2: (None, None)}


def test_sets(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(None, 1), ("x", 2), ("x", 2)], "v string, k int")
    rows = lambda df: sorted([tuple(r) for r in df.collect()], key=str)
    assert rows(sets.except_distinct(a, b)) == [(3, "y")]
    assert rows(sets.intersect_distinct(a, b)) == [(1, None), (2, "x")]
    assert sets.union_all(a, b, b).count() == 10
    assert rows(sets.rows_in(a, ["k", "v"], b)) == [(2, "x")]
    assert rows(sets.rows_not_in(a, ["k", "v"], b)) == [(1, None), (1, None), (3, "y")]
    assert sets.filtered(a, "k = 1").count() == 2 and sets.filtered(a, None).count() == 4
    assert rows(sets.preview(a, 1, ["k", "v"])) == [(1, None)]


def test_number_in_group_against_brute_force(spark):
    import random

    rng = random.Random(7)
    data = [("hot" if rng.random() < 0.4 else f"g{rng.randrange(50)}", rng.choice([None, *range(300)]), i) for i in range(4000)]
    df = spark.createDataFrame(data, "g string, o int, i int")
    got = {r.i: r.number for r in sets.number_in_group(df, ["g"], ["o", "i"]).collect()}
    want, groups = {}, {}
    for g, o, i in data:
        groups.setdefault(g, []).append((o is not None, o or 0, i))
    for rows in groups.values():
        for n, (_, _, i) in enumerate(sorted(rows), 1):
            want[i] = n
    assert got == want


def test_user_functions(spark):
    user_functions.create_scalar_function(spark, "add_tax", {"x": "float64", "r": "float64"}, "float64", "x * (1 + r)")
    assert spark.sql("SELECT add_tax(10, 0.5)").first()[0] == 15.0
    with pytest.raises(ValueError):
        user_functions.create_scalar_function(spark, "f", {}, "int", "1", volatility="sometimes")
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "k string, x double").repartition(3)
    out = user_functions.python_aggregate(
        df, ["k"], lambda b: b.groupby("k", as_index=False).agg(s=("x", "sum"), n=("x", "count")), "k string, s double, n bigint",
        {"s": F.sum("s"), "n": F.sum("n")}, {"mean": F.col("s") / F.col("n")})
    assert {r.k: r["mean"] for r in out.collect()} == {"a": 2.0, "b": 5.0}


def test_aggregates_by_name(spark):
    """Called from SQL, from groupBy and in bounded memory: one result, also for a group of several pieces and without a key."""
    spread = user_functions.Aggregate(
        "tw_spread", {"x": "float64"}, "float64", {"low": ("double", "min"), "high": ("double", "max"), "n": ("bigint", "sum")},
        lambda rows: {"low": rows["x"].min(), "high": rows["x"].max(), "n": int(rows["x"].count())}, lambda s: s["high"] - s["low"] + s["n"] / 10)
    spread.register(spark)
    df = spark.range(250_000).selectExpr("IF(id % 3 = 0, 'hot', IF(id % 3 = 1, string(id % 5), NULL)) AS k", "id AS x")
    want = {}
    for i in range(250_000):
        lo, hi, n = want.get(k := "hot" if i % 3 == 0 else str(i % 5) if i % 3 == 1 else None, (i, i, 0))
        want[k] = (min(lo, i), max(hi, i), n + 1)
    want = {k: hi - lo + n / 10 for k, (lo, hi, n) in want.items()}
    df.createOrReplaceTempView("tw_spread_rows")
    assert {r.k: r.s for r in spark.sql("SELECT k, tw_spread(x) AS s FROM tw_spread_rows GROUP BY k").collect()} == want
    assert {r.k: r.s for r in df.groupBy("k").agg(spread("x").alias("s")).collect()} == want
    assert {r.k: r.tw_spread for r in spread.over(df, ["k"], "x").collect()} == want
    plan = spread.over(df, ["k"], "x")._jdf.queryExecution().toString()
    assert "AggregateInPandas" not in plan and "ArrowAggregate" not in plan and "FlatMapGroups" not in plan
    with pytest.raises(ValueError, match="combine"):
        user_functions.Aggregate("f", {}, "int", {"s": ("int", "first")}, dict, len)
    with pytest.raises(Exception, match="takes 1 argument"):
        spark.sql("SELECT tw_spread(x, x) FROM tw_spread_rows GROUP BY k").collect()


def test_aggregate_over_many_groups_takes_few_steps(spark):
    """Groups that lie all over the table: a step sees many rows of one group, and states of several steps still combine."""
    steps = user_functions.Aggregate(
        "tw_steps", {"x": "float64"}, "float64", {"n": ("bigint", "sum"), "steps": ("bigint", "sum")},
        lambda rows: {"n": len(rows), "steps": 1}, lambda s: s["n"] * 1000.0 + s["steps"])
    df = spark.range(0, 60_000, 1, 4).select((F.col("id") % 200).alias("k"), F.col("id").cast("double").alias("x"))
    got = [r.tw_steps for r in steps.over(df.unionAll(df.where("k = 0").limit(20_000)), ["k"], "x").collect()]
    assert sorted(int(g // 1000) for g in got) == [300] * 199 + [600]
    assert sum(g % 1000 for g in got) < 300


def test_numbering_of_small_and_large_groups(spark):
    """Small groups are numbered in place, so that a join on the key needs no further shuffle of the rows; large ones by ranges."""
    df = spark.range(3000).select(F.when(F.col("id") % 10 > 6, "hot").when(F.col("id") % 10 == 6, None).otherwise(
        (F.col("id") % 7).cast("string")).alias("g"), F.xxhash64("id").alias("o"), "id")
    want = {}
    for r in sorted(df.collect(), key=lambda r: r.o):
        want[r.id] = 1 + sum(1 for i, g in ((i, v[0]) for i, v in want.items()) if g == r.g), r.g
        want[r.id] = (r.g, want[r.id][0])
    for large in (50, 600, 10_000):
        assert {r.id: (r.g, r.number) for r in sets.number_in_group(df, ["g"], ["o", "id"], large=large).collect()} == want
    numbered = sets.number_in_group(df, ["g"], ["o", "id"])
    joined = numbered.hint("merge").join(spark.range(9).select(F.col("id").cast("string").alias("g"), F.lit(1).alias("one")), "g", "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Exchange rangepartitioning" not in plan
