"""Mixing sources to target weights by entropy balancing.

Each document gets a rate q = min(cap, exp(lambda * size)), lambda per source: of all rates with the source's
target number of words, the ones nearest to taking each document once (in relative entropy). Newton iterations
solve the convex dual, sums of each step being one grouping of the (source, size) counts; documents themselves
are read once. Rates become whole copies by cumulative rounding in order of size, which misses a target by about
one document at most, and a few single copies more or less bring the source nearer. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.staging import free_name, written
from tradewind.llm.words import n_words

SOURCE = ["s", "no_s"]  # a source and whether it is null, so that null joins like any other
STEPS_PER_JOB, MAX_JOBS, REPAIRS = 5, 30, 3


def targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """s, no_s, source_size, target of each source. ``sizes``: s, no_s, size, n.

    Weights go round the sources by code point, null last. Targets are the level at which min(weight * level,
    cap * size) adds up to all words: sources are sorted by cap * size / weight and capped while that lies below
    the level of the rest. The windows are over one row per source.
    """
    per = sizes.groupBy(*SOURCE).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.max("size").alias("largest"))
    rank = F.row_number().over(Window.orderBy("no_s", "s")) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.get(cycle, F.pmod(rank, F.lit(len(weights))).cast("int"))) \
             .withColumn("most", cap * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("most") / F.col("weight"), "no_s", "s")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    per = per.withColumns({
        "place": F.row_number().over(order),
        "rest": F.sum(F.col("source_size")).over(everything).cast("double") - F.coalesce(F.sum("most").over(before), F.lit(0.0)),
        "heavy": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    per = per.withColumn("level", F.col("rest") / F.col("heavy"))
    below = F.col("weight") * F.col("level") < F.col("most")
    free = F.min(F.when(below, F.struct("place", "level"))).over(everything)
    target = F.when(free.isNull() | (F.col("place") < free["place"]), F.col("most")).otherwise(F.col("weight") * free["level"])
    return per.select(*SOURCE, "source_size", "largest", target.alias("target"))


def _rate(cap: float) -> Column:
    tilted = F.exp(F.least(F.col("tilt") * F.col("size") / F.greatest("largest", F.lit(1)), F.lit(700.0)))
    return F.when(F.col("full"), F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), tilted))


def solve(sizes: DataFrame, wanted: DataFrame, cap: float, tolerance: float = 1e-9) -> DataFrame:
    """``wanted`` with the tilt of each source. A source that needs all of its cap is ``full`` and not tilted.

    Newton steps, kept between the tilts known to be too low and too high; the bracket is halved where a step
    would leave it.
    """
    none = F.lit(None).cast("double")
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    state = written(wanted.withColumns({"full": full, "tilt": F.lit(0.0), "low": none, "high": none, "error": F.lit(1.0)}))
    names = [c for c in state.columns if c not in SOURCE]
    q, z = _rate(cap), F.col("size") / F.greatest("largest", F.lit(1))
    for _ in range(MAX_JOBS):
        for _ in range(STEPS_PER_JOB):
            words = F.col("n") * F.col("size") * q
            sums = sizes.join(state, SOURCE).groupBy(*SOURCE, *names).agg(
                F.sum(words).alias("taken"), F.sum(F.when(q < cap, words * z).otherwise(0.0)).alias("slope"))
            over = F.col("taken") - F.col("target")
            sums = sums.withColumns({
                "low": F.when(over <= 0, F.col("tilt")).otherwise(F.col("low")),
                "high": F.when(over >= 0, F.col("tilt")).otherwise(F.col("high")),
                "error": F.when(F.col("full") | (F.abs(over) <= tolerance * F.col("target")), 0.0).otherwise(F.abs(over)),
                "newton": F.when(F.col("slope") > 0, F.col("tilt") - over / F.col("slope"))})
            inside = (F.col("newton") > F.coalesce("low", F.lit(float("-inf")))) & (F.col("newton") < F.coalesce("high", F.lit(float("inf"))))
            wider = F.when(F.col("low").isNull(), F.col("high") * 2 - 1).when(F.col("high").isNull(), F.col("low") * 2 + 1) \
                .otherwise((F.col("low") + F.col("high")) / 2)
            step = F.when(F.col("error") == 0, F.col("tilt")).when(inside, F.col("newton")).otherwise(wider)
            state = sums.withColumn("tilt", step).select(*SOURCE, *names)
        state = written(state)
        if not state.agg(F.max("error")).first()[0]:
            break
    return state


def _nearer(rated: DataFrame, cap: float) -> DataFrame:
    """One copy more or less of one document per source, the one whose size is nearest to what the source is off."""
    source = Window.partitionBy(*SOURCE)
    off = F.sum(F.col("size") * F.col("all")).over(source) - F.col("target")
    rated = rated.withColumn("off", off)
    gap = F.abs(F.abs("off") - F.col("size"))
    room = F.when(F.col("off") < 0, F.col("all") < cap * F.col("n")).otherwise(F.col("all") > 0)
    rated = rated.withColumn("best", F.min(F.when(room & (gap < F.abs("off")), F.struct(gap.alias("gap"), "size"))).over(source))
    step = F.when(F.col("size") == F.col("best.size"), F.when(F.col("off") < 0, 1).otherwise(-1)).otherwise(0)
    return rated.withColumn("all", F.col("all") + step).drop("off", "best")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (5, 2, 1), cap: int = 3, seed: int = 5) -> DataFrame:
    """One row per row of ``docs``: id, mark (hash of the text), size, source_size, target, copies, taken.

    ``size`` is the number of words (null text: 0), ``copies`` how often the mix takes the document (at most
    ``cap``) and ``taken`` their product. Documents of equal source and size share a rate; a hash of id and text says which of
    them get one copy more, so reruns agree. A null source is a source, last in order; repeated rows count as
    often as they occur; an empty document takes nothing; other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("k"), F.xxhash64(F.col(text_col)).alias("m"), F.col(source_col).cast("string").alias("src"),
                       n_words(F.col(text_col)).alias("size"))
    rows = written(rows.select("k", "m", F.coalesce("src", F.lit("")).alias("s"), F.col("src").isNull().alias("no_s"), "size",
                               F.xxhash64("k", "m", F.lit(seed)).alias("h")))
    group = [*SOURCE, "size"]
    sizes = written(rows.groupBy(*group).agg(F.count("*").alias("n")))
    state = solve(sizes, targets(sizes, weights, cap), cap)
    upto = Window.partitionBy(*SOURCE).orderBy("size")
    rated = sizes.join(state, SOURCE).withColumn("sum", F.sum(F.col("n") * _rate(cap)).over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    whole = F.floor(F.col("sum") + 0.5)
    rated = rated.withColumn("all", F.greatest(F.lit(0), F.least(whole - F.coalesce(F.lag(whole).over(upto), F.lit(0)), cap * F.col("n"))))
    for _ in range(REPAIRS):
        rated = _nearer(rated, cap)
    rated = rated.select(*group, "source_size", "target", F.floor(F.col("all") / F.col("n")).alias("base"), F.pmod("all", "n").alias("extra"))
    # documents of one source and size are ranked in buckets of some thousands, so a group of any size is spread
    n_rows = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = rows.withColumn("b", F.pmod("h", F.lit(-(-max(n_rows, 1) // 4096))))
    bucket = [*group, "b"]
    buckets = rows.groupBy(*bucket).agg(F.count("*").alias("n_b"))
    before = F.coalesce(F.sum("n_b").over(Window.partitionBy(*group).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    buckets = buckets.withColumn("before", before).join(rated, group) \
        .withColumn("extra_b", F.greatest(F.lit(0), F.least("n_b", F.col("extra") - F.col("before"))))
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy(*bucket).orderBy("h", "k", "m")))
    copies = (F.col("base") + F.when(F.col("place") <= F.col("extra_b"), 1).otherwise(0)).cast("long")
    return ranked.join(buckets.select(*bucket, "source_size", "target", "base", "extra_b"), bucket).select(
        F.col("k").alias(id_col), F.col("m").alias("mark"), "size", "source_size", "target",
        F.when(F.col("size") > 0, copies).otherwise(F.lit(1)).alias("copies"),
        F.when(F.col("size") > 0, F.col("size") * copies).otherwise(F.lit(0)).cast("long").alias("taken"))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix`` takes it (documents without a word once).

    Rows with equal id and text are alike, so they share their copies evenly.
    """
    key, mark, own_mark, n, total = (free_name(docs, f"_{c}") for c in ("key", "mark", "own", "n", "total"))
    copies = mix(docs, id_col, text_col, source_col, **how).groupBy(F.col(id_col).alias(key), F.col("mark").alias(mark)) \
        .agg(F.count("*").alias(n), F.sum("copies").alias(total))
    own = docs.withColumn(own_mark, F.xxhash64(F.col(text_col)))
    joined = own.join(copies, own[id_col].eqNullSafe(copies[key]) & (own[own_mark] == copies[mark]))
    more = F.pmod(F.monotonically_increasing_id(), F.col(n)) < F.pmod(total, n)
    each = F.floor(F.col(total) / F.col(n)) + more.cast("long")
    return joined.withColumn(n, each).filter(F.col(n) > 0).withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))) \
        .select(*[docs[c] for c in docs.columns])
