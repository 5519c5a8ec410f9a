"""Checks. A check is a frame of failing rows; a verdict is one row that counts them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from tradewind.functions.dates import time_literal
from tradewind.operators.sets import filtered, rows_not_in
from tradewind.sources.tables import Warehouse

# -- failing rows -----------------------------------------------------------------------------------


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL does not count as a value."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records")).where("n_records > 1")
    )


def not_null(df: DataFrame, column: str, whole_rows: bool = False) -> DataFrame:
    out = df.where(F.col(column).isNull())
    return out if whole_rows else out.select(column)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their counts; NULL passes."""
    return (
        df.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))
        .where(~F.col("value_field").isin(list(values)))
    )


def relationships(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-NULL values without a parent row."""
    child = df.where(F.col(column).isNotNull()).select(F.col(column).alias("from_field"))
    known = parent.select(F.col(field).alias("to_field")).distinct()
    return child.join(known, F.col("from_field") == F.col("to_field"), "left_anti")


def between(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows outside the bounds, which belong to the range; NULL passes."""
    return df.where(_outside(column, low, high))


def _outside(column: str, low, high) -> Column:
    c, parts = F.col(column), []
    if low is not None:
        parts.append(c < low)
    if high is not None:
        parts.append(c > high)
    return reduce(Column.__or__, parts) if parts else F.lit(False)


def minimum_at_least(df: DataFrame, column: str, low) -> DataFrame:
    """One row if the smallest value lies below ``low``."""
    return df.agg(F.min(column).alias("minimum")).where(F.col("minimum") < low)


def delivered_without_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    delivered = orders.where(F.col("order_status") == "delivered").select("order_id")
    return rows_not_in(delivered, ["order_id"], items)


def row_count_mismatch(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row with the difference if the frames have different numbers of rows."""
    counts = a.agg(F.count("*").alias("n")).unionByName(b.agg((-F.count("*")).alias("n")))
    return counts.agg(F.sum("n").alias("row_count_diff")).where("row_count_diff <> 0")


def negative_order_values(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("total_payment_value") < 0)


def compare_with_expected(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows of only one side, with repeats, marked ``actual`` or ``expected``. One grouping counts the rows of both sides
    against each other."""
    columns = expected.columns
    both = actual.select(*columns, F.lit(1).alias("_n")).unionAll(expected.select(*columns, F.lit(-1).alias("_n")))
    more = both.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    side = F.when(F.col("_n") > 0, "actual").otherwise("expected").alias("actual_or_expected")
    return more.select(*columns, side, F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_n"))).alias("_n")).drop("_n")


# -- many columns at once ---------------------------------------------------------------------------


def aggregated_not_null(df: DataFrame, columns: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    """NULLs per column, from one pass over the table."""
    names = [c for c in columns if c not in skip]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return verdict_per_column(counts.select(F.explode(_pairs(names)).alias("p")).select("p.column_name", "p.failures"))


def _pairs(names: Sequence[str]) -> Column:
    return F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in names])


def aggregated_unique_rows(df: DataFrame, columns: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    """Repeated values of every column: one pass, one grouping by column and value."""
    names = [c for c in columns if c not in skip]
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("unique_field")) for c in names])
    return (
        df.select(F.explode(cells).alias("cell")).select("cell.*").where("unique_field IS NOT NULL")
        .groupBy("column_name", "unique_field").agg(F.count("*").alias("n_records")).where("n_records > 1")
    )


def aggregated_unique(df: DataFrame, columns: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    """Number of repeated values per column."""
    return verdict_per_column(
        aggregated_unique_rows(df, columns, skip).groupBy("column_name").agg(F.count("*").alias("failures")))


def verdict_per_column(failures: DataFrame) -> DataFrame:
    bad = F.col("failures") > 0
    return failures.where(bad).select("column_name", "failures", bad.alias("should_warn"), bad.alias("should_error"))


# -- verdicts ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    name: str
    failing: DataFrame
    severity: str = "error"
    fail_calc: str = "count(*)"
    warn_if: str = "!= 0"
    error_if: str = "!= 0"
    where: str | None = None
    limit: int | None = None


class CheckFailed(ValueError):
    pass


def verdict(check: Check) -> DataFrame:
    """One row: number of failures, and whether it is a warning or an error."""
    rows = filtered(check.failing, check.where)
    if check.limit is not None:
        rows = rows.limit(check.limit)
    counted = rows.agg(F.expr(check.fail_calc).alias("failures"))
    error = F.expr(f"failures {check.error_if}") if check.severity == "error" else F.lit(False)
    return counted.select(
        F.lit(check.name).alias("test"), F.col("failures").cast("bigint").alias("failures"),
        F.expr(f"failures {check.warn_if}").alias("should_warn"), error.alias("should_error"),
    )


def run_checks(checks: Iterable[Check]) -> DataFrame:
    """All verdicts as one frame, so that one job runs all checks."""
    return reduce(DataFrame.unionByName, [verdict(c) for c in checks])


def require(verdicts: DataFrame) -> list:
    """The verdicts; an error among them is raised."""
    rows = verdicts.collect()
    bad = [(r["test"], r["failures"]) for r in rows if r["should_error"]]
    if bad:
        raise CheckFailed(f"failed checks: {bad}")
    return rows


def store_failures(warehouse: Warehouse, table: str, failing: DataFrame, kind: str = "table") -> None:
    if kind == "table":
        warehouse.write_table(table, failing)
    elif kind == "view":
        warehouse.create_view(table, failing)
    else:
        raise ValueError(f"failures are stored as table or view, not as {kind}")


# -- columns declared with several checks -----------------------------------------------------------


@dataclass(frozen=True)
class ColumnRule:
    """Checks declared for one column."""

    unique: bool = False
    not_null: bool = False
    accepted: tuple = ()
    parent: tuple[str, str] | None = None
    low: float | None = None
    high: float | None = None
    range_severity: str = "error"


def row_measures(table: str, columns: Mapping[str, ColumnRule]) -> dict[str, Column]:
    """What the checks of single rows (NULLs and bounds) count, one aggregate per check: for one pass over the
    table, or for the job that writes it."""
    out = {f"not_null_{table}_{c}": F.count_if(F.col(c).isNull()) for c, rule in columns.items() if rule.not_null}
    return out | {f"between_{table}_{c}": F.count_if(_outside(c, rule.low, rule.high))
                  for c, rule in columns.items() if rule.low is not None or rule.high is not None}


def declared_verdicts(frames: Mapping[str, DataFrame], declared: Mapping[str, Mapping[str, ColumnRule]],
                      observed: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """Verdicts of all declared checks. Those that look at single rows (NULLs and bounds) are counted
    for all columns of a table in one pass, or taken from ``observed`` (table -> what its write measured); the others
    need a grouping or a join each."""
    parts: list[DataFrame] = []
    for table, columns in declared.items():
        df = frames[table]
        for c, rule in columns.items():
            if rule.unique:
                parts.append(verdict(Check(f"unique_{table}_{c}", unique(df, c))))
            if rule.accepted:
                parts.append(verdict(Check(f"accepted_values_{table}_{c}", accepted_values(df, c, rule.accepted))))
            if rule.parent:
                to, field = rule.parent
                parts.append(verdict(Check(f"relationships_{table}_{c}", relationships(df, c, frames[to], field))))
        measures = row_measures(table, columns)
        if measures:
            known = (observed or {}).get(table, {})
            if measures.keys() <= known.keys():
                counts = df.sparkSession.range(1).select(*[F.lit(known[n]).cast("bigint").alias(n) for n in measures])
            else:
                counts = df.agg(*[bad.alias(n) for n, bad in measures.items()])
            warns = {f"between_{table}_{c}" for c, rule in columns.items() if rule.range_severity != "error"}
            cells = F.array(*[
                F.struct(F.lit(n).alias("test"), F.col(n).alias("failures"), F.lit(n not in warns).alias("is_error")) for n in measures
            ])
            parts.append(counts.select(F.explode(cells).alias("c")).select(
                "c.test", "c.failures", (F.col("c.failures") > 0).alias("should_warn"),
                ((F.col("c.failures") > 0) & F.col("c.is_error")).alias("should_error")))
    return reduce(DataFrame.unionByName, parts)


# -- layers -----------------------------------------------------------------------------------------


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table; names are ``layer.table``, and tables of the working layer stay out."""
    def one(name: str, df: DataFrame) -> DataFrame:
        layer, _, table = name.rpartition(".")
        return df.agg(F.count("*").alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count")

    return reduce(DataFrame.unionByName, [one(n, d) for n, d in frames.items() if not n.rpartition(".")[2].startswith("_")])


def empty_tables(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Names of the frames without a row, in one job that takes at most one row of each."""
    def one(name: str, df: DataFrame) -> DataFrame:
        found = df.select(F.lit(1)).limit(1).agg(F.count("*").alias("n"))
        return found.where("n = 0").select(F.lit(name).alias("table_name"))

    return reduce(DataFrame.unionByName, [one(n, d) for n, d in frames.items()])


def require_rows(frames: Mapping[str, DataFrame], observed: Mapping[str, int] | None = None) -> None:
    """No table may be empty. ``observed``: rows that the writes of some tables counted, which are not looked at again."""
    known = observed or {}
    empty = [n for n in frames if known.get(n) == 0]
    rest = {n: df for n, df in frames.items() if n not in known}
    if rest:
        empty += [r["table_name"] for r in empty_tables(rest).collect()]
    if empty:
        raise CheckFailed(f"empty tables: {empty}")


def inconsistent_orders(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Cleaning keeps every order, and the fact has no more orders than there are: one row per rule that is broken, with the
    counts that show it."""
    counts = row_counts({"all.bronze": bronze, "all.silver": silver, "all.gold": gold}).groupBy().agg(
        *[F.max(F.when(F.col("table_name") == t, F.col("row_count"))).alias(t) for t in ("bronze", "silver", "gold")])
    rules = F.array(
        F.when(F.col("bronze") != F.col("silver"), F.struct(F.lit("bronze and silver").alias("rule"), F.col("bronze").alias("expected"), F.col("silver").alias("found"))),
        F.when(F.col("gold") > F.col("silver"), F.struct(F.lit("gold at most silver").alias("rule"), F.col("silver").alias("expected"), F.col("gold").alias("found"))))
    return counts.select(F.inline(F.filter(rules, lambda r: r.isNotNull())))


def require_consistent_orders(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> None:
    broken = [r.asDict() for r in inconsistent_orders(bronze, silver, gold).collect()]
    if broken:
        raise CheckFailed(f"numbers of orders differ: {broken}")


def freshness(df: DataFrame, loaded_at: str, now: datetime, warn_after: timedelta | None = None,
              error_after: timedelta | None = None, where: str | None = None) -> DataFrame:
    """Newest load time, its age in seconds, and whether that is too old. A table without any load
    time is too old."""
    newest = filtered(df, where).agg(F.max(F.col(loaded_at).cast("timestamp")).alias("max_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), time_literal(now))
    too_old = lambda limit: F.lit(False) if limit is None else age.isNull() | (age > F.lit(int(limit.total_seconds())))
    return newest.select(
        "max_loaded_at", time_literal(now).alias("snapshotted_at"), age.alias("age_seconds"),
        F.when(too_old(error_after), "error").when(too_old(warn_after), "warn").otherwise("pass").alias("status"),
    )


# -- contracts --------------------------------------------------------------------------------------


def contract_violations(actual: StructType, declared: StructType) -> list[str]:
    """Differences in number, names and types of columns; their order is free."""
    a, d = {f.name: f.dataType for f in actual}, {f.name: f.dataType for f in declared}
    out = [f"missing column {c}" for c in d if c not in a] + [f"undeclared column {c}" for c in a if c not in d]
    return out + [f"{c} is {a[c].simpleString()}, declared {d[c].simpleString()}" for c in d if c in a and a[c] != d[c]]


def require_contract(df: DataFrame, declared: StructType) -> DataFrame:
    """The frame in the declared column order; a difference is raised."""
    bad = contract_violations(df.schema, declared)
    if bad:
        raise CheckFailed("contract broken: " + "; ".join(bad))
    return df.select(*declared.names)
