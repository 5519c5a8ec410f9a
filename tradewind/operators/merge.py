"""New contents of a table after an incremental change, as frames.

``target`` is the table (or the partitions of it that a change touches), ``source`` the new rows.
Both have the same columns; conditions may name ``target.<column>`` and ``source.<column>``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.dates import time_literal
from tradewind.functions.predicates import equals


def key_list(keys: str | Sequence[str] | None) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


def match(keys: Sequence[str], predicates: Sequence[str] = (), null_safe: bool = False) -> Column:
    """Join condition: all keys equal and all predicates true. A NULL key matches nothing unless
    ``null_safe``."""
    parts = [equals(f"target.{k}", f"source.{k}", null_safe) for k in keys] + [F.expr(p) for p in predicates]
    return reduce(Column.__and__, parts)


def columns_to_update(columns: Sequence[str], update: Sequence[str] | None, exclude: Sequence[str] | None) -> list[str]:
    if update is not None and exclude:
        raise ValueError("give the columns to update or the columns to leave out, not both")
    if update is not None:  # an empty list leaves matched rows as they are
        return [c for c in columns if c in update]
    return [c for c in columns if c not in (exclude or ())]


def merge_rows(target: DataFrame, source: DataFrame, keys: str | Sequence[str] | None, *,
               update: Sequence[str] | None = None, exclude: Sequence[str] | None = None,
               predicates: Sequence[str] = (), null_safe: bool = False) -> DataFrame:
    """Upsert: a target row matched by a source row takes its values, an unmatched source row is
    added. A row that fails the predicates counts as not matched. Without keys all rows are added."""
    keys, columns = key_list(keys), target.columns
    changed = columns_to_update(columns, update, exclude)
    new = source.select(*columns)
    if not keys:
        return target.unionByName(new)
    t, s, on = target.alias("target"), new.alias("source"), match(keys, predicates, null_safe)
    if set(changed) == set(columns):
        # keys are all that the anti-join needs; repeated ones combine before they travel
        by_key = s if predicates else new.select(*keys).distinct().alias("source")
        return t.join(by_key, on, "left_anti").unionByName(new)
    # some columns keep their old value: one full outer join sees matched and unmatched rows of both
    old = spread_missing_keys(target, keys, null_safe).withColumn("_here", F.lit(True)).alias("target")
    add = spread_missing_keys(new, keys, null_safe).withColumn("_here", F.lit(True)).alias("source")
    takes_new = {
        c: F.col("source._here") if c in changed else F.col("source._here") & F.col("target._here").isNull() for c in columns
    }
    return old.join(add, on & (F.col("target._spread") == F.col("source._spread")), "full_outer").select(*[
        F.when(takes_new[c], F.col(f"source.{c}")).otherwise(F.col(f"target.{c}")).alias(c) for c in columns
    ])


def spread_missing_keys(df: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows with a NULL key match nothing, but would all meet in one task of a full outer join. A
    second join column ``_spread``, constant for all other rows, spreads them."""
    if null_safe:
        return df.withColumn("_spread", F.lit(0))
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return df.withColumn("_spread", F.when(missing, F.pmod(F.xxhash64(*df.columns), F.lit(4096))).otherwise(0).cast("int"))


def repeated_keys(source: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return source.groupBy(*key_list(keys)).count().where("count > 1").drop("count")


def ambiguous_keys(target: DataFrame, source: DataFrame, keys: str | Sequence[str], predicates: Sequence[str] = (),
                   null_safe: bool = False) -> DataFrame:
    """Keys that several source rows share and that match a target row: which of them should win is
    not defined, so a merge refuses them."""
    on = match(key_list(keys), predicates, null_safe)
    # predicates may read source columns, so what counts is the source rows that really match
    return repeated_keys(source.alias("source").join(target.alias("target"), on, "left_semi"), keys)


def append_rows(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.unionByName(source.select(*target.columns))


def delete_insert_rows(target: DataFrame, source: DataFrame, keys: str | Sequence[str] | None,
                       predicates: Sequence[str] = ()) -> DataFrame:
    """Drop target rows whose key occurs in the source (and that meet the predicates), then add all
    source rows, repeated keys included."""
    keys, new = key_list(keys), source.select(*target.columns)
    if not keys:
        return target.unionByName(new)
    by_key = new.alias("source") if predicates else new.select(*keys).distinct().alias("source")
    return target.alias("target").join(by_key, match(keys, predicates), "left_anti").unionByName(new)


def overwrite_static_rows(target: DataFrame, source: DataFrame, partition: Column, values: Sequence) -> DataFrame:
    """Replace the listed partitions. Source rows of other partitions are added all the same."""
    listed = F.coalesce(partition.isin(list(values)), F.lit(False))
    return target.where(~listed).unionByName(source.select(*target.columns))


def overwrite_dynamic_rows(target: DataFrame, source: DataFrame, partition: Column) -> DataFrame:
    """Replace every partition that occurs in the source. Rows without a partition replace nothing."""
    new = source.select(*target.columns)
    present = new.select(partition.alias("_partition")).where(F.col("_partition").isNotNull()).distinct()
    kept = target.withColumn("_partition", partition).join(present, "_partition", "left_anti").drop("_partition")
    return kept.select(*target.columns).unionByName(new)


def batch_windows(begin: datetime, end: datetime, size: str) -> list[tuple[datetime, datetime]]:
    """Windows of one hour, day, month or year from the one holding ``begin`` up to ``end``."""
    def start_of(t: datetime) -> datetime:
        cut = {"hour": {}, "day": {"hour": 0}, "month": {"hour": 0, "day": 1}, "year": {"hour": 0, "day": 1, "month": 1}}
        return t.replace(minute=0, second=0, microsecond=0, **cut[size])

    def next_of(t: datetime) -> datetime:
        step = {"hour": timedelta(hours=1), "day": timedelta(days=1), "month": timedelta(days=31), "year": timedelta(days=366)}
        return start_of(t + step[size])

    out, t = [], start_of(begin)
    while t < end:
        out.append((t, next_of(t)))
        t = next_of(t)
    return out


def microbatch_rows(target: DataFrame, source: DataFrame, event_time: str, begin: datetime, end: datetime,
                    size: str = "day") -> DataFrame:
    """Run every batch window from ``begin`` to ``end``: each takes the source rows of its window
    and replaces that window in the target."""
    windows = batch_windows(begin, end, size)
    if not windows:
        return target
    at = F.col(event_time)
    inside = (at >= time_literal(windows[0][0])) & (at < time_literal(windows[-1][1]))
    return target.where(~F.coalesce(inside, F.lit(False))).unionByName(source.where(inside).select(*target.columns))


def newer_rows(source: DataFrame, target: DataFrame, column: str, lookback: timedelta | None = None) -> DataFrame:
    """Source rows above the highest ``column`` of the target: ties and late rows stay out, and an
    empty target lets nothing through. ``lookback`` lowers the mark to take late rows in again."""
    mark = target.agg(F.max(column).alias("mark"))
    if lookback:
        mark = mark.select((F.col("mark") - F.lit(lookback)).alias("mark"))
    return source.where(F.col(column) > mark.scalar())
