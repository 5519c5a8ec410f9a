"""Incremental changes of stored tables.

Parquet tables know no row updates, so a keyed change rewrites partitions: only those that hold a
matched row or receive a new one. The new rows are written once to the shared folder first, because
they are read several times (uniqueness, touched partitions, merge). In a table partitioned by its key
(:class:`KeyPartition`) the new rows alone say which partitions these are; elsewhere the keys of the table are read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.casts import spark_type
from tradewind.functions.dates import time_literal
from tradewind.operators import merge
from tradewind.operators.schema_drift import (
    add_columns, change_column_type as cast_column, drop_columns, fit, policy_of, reconcile, schema_diff,
)
from tradewind.session import shuffles_freed, staged
from tradewind.sources.tables import KeyPartition, Partition, TimePartition, Warehouse, is_in, value_text


class AmbiguousMerge(ValueError):
    """Several source rows match the same target row."""


STRATEGIES = ("merge", "append", "delete_insert", "insert_overwrite", "microbatch")


@dataclass(frozen=True)
class Incremental:
    """How a table is kept up to date."""

    strategy: str = "merge"
    keys: tuple[str, ...] = ()
    partition: Partition | None = None
    cluster: tuple[str, ...] = ()
    # None: all columns; an empty tuple: none, so that a merge only adds rows
    update: tuple[str, ...] | None = None
    exclude: tuple[str, ...] = ()
    predicates: tuple[str, ...] = ()
    null_safe: bool = False
    # partitions to replace; empty: those of the new rows
    partitions: tuple = field(default=())
    # replace partitions file by file; the outcome is the same
    copy_partitions: bool = False
    on_schema_change: str = "ignore"
    # False: the new rows are read from files as they are, so a merge need not write them once more before it reads them several times
    stage: bool = True

    def __post_init__(self) -> None:
        if self.strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}: {self.strategy}")
        if self.strategy in ("insert_overwrite", "microbatch") and self.partition is None:
            raise ValueError(f"strategy {self.strategy} needs a partition")
        if self.copy_partitions and self.strategy not in ("insert_overwrite", "microbatch"):
            raise ValueError("copy_partitions goes with insert_overwrite and microbatch only")


def build(warehouse: Warehouse, table: str, rows: Callable[[bool], DataFrame], how: Incremental,
          full_refresh: bool = False, measures: Mapping[str, Column] | None = None, observed: dict | None = None) -> str:
    """Create the table, rebuild it, or change it, and say which. A rebuild puts the number of rows and ``measures`` of the
    whole table into ``observed``.

    ``rows`` gives the new rows; its argument tells whether this is a change of an existing table,
    as :func:`is_incremental` does.
    """
    if is_incremental(warehouse, table, full_refresh):
        apply(warehouse, table, rows(True), how)
        return how.strategy
    seen = warehouse.write_table(table, rows(False), how.partition, how.cluster, measures)
    if observed is not None:
        observed.update(seen)
    return "rebuild"


def is_incremental(warehouse: Warehouse, table: str, full_refresh: bool = False) -> bool:
    """The table exists, is not a view, and no full refresh is asked for."""
    return not full_refresh and warehouse.exists(table) and not warehouse.is_view(table)


def rows_of(warehouse: Warehouse, table: str, part: Partition | None) -> DataFrame:
    """Stored rows in the columns of the source: a field that only lives on as partition comes back."""
    return warehouse.rows(table, part)


def apply(warehouse: Warehouse, table: str, source: DataFrame, how: Incremental) -> None:
    source, missing = change_schema(warehouse, table, source, how)
    if missing and how.strategy == "merge":
        # columns that the new rows lack keep their value on a match
        how = replace(how, update=tuple(c for c in how.update if c not in missing)) if how.update is not None else \
            replace(how, exclude=(*how.exclude, *missing))
    if how.strategy == "append" or (how.strategy in ("merge", "delete_insert") and not how.keys):
        warehouse.append(table, source, how.partition, how.cluster)
    elif how.strategy == "merge":
        upsert(warehouse, table, source, how)
    elif how.strategy == "delete_insert":
        delete_insert(warehouse, table, source, how)
    else:
        insert_overwrite(warehouse, table, source, how)


# -- keyed changes ----------------------------------------------------------------------------------


def upsert(warehouse: Warehouse, table: str, source: DataFrame, how: Incremental) -> None:
    with staged(source) if how.stage else nullcontext(source) as source:
        with shuffles_freed(warehouse.spark):
            repeated = not merge.repeated_keys(source, how.keys).isEmpty()
        if repeated:
            stored = rows_of(warehouse, table, how.partition)
            bad = merge.ambiguous_keys(stored, source, how.keys, how.predicates, how.null_safe).take(3)
            if bad:
                raise AmbiguousMerge(f"several new rows for one row of {table}, for example {[r.asDict() for r in bad]}")
        columns = [f.name for f in source.schema]
        whole = set(merge.columns_to_update(columns, how.update, how.exclude)) == set(columns)
        _rewrite(warehouse, table, source, how, lambda old: merge.merge_rows(
            old, source, how.keys, update=how.update, exclude=how.exclude, predicates=how.predicates, null_safe=how.null_safe), whole)


def delete_insert(warehouse: Warehouse, table: str, source: DataFrame, how: Incremental) -> None:
    with staged(source) as source:
        _rewrite(warehouse, table, source, how,
                 lambda old: merge.delete_insert_rows(old, source, how.keys, how.predicates), True)


def _rewrite(warehouse: Warehouse, table: str, source: DataFrame, how: Incremental,
             change: Callable[[DataFrame], DataFrame], replaced: bool) -> None:
    """``replaced``: nothing of a matched row is kept, so a partition all of whose rows are matched is not read again."""
    part = how.partition
    if part is None:
        warehouse.write_table(table, change(warehouse.read(table)), None, how.cluster)
        return
    stored = warehouse.read(table, technical=True)
    value = part.column
    known = isinstance(part, KeyPartition) and set(part.keys) <= set(how.keys)
    if known:
        leaving, gone = set(), set()  # a stored row lies where the new row of its key goes
    else:
        # partitions that hold a matched row: only keys, predicate columns and the partition are read
        matched = stored.alias("target").join(
            source.alias("source"), merge.match(how.keys, how.predicates, how.null_safe), "left_semi")
        with shuffles_freed(warehouse.spark):
            found = {r[0]: r[1] for r in matched.groupBy(value).count().collect()}
            # rows of a partition are counted from the footers of its files
            held = {r[0]: r[1] for r in stored.groupBy(value).count().collect()} if replaced else {}
        leaving, gone = set(found), {v for v, n in found.items() if n == held.get(v)}
    with shuffles_freed(warehouse.spark):
        arriving = {r[0] for r in source.select(part.value().alias(value)).distinct().collect()}
    touched = (leaving | arriving) - gone
    if replaced and not known:
        touched &= set(held)  # a partition that is only now made has no old rows
    old = stored.where(is_in(value, list(touched)))
    if part.drop_field:
        old = old.withColumn(part.field, part.time())
    new = change(old.drop(value) if value != part.field else old)
    filled = warehouse.replace_partitions(table, new, part, how.cluster)
    # a partition all of whose rows moved elsewhere does not occur in the new rows
    warehouse.drop_partitions(table, [v for v in leaving if value_text(v) not in filled])


# -- partition replacement --------------------------------------------------------------------------


def insert_overwrite(warehouse: Warehouse, table: str, source: DataFrame, how: Incremental) -> None:
    """Replace whole partitions without reading them: the listed ones, or those of the new rows."""
    part, listed = how.partition, how.partitions
    # rows of other partitions, or of none, are added; they replace nothing
    replaces = F.coalesce(part.value().isin(list(listed)), F.lit(False)) if listed else part.value().isNotNull()
    with staged(source.withColumn("_replaces", replaces)) as rows:
        inside = rows.where("_replaces").drop("_replaces")
        outside = rows.where(~F.col("_replaces")).drop("_replaces")
        filled = warehouse.replace_partitions(table, inside, part, how.cluster)
        warehouse.drop_partitions(table, [v for v in listed if value_text(v) not in filled])
        if not outside.isEmpty():
            warehouse.append(table, outside, part, how.cluster)


class WindowsFailed(RuntimeError):
    """Some windows of a microbatch run failed; the others are done."""


def microbatch(warehouse: Warehouse, table: str, rows: Callable[[datetime, datetime], DataFrame], how: Incremental,
               begin: datetime, end: datetime, one_pass: bool = False, ledger: str | None = None, at_once: int = 1) -> int:
    """Run the query once per batch window and replace that window's partition. Gives the number of windows run. Windows are
    independent: ``at_once`` of them run side by side, and one that fails leaves the others alone.

    ``ledger`` names a table that keeps the windows (``begin_at``, ``end_at``, ``state``: done or failed, ``message``). Windows that it has as
    done are not run again, so a second call runs those that failed. Without a ledger every window runs; either way
    failures are raised when all others are through.

    With ``one_pass`` the query runs once over all windows, which reads the source once. It is for queries that never
    combine rows of different windows; the outcome is then the same.
    """
    part = how.partition
    if not isinstance(part, TimePartition):
        raise ValueError("microbatch needs a time partition, whose granularity is the batch size")
    windows = merge.batch_windows(begin, end, part.granularity)
    if ledger:
        done = finished_windows(warehouse, ledger)
        windows = [w for w in windows if w not in done]
    if not windows:
        return 0
    value = lambda lo: lo.strftime("%Y-%m-%d-%H") if part.granularity == "hour" else lo.date()
    # one pass goes over windows side by side; a gap begins another
    runs: list[list[tuple[datetime, datetime]]] = []
    for window in windows:
        if one_pass and runs and runs[-1][-1][1] == window[0]:
            runs[-1].append(window)
        else:
            runs.append([window])

    def run(own: list[tuple[datetime, datetime]]) -> Exception | None:
        lo, hi, at = own[0][0], own[-1][1], F.col(part.field)
        try:
            batch = rows(lo, hi).where((at >= time_literal(lo)) & (at < time_literal(hi)))
            if not warehouse.exists(table):
                warehouse.write_table(table, batch, part, how.cluster)
                return None
            with staged(batch) as batch:
                batch, _ = change_schema(warehouse, table, batch, how)
                filled = warehouse.replace_partitions(table, batch, part, how.cluster)
                warehouse.drop_partitions(table, [value(w[0]) for w in own if value_text(value(w[0])) not in filled])
        except Exception as failure:
            return failure
        return None

    failures: list[tuple[list[tuple[datetime, datetime]], Exception]] = []

    def keep(own: list[tuple[datetime, datetime]], failure: Exception | None) -> None:
        if failure:
            failures.append((own, failure))
        if ledger:
            _record(warehouse, ledger, [(lo, hi, "failed" if failure else "done", str(failure)[:500] if failure else None) for lo, hi in own])

    # the run that makes the table, or may change its columns, goes first
    first = 1 if not warehouse.exists(table) or how.on_schema_change != "ignore" or at_once < 2 else 0
    alone, together = (runs, []) if at_once < 2 else (runs[:first], runs[first:])
    for own in alone:
        keep(own, run(own))
    with ThreadPoolExecutor(max_workers=max(at_once, 1)) as pool:
        for own, future in [(own, pool.submit(run, own)) for own in together]:
            keep(own, future.result())
    if failures:
        named = [f"{own[0][0]} to {own[-1][1]}: {failure}" for own, failure in failures]
        raise WindowsFailed(f"{len(failures)} of {len(runs)} runs of {table} failed: {named}") from failures[0][1]
    return len(windows)


LEDGER = "begin_at timestamp, end_at timestamp, state string, message string, recorded_at timestamp"


def _record(warehouse: Warehouse, ledger: str, windows: Sequence[tuple]) -> None:
    rows = warehouse.spark.createDataFrame([(*w, datetime.now()) for w in windows], LEDGER).coalesce(1)
    if warehouse.exists(ledger):
        warehouse.append(ledger, rows)
    else:
        warehouse.write_table(ledger, rows)


def finished_windows(warehouse: Warehouse, ledger: str) -> set[tuple[datetime, datetime]]:
    """Windows whose last record is done: at most as many as there are windows."""
    if not warehouse.exists(ledger):
        return set()
    last = warehouse.read(ledger).groupBy("begin_at", "end_at").agg(F.max_by("state", "recorded_at").alias("state")).where("state = 'done'")
    text = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("begin_at", "end_at")]
    return {tuple(datetime.strptime(v, "%Y-%m-%d %H:%M:%S") for v in r) for r in last.select(*text).collect()}


# -- high-water mark --------------------------------------------------------------------------------


def _newest_rows(warehouse: Warehouse, table: str, column: str, partition: Partition | None) -> DataFrame:
    """The rows that hold the largest ``column``. Where the table is partitioned by the time of that
    column these are in its newest partition."""
    df = warehouse.read(table, technical=True)
    if isinstance(partition, TimePartition) and partition.field == column and not partition.drop_field:
        values = [v for v in warehouse.partition_values(table) if v is not None]
        df = df.where(F.col(partition.column) == F.lit(max(values))) if values else df.where(F.lit(False))
    return df


def highest(warehouse: Warehouse, table: str, column: str, partition: Partition | None = None):
    return _newest_rows(warehouse, table, column, partition).agg(F.max(column)).first()[0]


def newer_than_table(warehouse: Warehouse, table: str, source: DataFrame, column: str,
                     partition: Partition | None = None, lookback: timedelta | None = None) -> DataFrame:
    """Source rows above the table's highest ``column``; the mark is a literal, so that the filter
    reaches the scan of the source."""
    top = _newest_rows(warehouse, table, column, partition).agg(F.max(column).alias("mark"))
    # as text, which no time zone of the driver can shift
    text = top.select(F.col("mark").cast("string")).first()[0]
    if text is None:
        return source.where(F.lit(False))
    mark = F.lit(text).cast(top.schema["mark"].dataType)
    return source.where(F.col(column) > (mark - F.lit(lookback) if lookback else mark))


def max_partition(warehouse: Warehouse, table: str):
    """Largest partition value, from the catalog; NULL partitions do not count."""
    return max((v for v in warehouse.partition_values(table) if v is not None), default=None)


# -- schema -----------------------------------------------------------------------------------------


def change_schema(warehouse: Warehouse, table: str, source: DataFrame, how: Incremental) -> tuple[DataFrame, list[str]]:
    """Bring the table's columns in line as the policy says. Gives the source in the table's columns,
    and the columns it had to fill with NULL."""
    policy, stored = policy_of(how.on_schema_change), rows_of(warehouse, table, how.partition)
    diff = schema_diff(source.schema, stored.schema)
    if not diff or policy in ("ignore", "fail"):
        return reconcile(stored, source, policy)[1], []
    if policy == "append_new_columns" or not (diff.removed or diff.retyped):
        if diff.added:
            warehouse.add_columns(table, {c: t.simpleString() for c, t in diff.added.items()})
        table_schema = rows_of(warehouse, table, how.partition).schema
        return fit(add_columns(source, diff.removed), table_schema), list(diff.removed)
    # dropping or retyping a column rewrites the files
    target, source = reconcile(stored, source, policy)
    warehouse.write_table(table, target, how.partition, how.cluster)
    return fit(source, rows_of(warehouse, table, how.partition).schema), []


def _kept_layout(warehouse: Warehouse, table: str, how: Incremental | None) -> tuple[Partition | None, tuple[str, ...]]:
    """The layout a table was written with; one that ``how`` states must be the same."""
    partition, cluster = warehouse.layout(table)
    if how and how.partition and how.partition != partition:
        raise ValueError(f"{table} is stored by {partition}, not by {how.partition}")
    return partition, how.cluster if how and how.cluster else cluster


def change_column_type(warehouse: Warehouse, table: str, column: str, kind: str, how: Incremental | None = None) -> None:
    """Rewrites a table with one column in another type, in the layout it has."""
    partition, cluster = _kept_layout(warehouse, table, how)
    warehouse.write_table(table, cast_column(warehouse.rows(table, partition), column, kind), partition, cluster)


def alter_columns(warehouse: Warehouse, table: str, add: Mapping[str, str] | None = None, drop: Sequence[str] = (),
                  how: Incremental | None = None) -> None:
    """Add columns (NULL in the rows there are), drop columns. Adding only changes the catalog; dropping rewrites
    the files in the layout the table has."""
    if add:
        warehouse.add_columns(table, {c: spark_type(t) for c, t in add.items()})
    if drop:
        partition, cluster = _kept_layout(warehouse, table, how)
        warehouse.write_table(table, drop_columns(warehouse.rows(table, partition), drop), partition, cluster)
