"""Streams into stored tables.

All sinks work per micro-batch and are safe to repeat: a micro-batch that is delivered again after a
failure leaves the table as the first delivery did. The stream's checkpoint takes the place of a
high-water mark, so late rows are not lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewind.functions.dates import time_literal
from tradewind.operators import incremental as inc, merge
from tradewind.operators.incremental import Incremental
from tradewind.session import staged
from tradewind.sources.tables import LASTING, TimePartition, Warehouse, value_text


def _start(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, once: bool, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(work).outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


# -- latest version of every key ----------------------------------------------------------------------


def latest_versions(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], null_safe: bool = False) -> DataFrame:
    """One row per key: the one with the greatest ``order_by`` (NULL is smallest), and of equal ones the one with the greatest
    hash of all columns, so that a repeat chooses alike. Versions combine before the shuffle, so a key with a third of the rows travels
    once per task. Rows without a key match nothing and all stay, unless ``null_safe``."""
    others = [c for c in rows.columns if c not in keys]
    whole = lambda df: df.groupBy(*keys).agg(
        F.max_by(F.struct(*others), F.struct(*order_by, F.xxhash64(*rows.columns))).alias("_row")).select(*keys, "_row.*").select(*rows.columns)
    if null_safe:
        return whole(rows)
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return whole(rows.where(~missing)).unionByName(rows.where(missing))


def without_late(rows: DataFrame, stored: DataFrame, keys: Sequence[str], order_by: Sequence[str], null_safe: bool = False) -> DataFrame:
    """``rows`` but for those that are older than the stored row of their key. Only keys and order columns of the
    stored rows are read."""
    seen = stored.select(*keys, F.struct(*order_by).alias("_seen")).alias("target")
    new = rows.select(*keys, F.struct(*order_by).alias("_order")).alias("source")
    older = new.join(seen, merge.match(keys, (), null_safe) & (F.col("source._order") < F.col("target._seen")), "left_semi").select(*keys)
    return rows.alias("source").join(older.alias("target"), merge.match(keys, (), null_safe), "left_anti")


def upsert_stream(stream: DataFrame, warehouse: Warehouse, table: str, how: Incremental, checkpoint: str,
                  once: bool = False, order_by: Sequence[str] = ()) -> StreamingQuery:
    """Merge the latest version of every key into the table; the first batch makes the table.

    ``order_by`` orders versions of one key (default: the time that the table is partitioned by). Of several versions in one batch
    the latest is taken; one that is older than the stored row is refused, and one that is equally old takes its place.
    The number of the last batch is kept with the table, so that a batch delivered again does nothing, not even with rows
    without a key, which are added each time.
    """
    order = tuple(order_by) or ((how.partition.field,) if isinstance(how.partition, TimePartition) else ())
    if not order:
        raise ValueError("versions of one key need columns that order them")
    mark = f"{LASTING}batch.{hashlib.md5(checkpoint.encode()).hexdigest()}"

    def work(batch: DataFrame, number: int) -> None:
        if number <= int(warehouse.properties(table).get(mark, -1)):
            return
        # read back in the table's session, where adaptive execution is on
        with staged(batch, warehouse.spark) as rows:
            if rows.isEmpty():
                return
            latest = latest_versions(rows, how.keys, order, how.null_safe)

            def new(change: bool) -> DataFrame:
                stored = warehouse.rows(table, how.partition) if change else None
                return without_late(latest, stored, how.keys, order, how.null_safe) if change else latest

            inc.build(warehouse, table, new, how)
        warehouse.set_properties(table, {mark: str(number)})

    return _start(stream, work, checkpoint, once)


# -- batches of event time ----------------------------------------------------------------------------


def within(part: TimePartition, values: Sequence[date | datetime | str | None]) -> Callable[[str], Column]:
    """A condition on a bare time column: it lies in one of the time batches ``values``. Batches side by side become one
    half-open range, so that a few ranges reach the scan, whatever the column is a part of."""
    def start_of(value) -> datetime:
        return datetime.strptime(value, "%Y-%m-%d-%H") if isinstance(value, str) else datetime(value.year, value.month, value.day)

    ranges: list[tuple[datetime, datetime]] = []
    for lo in sorted(start_of(v) for v in values if v is not None):
        (_, hi), = merge.batch_windows(lo, lo.replace(microsecond=1), part.granularity)
        if ranges and ranges[-1][1] == lo:
            ranges[-1] = (ranges[-1][0], hi)
        else:
            ranges.append((lo, hi))

    def condition(column: str) -> Column:
        at = F.col(column)
        parts = [(at >= time_literal(lo)) & (at < time_literal(hi)) for lo, hi in ranges]
        return reduce(Column.__or__, [*parts, *([at.isNull()] if None in values else [])], F.lit(False))

    return condition


def replace_batches_stream(stream: DataFrame, warehouse: Warehouse, table: str, rows: Callable[[Callable[[str], Column]], DataFrame],
                           how: Incremental, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Recompute the time batches that new events fall into and replace their partitions.

    ``stream`` tells which batches are touched, by its ``how.partition.field``. ``rows(touched)`` is the batch query; it
    filters its source by ``touched(column)``, which says that a time column lies in a touched batch. A late event makes its
    batch run again, and one that leaves a batch empty removes it. Rows without a time are one batch of their own. For queries
    that are sums of events :func:`totals_stream` needs no second reading.
    """
    part = how.partition
    if not isinstance(part, TimePartition):
        raise ValueError("replacing batches needs a time partition")

    def work(batch: DataFrame, number: int) -> None:
        touched = [r[0] for r in batch.select(part.value().alias("value")).distinct().collect()]
        if not touched:
            return
        new = rows(within(part, touched))
        if not warehouse.exists(table):
            warehouse.write_table(table, new, part, how.cluster)
            return
        with staged(new) as new:
            new, _ = inc.change_schema(warehouse, table, new, how)
            filled = warehouse.replace_partitions(table, new, part, how.cluster)
            warehouse.drop_partitions(table, [v for v in touched if value_text(v) not in filled])

    return _start(stream, work, checkpoint, once)


def running_totals(stream: DataFrame, part: TimePartition, totals: Mapping[str, str], distinct: Mapping[str, Sequence[str]] | None = None,
                   name: str = "batch", watermark: str | None = None) -> DataFrame:
    """Totals per time batch of ``part.field``, kept as stream state: what is emitted are the batches that new rows fall
    into, with their totals over all rows so far. No row is read twice by the stream.

    ``totals``: column -> SQL aggregate of the rows, such as ``count(*)`` or ``sum(value)``. ``distinct``: column -> columns whose
    different values are counted exactly; each value is a state of its own, so a batch with a third of the rows is spread. Rows without
    a time are a batch of their own. Without ``watermark`` state is kept for ever (one per batch and distinct value), and
    every late row counts; with it (hours and days only) state that is older goes, and so do rows later than that or without a time.
    """
    if watermark:
        if part.granularity not in ("hour", "day"):
            raise ValueError("a watermark needs batches of an hour or a day")
        rows = stream.withWatermark(part.field, watermark)
        key, start = F.window(part.field, f"1 {part.granularity}"), F.col("_batch.start")
    else:
        rows, key, start = stream, F.date_trunc(part.granularity, part.field), F.col("_batch")
    rows = rows.withColumn("_batch", key)
    parts = [rows.withColumn("_seen", F.lit(""))]
    for column, names in (distinct or {}).items():
        once = rows.select("_batch", *names).where(reduce(Column.__and__, [F.col(n).isNotNull() for n in names]))
        parts.append(once.dropDuplicates(["_batch", *names]).select("_batch", F.lit(column).alias("_seen")))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    sums = [F.expr(f"{total} FILTER (WHERE _seen = '')").alias(c) for c, total in totals.items()]
    counts = [F.count_if(F.col("_seen") == c).alias(c) for c in distinct or {}]
    return both.groupBy("_batch").agg(*sums, *counts).select(start.alias(name), *totals, *(distinct or {}))


def totals_stream(stream: DataFrame, warehouse: Warehouse, table: str, part: TimePartition, totals: Mapping[str, str], checkpoint: str,
                  distinct: Mapping[str, Sequence[str]] | None = None, name: str = "batch", watermark: str | None = None,
                  once: bool = False) -> StreamingQuery:
    """A table of :func:`running_totals`, partitioned by time batch: every micro-batch replaces the partitions of the batches it
    changed with their new totals, whole, so that a repeat changes nothing."""
    by = TimePartition(name, part.granularity)

    def work(batch: DataFrame, number: int) -> None:
        with staged(batch, warehouse.spark) as changed:
            if changed.isEmpty():
                return
            if warehouse.exists(table):
                warehouse.replace_partitions(table, changed, by)
            else:
                warehouse.write_table(table, changed, by)

    return _start(running_totals(stream, part, totals, distinct, name, watermark), work, checkpoint, once, "update")
