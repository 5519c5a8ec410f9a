"""Type-2 history: every version of a row with the time it was valid.

One version per key is open (its end is NULL, or a configured value). A run joins the open versions
with the source once; each pair then yields the versions it leaves behind.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.dates import time_literal
from tradewind.functions.predicates import equals
from tradewind.operators.merge import spread_missing_keys
from tradewind.operators.schema_drift import add_columns
from tradewind.session import staged
from tradewind.sources.tables import LASTING, ValuePartition, Warehouse, value_text

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
HARD_DELETES = ("ignore", "invalidate", "new_record")


@dataclass(frozen=True)
class Names:
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    scd_id: str = "scd_id"
    updated_at: str = "changed_at"
    is_deleted: str = "is_deleted"


@dataclass(frozen=True)
class Tracking:
    """What makes a new version.

    ``updated_at`` alone: a row is new when its time is later than the open version's start.
    ``check``: a row is new when one of these columns (or ``"all"``) differs; its time is then
    ``updated_at`` if given, else the time of the run.
    """

    keys: tuple[str, ...]
    updated_at: str | None = None
    check: tuple[str, ...] | str | None = None
    hard_deletes: str = "ignore"
    # end of an open version; None means NULL
    open_end: datetime | None = None
    names: Names = Names()
    null_safe: bool = False

    def __post_init__(self) -> None:
        if isinstance(self.check, str) and self.check != "all" or self.check == ():
            raise ValueError(f"check must be 'all' or a list of columns: {self.check!r}")
        if self.check is None and self.updated_at is None:
            raise ValueError("give updated_at, check, or both")
        if self.hard_deletes not in HARD_DELETES:
            raise ValueError(f"hard_deletes must be one of {HARD_DELETES}: {self.hard_deletes}")

    @property
    def own_columns(self) -> list[str]:
        n = self.names
        tail = [n.is_deleted] if self.hard_deletes == "new_record" else []
        return [n.scd_id, n.updated_at, n.valid_from, n.valid_to, *tail]

    def end(self) -> Column:
        return F.lit(None).cast("timestamp") if self.open_end is None else time_literal(self.open_end)

    def is_open(self) -> Column:
        to = F.col(self.names.valid_to)
        return to.isNull() if self.open_end is None else to.isNull() | (to == self.end())


def scd_id(*parts: Column) -> Column:
    """Hex MD5 of the parts' texts joined by ``|``, NULL counting as empty text. Times are written
    with microseconds, so that ids do not depend on the session."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _time_text(t: Column) -> Column:
    return F.date_format(t.cast("timestamp"), TIME_FORMAT)


def _stamped(source: DataFrame, how: Tracking, now: datetime) -> DataFrame:
    """Source rows as open versions."""
    n = how.names
    at = F.col(how.updated_at).cast("timestamp") if how.updated_at else time_literal(now)
    own = {
        n.scd_id: scd_id(*[F.col(k) for k in how.keys], _time_text(at)),
        n.updated_at: at, n.valid_from: at, n.valid_to: how.end(),
    }
    if how.hard_deletes == "new_record":
        own[n.is_deleted] = F.lit("False")
    return source.withColumns(own)


def first_history(source: DataFrame, how: Tracking, now: datetime) -> DataFrame:
    """History of a table seen for the first time: every row is an open version."""
    return _stamped(source, how, now)


def _changed(how: Tracking, source: DataFrame, history_columns: Sequence[str]) -> Column:
    """Whether a pair ``old``/``new`` is a change."""
    if how.check is None:
        return F.col(f"old.{how.names.valid_from}") < F.col(f"new.{how.names.valid_from}")
    columns = [c for c in source.columns] if how.check == "all" else list(how.check)
    unknown = set(columns) - set(source.columns)
    if unknown:
        raise ValueError(f"check columns missing in the source: {sorted(unknown)}")
    if any(c not in history_columns for c in columns):
        return F.lit(True)  # a column is new: every row gets a new version
    return reduce(Column.__or__, [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in columns])


def changes(history: DataFrame, source: DataFrame, how: Tracking, now: datetime) -> DataFrame:
    """Versions that a run leaves in place of the open ones: column ``_was_open`` tells those that
    already existed (still open, or closed now) from those that are new."""
    n, data = how.names, source.columns
    known = set(history.columns)
    # columns that are new in the source are NULL in the versions that exist
    history = add_columns(history, {f.name: f.dataType for f in source.schema if f.name not in known})
    columns = history.columns
    kinds = {f.name: f.dataType for f in history.schema}
    old = spread_missing_keys(history.where(how.is_open()), how.keys, how.null_safe).withColumn("_here", F.lit(True)).alias("old")
    new = spread_missing_keys(_stamped(source, how, now), how.keys, how.null_safe).withColumn("_here", F.lit(True)).alias("new")
    on = reduce(Column.__and__, [equals(f"old.{k}", f"new.{k}", how.null_safe) for k in how.keys])
    on = on & (F.col("old._spread") == F.col("new._spread"))
    has_old, has_new = F.col("old._here").isNotNull(), F.col("new._here").isNotNull()

    deleted = F.coalesce(F.col(f"old.{n.is_deleted}") == "True", F.lit(False)) if n.is_deleted in known else F.lit(False)
    changed = F.coalesce(_changed(how, source, known), F.lit(False)) | deleted
    gone = has_old & ~has_new & ~deleted
    closes_at = F.when(has_old & has_new & changed, F.col(f"new.{n.valid_from}"))
    if how.hard_deletes != "ignore":
        closes_at = closes_at.when(gone, time_literal(now))

    def version(values: dict[str, Column], was_open: bool, when: Column) -> Column:
        fields = [values[c].cast(kinds[c]).alias(c) for c in columns]
        return F.when(when, F.struct(*fields, F.lit(was_open).alias("_was_open")))

    kept = {c: F.col(f"old.{c}") for c in columns} | {n.valid_to: F.coalesce(closes_at, F.col(f"old.{n.valid_to}"))}
    stamped = set(data) | set(how.own_columns)
    added = {c: F.col(f"new.{c}") if c in stamped else F.lit(None) for c in columns}
    versions = [version(kept, True, has_old), version(added, False, has_new & (~has_old | changed))]
    if how.hard_deletes == "new_record":
        grave = {c: F.col(f"old.{c}") if c in data else F.lit(None) for c in columns} | {
            n.scd_id: scd_id(F.col(f"old.{n.scd_id}"), _time_text(time_literal(now))),
            n.valid_from: time_literal(now), n.updated_at: time_literal(now),
            n.valid_to: F.col(f"old.{n.valid_to}"), n.is_deleted: F.lit("True"),
        }
        versions.append(version(grave, False, gone))
    return (
        old.join(new, on, "full_outer")
        .select(F.filter(F.array(*versions), lambda v: v.isNotNull()).alias("versions"))
        .select(F.inline("versions"))
    )


def next_history(history: DataFrame, source: DataFrame, how: Tracking, now: datetime) -> DataFrame:
    """The whole history after a run."""
    n = how.names
    made = changes(history, source, how, now)
    # a new version whose id the history already has is not added again; open ones pass through the same join
    known = history.select(F.col(n.scd_id).alias("_known"))
    made = made.join(known, (F.col(n.scd_id) == F.col("_known")) & ~F.col("_was_open"), "left_anti").drop("_was_open")
    return made.unionByName(history.where(~how.is_open()), allowMissingColumns=True)


# -- stored history ---------------------------------------------------------------------------------

# partition of closed versions; open ones are in partitions 0, 1, ... by a hash of their key
CLOSED = -1
STORED_BY = ValuePartition("_open_bucket")


def apply_history(warehouse: Warehouse, table: str, source: DataFrame, how: Tracking, now: datetime, buckets: int = 16) -> None:
    """Keep a stored history. Closed versions are one partition, which is only appended to. Open ones are dealt to
    ``buckets`` partitions by their key, and a run writes only those again in which a version closes or opens. ``buckets`` is
    fixed by the first run: as many as make the open versions of one some hundred megabytes."""
    with staged(source) as source:
        # in every run alike; a missing key matches nothing, unless NULLs are keys
        named = source if how.null_safe else source.dropna(subset=list(how.keys))
        repeated = named.groupBy(*how.keys).count().where("count > 1").take(1)
        if repeated:
            raise ValueError(f"the source of history {table} repeats a key, for example {repeated[0].asDict()}")
        if not warehouse.exists(table):
            warehouse.write_table(table, _placed(first_history(source, how, now), how, buckets), STORED_BY, how.keys)
            warehouse.set_properties(table, {f"{LASTING}buckets": str(buckets)})
            return
        buckets = int(warehouse.properties(table).get(f"{LASTING}buckets", buckets))
        stored = warehouse.read(table)
        # what stays as it is need not be written
        made = changes(stored.drop(STORED_BY.column), source, how, now).where(~F.col("_was_open") | ~how.is_open())
        with staged(made) as made:
            _store(warehouse, table, stored, made, how, buckets)


def _placed(versions: DataFrame, how: Tracking, buckets: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64(*how.keys), F.lit(buckets)).cast("int")
    return versions.withColumn(STORED_BY.column, F.when(how.is_open(), bucket).otherwise(CLOSED))


def _store(warehouse: Warehouse, table: str, stored: DataFrame, made: DataFrame, how: Tracking, buckets: int) -> None:
    scd_id, place = how.names.scd_id, F.col(STORED_BY.column)
    extra = [f for f in made.schema if f.name not in (*stored.columns, "_was_open")]
    if extra:
        warehouse.add_columns(table, {f.name: f.dataType.simpleString() for f in extra})
        stored = warehouse.read(table)
    closes = _placed(made.where("_was_open").drop("_was_open"), how, buckets)
    # an id that the history already has is not added again
    fresh = _placed(made.where(~F.col("_was_open")).drop("_was_open"), how, buckets).join(stored.select(scd_id), scd_id, "left_anti")
    # closed versions first, skipping those a broken earlier run already appended
    known = stored.where(place == CLOSED).select(scd_id)
    closed = closes.unionByName(fresh.where(~how.is_open())).join(known, scd_id, "left_anti")
    bucket = F.pmod(F.xxhash64(*how.keys), F.lit(buckets)).cast("int")
    # partitions that lose or gain an open version: at most ``buckets`` values
    touched = [r[0] for r in made.select(bucket).distinct().collect()]
    if not touched:
        return
    left = stored.where(place.isin(touched)).join(closes.select(scd_id), scd_id, "left_anti").unionByName(fresh.where(how.is_open()))
    # what stays open is fixed before the table changes under it
    with staged(left) as left:
        if not closed.isEmpty():
            warehouse.append(table, closed, STORED_BY, how.keys)
        filled = warehouse.replace_partitions(table, left, STORED_BY, how.keys)
        warehouse.drop_partitions(table, [b for b in touched if value_text(b) not in filled])
