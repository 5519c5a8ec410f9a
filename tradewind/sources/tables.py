"""Stored tables: Parquet tables in the session catalog, one database per layer.

A table's name is a view over its current version, a Parquet table of its own. A rebuild fills a new version, tells the
catalog its partitions from the values that the write itself saw, and points the view at it in one change of
the catalog, so that a reader sees the whole old or the whole new table at any time. The version before is kept until
the next rebuild, for readers that began on it.

Versions may be split by a derived column (a day, a number range) and clustered. Rows of clustered tables are dealt to
writers by ranges of (partition, cluster columns), so the files of one partition cover ranges that do not
overlap, and a filter on the first cluster column reads few of them. Other rows are spread with a rebalance hint.
Either way a day with most of the rows becomes several files written by several tasks.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import MapType, StructField, StructType

from tradewind.functions.predicates import range_bucket
from tradewind.session import STORED, shuffles_freed

# column comment that marks a partition column as made by this module
DERIVED = "derived partition column"
GRANULARITIES = ("hour", "day", "month", "year")


@dataclass(frozen=True)
class TimePartition:
    """Partition by the hour, day, month or year of a time column."""

    field: str
    granularity: str = "day"
    # the partition time comes from ``field``, which is then not stored in the row
    drop_field: bool = False

    def __post_init__(self) -> None:
        if self.granularity not in GRANULARITIES:
            raise ValueError(f"granularity must be one of {GRANULARITIES}: {self.granularity}")

    @property
    def column(self) -> str:
        return "_partition_time" if self.drop_field else f"{self.field}_{self.granularity}"

    def value(self, ts: Column | None = None) -> Column:
        ts = F.col(self.field) if ts is None else ts
        if self.granularity == "hour":
            return F.date_format(ts, "yyyy-MM-dd-HH")
        return F.date_trunc(self.granularity, ts).cast("date")

    def time(self) -> Column:
        """The partition's start as timestamp, from the partition column."""
        if self.granularity == "hour":
            return F.to_timestamp(F.col(self.column), F.lit("yyyy-MM-dd-HH"))
        return F.col(self.column).cast("timestamp")


@dataclass(frozen=True)
class RangePartition:
    """Partition by fixed-width ranges of a whole-number column."""

    field: str
    start: int
    end: int
    interval: int
    drop_field = False

    @property
    def column(self) -> str:
        return f"{self.field}_range"

    def value(self) -> Column:
        return range_bucket(self.field, self.start, self.end, self.interval)


@dataclass(frozen=True)
class ValuePartition:
    """Partition by a column as it is (one of few values)."""

    field: str
    drop_field = False

    @property
    def column(self) -> str:
        return self.field

    def value(self) -> Column:
        return F.col(self.field)


@dataclass(frozen=True)
class KeyPartition:
    """Partition by a hash of the key, so that a row never leaves its partition while its key stays.

    A keyed change then finds the partitions to rewrite from the new rows alone. ``buckets``: as many as make a partition some
    hundred megabytes.
    """

    keys: tuple[str, ...]
    buckets: int
    drop_field = False
    field = None

    def __post_init__(self) -> None:
        # a layout read back from a table holds a list
        object.__setattr__(self, "keys", tuple(self.keys))

    @property
    def column(self) -> str:
        return "_key_bucket"

    def value(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")


Partition = TimePartition | RangePartition | ValuePartition | KeyPartition
KINDS = {kind.__name__: kind for kind in (TimePartition, RangePartition, ValuePartition, KeyPartition)}
# table property with the partition and the cluster columns of a table
LAYOUT = "tradewind.table_layout"
# properties that a rebuild hands on to the next version
LASTING = "tradewind.lasting."


def is_in(column: str, values: Sequence) -> Column:
    """``column`` is one of ``values``, where None stands for NULL. Never NULL itself."""
    known = [v for v in values if v is not None]
    hit = F.coalesce(F.col(column).isin(known), F.lit(False)) if known else F.lit(False)
    return hit | F.col(column).isNull() if None in values else hit


def text_literal(value) -> str:
    """``value`` as a SQL string."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def value_text(value) -> str | None:
    """A partition value as the catalog writes it."""
    return value if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def in_chunks(values: Sequence, size: int) -> list[Sequence]:
    return [values[i:i + size] for i in range(0, len(values), size)]


@dataclass
class Warehouse:
    """Named tables ``<layer>.<table>``. ``root`` is the folder under which databases are made;
    without it they go to the session's warehouse folder."""

    spark: SparkSession
    root: str | None = None
    databases: dict[str, str] | None = None

    def full_name(self, table: str) -> str:
        layer, _, name = table.rpartition(".")
        database = (self.databases or {}).get(layer, layer) or self.spark.catalog.currentDatabase()
        return f"{database}.{name}"

    def _make_database(self, table: str) -> None:
        database = self.full_name(table).split(".")[0]
        place = f" LOCATION '{self.root.rstrip('/')}/{database}'" if self.root else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")

    # -- lookup ---------------------------------------------------------------------------------

    def exists(self, table: str) -> bool:
        return self._there(self.full_name(table)) or self._there(self._frame_view(table))

    def _there(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def _frame_view(self, table: str) -> str:
        """Name of the session view that a frame becomes: with its database, as layers may share names."""
        return self.full_name(table).replace(".", "__")

    def stored_name(self, table: str) -> str | None:
        """The catalog table that holds the rows now; None for views and for tables that do not exist."""
        name = self.full_name(table)
        if not self._there(name):
            return None
        if self.spark.catalog.getTable(name).tableType != "VIEW":
            return name
        version = re.fullmatch(rf"SELECT \* FROM ({re.escape(name)}__v\w+)", self._described(name, "View Text"))
        return version[1] if version else None

    def _described(self, name: str, what: str) -> str:
        """A property of a catalog entry. The description is collected as it is, which needs no job."""
        return next(r["data_type"].strip() for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == what)

    def is_view(self, table: str) -> bool:
        """Whether the table is a query, in the catalog or of this session, and not stored rows."""
        return self.exists(table) and self.stored_name(table) is None

    def read(self, table: str, technical: bool = False) -> DataFrame:
        """The table without its derived partition column, unless ``technical``. The frame stays with the version that
        is current now."""
        stored = self.stored_name(table)
        if stored is None:
            name = self.full_name(table)
            return self.spark.table(name if self._there(name) else self._frame_view(table))
        df = self.spark.table(stored)
        if technical:
            return df
        return df.drop(*[f.name for f in df.schema if f.metadata.get("comment") == DERIVED])

    def partition_columns(self, table: str) -> list[str]:
        stored = self.stored_name(table)
        return [c.name for c in self.spark.catalog.listColumns(stored) if c.isPartition] if stored else []

    def partition_values(self, table: str) -> list:
        """Values of the partition column, from the catalog and not from the rows."""
        column, = self.partition_columns(table)
        stored = self.stored_name(table)
        kind = self.spark.table(stored).schema[column].dataType
        listed = self.spark.sql(f"SHOW PARTITIONS {stored}")
        text = F.regexp_extract("partition", "^[^=]*=(.*)$", 1)
        value = F.when(text != "__HIVE_DEFAULT_PARTITION__", F.url_decode(text)).cast(kind)
        return [r[0] for r in listed.select(value).collect()]

    def rows(self, table: str, part: Partition | None) -> DataFrame:
        """Stored rows in the columns they came with: a field that only lives on as partition comes back."""
        if part is None or not part.drop_field:
            return self.read(table)
        return self.read(table, technical=True).withColumn(part.field, part.time()).drop(part.column)

    def layout(self, table: str) -> tuple[Partition | None, tuple[str, ...]]:
        """Partition and cluster columns that a table was written with."""
        shown = self.properties(table).get(LAYOUT)
        if shown is None:
            return None, ()
        known = json.loads(shown)
        return KINDS[known["kind"]](**known["partition"]) if known["kind"] else None, tuple(known["cluster"])

    def properties(self, table: str) -> dict[str, str]:
        """Properties of the current version; those named ``LASTING...`` go on to the next one."""
        stored = self.stored_name(table)
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {stored}").collect()} if stored else {}

    def set_properties(self, table: str, values: Mapping[str, str]) -> None:
        self._set_properties(self.stored_name(table), values)

    def _set_properties(self, stored: str, values: Mapping[str, str]) -> None:
        if values:
            text = lambda v: v.replace("\\", "\\\\").replace("'", "\\'")
            listed = ", ".join(f"'{text(k)}' = '{text(v)}'" for k, v in values.items())
            self.spark.sql(f"ALTER TABLE {stored} SET TBLPROPERTIES ({listed})")

    # -- write ----------------------------------------------------------------------------------

    def arrange(self, df: DataFrame, partition: Partition | None = None, cluster: Sequence[str] = ()) -> DataFrame:
        """Add the partition column and lay rows out for the write."""
        spread = list(cluster)
        if partition:
            df = df.withColumn(partition.column, partition.value())
            if partition.drop_field:
                df = df.drop(partition.field)
            # the partition column goes last, where tables keep it
            last = F.col(partition.column)
            if partition.column != partition.field:
                last = last.alias(partition.column, metadata={"comment": DERIVED})
            df = df.select(*[c for c in df.columns if c != partition.column], last)
            spread = [partition.column]
        if not spread:
            return df
        if not cluster:
            return df.hint("rebalance", *[F.col(c) for c in spread]).sortWithinPartitions(*spread)
        order = list(dict.fromkeys([*spread, *cluster]))
        # rows with equal cluster columns may still go to several tasks
        rest = F.xxhash64(*[f.name for f in df.schema if not isinstance(f.dataType, MapType)])
        return df.repartitionByRange(*order, rest).sortWithinPartitions(*order)

    def write_table(self, table: str, df: DataFrame, partition: Partition | None = None,
                    cluster: Sequence[str] = (), measures: Mapping[str, Column] | None = None) -> dict[str, Any]:
        """Full rebuild; gives the number of ``rows`` and the aggregates ``measures``, both taken by the job that writes.

        A new version beside the old one, then one change of the view. Until then, and if a job
        or the driver fails, readers keep the old version; ``df`` may read the table itself. What a failed rebuild
        leaves is dropped by the next one."""
        self._make_database(table)
        name, was = self.full_name(table), self.stored_name(table)
        version = f"{name}__v{uuid.uuid4().hex[:16]}"
        lasting = {k: v for k, v in self.properties(table).items() if k.startswith(LASTING)} if was else {}
        rows = self.arrange(df, partition, cluster)
        columns = StructType([StructField(f.name, f.dataType, True, f.metadata) for f in rows.schema]).toDDL()
        by = f" PARTITIONED BY (`{partition.column}`)" if partition else ""
        self.spark.sql(f"CREATE TABLE {version} ({columns}) USING parquet{by}")
        _, seen = self._write_files(version, rows, partition, "append", measures)
        layout = {"kind": type(partition).__name__ if partition else None, "partition": asdict(partition) if partition else {}, "cluster": list(cluster)}
        self._set_properties(version, {LAYOUT: json.dumps(layout), **lasting})
        if was is None:
            self._drop_query(table)
        self._point(table, version)
        self._drop_versions(table, keep={version, was})
        return seen

    def _point(self, table: str, version: str) -> None:
        """Makes ``version`` what the table's name stands for."""
        name = self.full_name(table)
        if self._there(name) and self.spark.catalog.getTable(name).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {name}")
        # altering a view is one change of the catalog; replacing it would drop it first
        verb = "ALTER" if self._there(name) else "CREATE"
        self.spark.sql(f"{verb} VIEW {name} AS SELECT * FROM {version}")

    def _drop_versions(self, table: str, keep: set[str | None]) -> None:
        database, _, name = self.full_name(table).rpartition(".")
        if not self.spark.catalog.databaseExists(database):
            return
        for row in self.spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__v*'").collect():
            version = f"{database}.{row['tableName']}"
            if re.fullmatch(rf"{re.escape(name)}__v[0-9a-f]{{16}}", row["tableName"], re.IGNORECASE) and version.lower() not in {k.lower() for k in keep if k}:
                self.spark.sql(f"DROP TABLE IF EXISTS {version}")

    def drop(self, table: str) -> None:
        self._drop_query(table)
        if self._there(self.full_name(table)):
            self.spark.sql(f"DROP TABLE {self.full_name(table)}")
        self._drop_versions(table, keep=set())

    def _drop_query(self, table: str) -> None:
        """Drops what the name stands for, but for a table; versions stay."""
        name = self.full_name(table)
        if self._there(self._frame_view(table)):
            self.spark.catalog.dropTempView(self._frame_view(table))
        if self._there(name) and self.spark.catalog.getTable(name).tableType == "VIEW":
            self.spark.sql(f"DROP VIEW {name}")

    def add_columns(self, table: str, columns: Mapping[str, str]) -> None:
        """New columns, NULL in the rows there are: the catalog changes, no file does."""
        stored = self.stored_name(table)
        listed = ", ".join(f"`{c}` {t}" for c, t in columns.items())
        self.spark.sql(f"ALTER TABLE {stored} ADD COLUMNS ({listed})")
        if stored != self.full_name(table):
            self._point(table, stored)

    def append(self, table: str, df: DataFrame, partition: Partition | None = None, cluster: Sequence[str] = ()) -> None:
        out, stored = self.arrange(df, partition, cluster), self.stored_name(table)
        with shuffles_freed(self.spark):
            out.select(*self.spark.table(stored).columns).write.insertInto(stored)

    def replace_partitions(self, table: str, df: DataFrame, partition: Partition, cluster: Sequence[str] = ()) -> set[str | None]:
        """Replace exactly the partitions that occur in ``df``, and give their values as text. ``df`` may read the same
        table: old files are removed when the job commits.

        The overwrite mode is an option of this one write. As a session setting it could be reset by
        another thread, and a static overwrite would empty the table.
        """
        stored = self.stored_name(table)
        out = self.arrange(df, partition, cluster).select(*self.spark.table(stored).columns)
        return self._write_files(stored, out, partition, "overwrite")[0]

    def _write_files(self, stored: str, rows: DataFrame, partition: Partition | None, mode: str,
                     measures: Mapping[str, Column] | None = None) -> tuple[set[str | None], dict[str, Any]]:
        """Writes files under a catalog table and makes the partitions known that the write saw; no folder is listed. Gives
        their values and what was measured."""
        seen, aggregates = Observation(), {"rows": F.count(F.lit(1)), **(measures or {})}
        if partition:
            value = F.col(partition.column)
            aggregates |= {"_values": F.collect_set(value.cast("string")), "_missing": F.count_if(value.isNull())}
        writer = rows.observe(seen, *[a.alias(n) for n, a in aggregates.items()]).write.options(**STORED)
        if partition:
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition.column)
        with shuffles_freed(rows.sparkSession):
            writer.mode(mode).parquet(self._location(stored))
        found = dict(seen.get)
        values = set(found.pop("_values", None) or ()) | ({None} if found.pop("_missing", 0) else set())
        for chunk in in_chunks(sorted(values, key=str), 500):
            specs = " ".join(f"PARTITION ({partition.column} = {'NULL' if v is None else text_literal(v)})" for v in chunk)
            self.spark.sql(f"ALTER TABLE {stored} ADD IF NOT EXISTS {specs}")
        self.spark.catalog.refreshTable(stored)
        return values, found

    def location(self, table: str) -> str:
        return self._location(self.stored_name(table))

    def _location(self, stored: str) -> str:
        return self._described(stored, "Location")

    def drop_partitions(self, table: str, values: Sequence) -> None:
        column, = self.partition_columns(table)
        stored = self.stored_name(table)
        for chunk in in_chunks(list(values), 500):
            specs = ", ".join(f"PARTITION ({column} = {'NULL' if v is None else text_literal(v)})" for v in chunk)
            self.spark.sql(f"ALTER TABLE {stored} DROP IF EXISTS {specs}")

    # -- other kinds ----------------------------------------------------------------------------

    def create_view(self, table: str, body: DataFrame | str, full_refresh: bool = False) -> None:
        """Replace a view. SQL text becomes a view in the catalog, which other sessions read; its columns are bound to their types,
        so that a change of the tables below that would change it is an error. A frame becomes a view of this session. A table
        of that name is an error, or dropped on full refresh."""
        if self.stored_name(table) is not None:
            if not full_refresh:
                raise ValueError(f"{self.full_name(table)} is a table; use full_refresh to put a view in its place")
            self.drop(table)
        if not isinstance(body, str):
            body.createOrReplaceTempView(self._frame_view(table))
            return
        self._make_database(table)
        name = self.full_name(table)
        if self._there(name):
            # readers see the old or the new view; a replacement would drop it first
            self.spark.sql(f"ALTER VIEW {name} AS {body}")
        else:
            self.spark.sql(f"CREATE VIEW {name} WITH SCHEMA BINDING AS {body}")

    def copy(self, sources: Sequence[str], table: str, mode: str = "table") -> None:
        """Rows of several tables into one: replacing it (``table``, in the layout of the first source) or added to it
        (``incremental``, in its own layout)."""
        if mode not in ("table", "incremental"):
            raise ValueError(f"unknown copy mode: {mode}")
        rows = reduce(DataFrame.unionByName, [self.rows(s, self.layout(s)[0]) for s in sources])
        if mode == "incremental" and self.exists(table):
            self.append(table, rows, *self.layout(table))
        else:
            self.write_table(table, rows, *self.layout(sources[0]))

    def clone(self, source: str, table: str, full_refresh: bool = False, as_view: bool = False) -> None:
        """Copy of another table in its layout; kept as it is when present, unless ``full_refresh``. ``as_view``
        points at the source instead of copying files."""
        if self.exists(table) and not full_refresh:
            return
        if as_view:
            self.create_view(table, f"SELECT * FROM {self.full_name(source)}", full_refresh)
        else:
            partition, cluster = self.layout(source)
            self.write_table(table, self.rows(source, partition), partition, cluster)

    def materialized_view(self, table: str, query: Callable[[], DataFrame], partition: Partition | None = None,
                          cluster: Sequence[str] = ()) -> "MaterializedView":
        view = MaterializedView(self, table, query, partition, tuple(cluster))
        if not self.exists(table) or view.changed():
            view.refresh()
        return view


@dataclass
class MaterializedView:
    """A stored query result, made when absent or when its layout changed, and refreshed on demand."""

    warehouse: Warehouse
    table: str
    query: Callable[[], DataFrame]
    partition: Partition | None = None
    cluster: tuple[str, ...] = ()

    def changed(self) -> bool:
        return self.warehouse.layout(self.table) != (self.partition, self.cluster)

    def refresh(self) -> DataFrame:
        self.warehouse.write_table(self.table, self.query(), self.partition, self.cluster)
        return self.warehouse.read(self.table)
