"""Grouped totals kept up to date from those partitions of their source that changed.

A rollup stores partial totals, one set per partition of the source table. A refresh compares the files of every source
partition (names, sizes and times, without opening them) with those it last saw, computes the partials of changed partitions
again, drops those of removed ones, and leaves the others. Reading combines the partials. When keys or totals change the
rollup is made anew.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tradewind.sources.tables import LASTING, ValuePartition, Warehouse, is_in, value_text

PART = ValuePartition("_source_partition")
SPEC = f"{LASTING}rollup"
MISSING = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Total:
    """A SQL aggregate of source rows, and the built-in by which totals of several partitions combine."""

    sql: str
    combine: str = "sum"

    def __post_init__(self) -> None:
        if self.combine not in ("sum", "min", "max"):
            raise ValueError(f"totals combine by sum, min or max: {self.combine}")


@dataclass(frozen=True)
class Rollup:
    """``totals`` of the rows of ``source``, a partitioned table, per ``keys``, stored as ``table``."""

    warehouse: Warehouse
    table: str
    source: str
    keys: tuple[str, ...]
    totals: Mapping[str, Total]

    @property
    def _seen(self) -> str:
        return f"{self.table}_sources"

    def _spec(self) -> str:
        return json.dumps([self.source, list(self.keys), {c: [t.sql, t.combine] for c, t in self.totals.items()}])

    def _files(self) -> DataFrame:
        """part (text, NULL for rows without a value) and a mark of its files: their number and the sum of hashes of their
        names, sizes and times."""
        wh, (column,) = self.warehouse, self.warehouse.partition_columns(self.source)
        files = (wh.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
                 .load(wh.location(self.source)).select("path", "length", "modificationTime"))
        part = F.url_decode(F.regexp_extract("path", f"/{column}=([^/]*)/", 1))
        known = wh.partition_values(self.source)
        mark = F.concat_ws(":", F.count("*"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")))
        marks = files.select(F.when(part != MISSING, part).alias("part"), "path", "length", "modificationTime").groupBy("part").agg(mark.alias("mark"))
        # files of a partition that the catalog has dropped do not count
        return marks.where(is_in("part", [value_text(v) for v in known])) if known else marks.limit(0)

    def changed(self) -> tuple[list[str | None], list[str | None]]:
        """Source partitions to compute again, and removed ones: lists no longer than that of the partitions."""
        now = self._files().withColumn("now", F.lit(True)).alias("n")
        then = self.warehouse.read(self._seen).withColumn("then", F.lit(True)).alias("t")
        both = now.join(then, F.col("n.part").eqNullSafe(F.col("t.part")), "full_outer").where(~F.col("n.mark").eqNullSafe(F.col("t.mark")))
        rows = both.select(F.when(F.col("now"), F.col("n.part")).otherwise(F.col("t.part")).alias("part"), F.col("now").isNotNull().alias("here")).collect()
        return [r["part"] for r in rows if r["here"]], [r["part"] for r in rows if not r["here"]]

    def _partials(self, rows: DataFrame) -> DataFrame:
        column, = self.warehouse.partition_columns(self.source)
        part = F.col(column).cast("string").alias(PART.column)
        return rows.groupBy(*self.keys, part).agg(*[F.expr(t.sql).alias(c) for c, t in self.totals.items()])

    def refresh(self, full: bool = False) -> list[str | None]:
        """Bring the partials up to date; gives the source partitions that were read."""
        wh = self.warehouse
        marks = [tuple(r) for r in self._files().collect()]  # before the rows are read, so that a later change is seen next time
        source = wh.read(self.source, technical=True)
        if full or not wh.exists(self.table) or wh.properties(self.table).get(SPEC) != self._spec():
            wh.write_table(self.table, self._partials(source), PART)
            wh.set_properties(self.table, {SPEC: self._spec()})
            read = [p for p, _ in marks]
        else:
            read, removed = self.changed()
            if read:
                column, = wh.partition_columns(self.source)
                kind = source.schema[column].dataType
                same = F.col(column).isin([F.lit(p).cast(kind) for p in read if p is not None])
                where = F.coalesce(same, F.lit(False)) | F.col(column).isNull() if None in read else same
                filled = wh.replace_partitions(self.table, self._partials(source.where(where)), PART)
                removed += [p for p in read if p not in filled]
            wh.drop_partitions(self.table, removed)
        wh.write_table(self._seen, wh.spark.createDataFrame(marks, "part string, mark string").coalesce(1))
        return read

    def read(self) -> DataFrame:
        """keys and totals over all partitions."""
        partials = self.warehouse.read(self.table)
        return partials.groupBy(*self.keys).agg(*[getattr(F, t.combine)(c).alias(c) for c, t in self.totals.items()])


def rollup(warehouse: Warehouse, table: str, source: str, keys: Sequence[str], totals: Mapping[str, Total]) -> Rollup:
    """A rollup that is made if it is not there or has other keys or totals; refreshing it is up to the caller."""
    made = Rollup(warehouse, table, source, tuple(keys), dict(totals))
    if not warehouse.exists(table) or warehouse.properties(table).get(SPEC) != made._spec():
        made.refresh()
    return made
