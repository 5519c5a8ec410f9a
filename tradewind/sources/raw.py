"""Reading raw CSV files and loading them into tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tradewind.functions.casts import spark_type
from tradewind.sources.schemas import COLUMNS, FILES, raw_schema
from tradewind.sources.tables import Warehouse

PARALLEL_LOADS = 4

# lines of a block that are summed up together: 2 ** CHUNK_BITS
CHUNK_BITS = 13


def read_csv(spark: SparkSession, path: str, schema: StructType, *, delimiter: str = ",",
             multiline: bool = True) -> DataFrame:
    """CSV with a header line, doubled quotes, line breaks inside quotes, short rows padded with
    NULL. The schema goes by position; header names and a byte-order mark are skipped.

    With ``multiline`` one task reads one file, which suits a folder of many small files. For files known to
    have no line breaks inside quotes, ``multiline=False`` lets Spark cut each file into blocks; files of any
    size that may have some are read in blocks by :func:`read_csv_in_blocks`.
    """
    return (
        spark.read.schema(schema)
        .options(header=True, sep=delimiter, quote='"', escape='"', multiLine=multiline,
                 mode="PERMISSIVE", enforceSchema=True)
        .csv(path)
    )


def _ends(line: Column, delimiter: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted field: if it begins a record or goes on outside quotes, and if it begins
    inside a quoted field. A quote opens a field only as its first character; what follows a closing quote runs to the
    next delimiter."""
    d = re.escape(delimiter)
    body = '(?:[^"]++|"")*+'
    rest = f'(?:[^"{d}][^{d}]*+)?'
    field = f'(?:[^"{d}][^{d}]*+|"{body}"{rest})?'
    open_end = f'(?:{field}{d})*+"{body}$'
    return line.rlike(f"(?s)^{open_end}"), line.rlike(f'(?s)^{body}(?:$|"{rest}{d}{open_end})')


def _runs(batch: pa.RecordBatch, *names: str) -> Iterator[tuple[int, int]]:
    """Begins and ends of the stretches of rows that are equal in the named columns."""
    n = batch.num_rows
    cut = np.zeros(max(n - 1, 0), bool)
    for c in (batch.column(name) for name in names):
        cut |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    begins = [0, *(np.flatnonzero(cut) + 1).tolist()] if n else []
    return zip(begins, [*begins[1:], n])


def _flags(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("from_out", "from_in"))


def _places(from_out: np.ndarray, from_in: np.ndarray, inside: bool) -> np.ndarray:
    """Whether each of some lines, and what comes behind the last, begins inside a quoted field, as the first does if ``inside``."""
    odd = np.logical_xor.accumulate(from_out & ~from_in)
    last = np.maximum.accumulate(np.where(from_out == from_in, np.arange(len(odd)), -1))
    at = np.maximum(last, 0)
    return np.concatenate(([inside], np.where(last >= 0, from_out[at] ^ odd[at], inside) ^ odd))


CHUNK_ENDS = ("file string, block bigint, chunk bigint, first boolean, returns boolean, ends_out boolean, ends_in boolean, "
              "starts_in boolean")


def _chunk_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per chunk: where it ends if it begins outside (``ends_out``) or inside a quoted field, and if a line of it
    begins outside in the latter case (``starts_in``). Lines come in the order of their block."""
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.bool_()] * 5]
    names = [c.split()[0] for c in CHUNK_ENDS.split(", ")]
    chunk: list = []

    def rows(done: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], kind) for i, kind in enumerate(kinds)], names)

    for batch in batches:
        done, (from_out, from_in) = [], _flags(batch)
        for lo, hi in _runs(batch, "file", "block", "chunk"):
            key = [batch.column(c)[lo].as_py() for c in ("file", "block", "chunk")]
            if key != chunk[:3]:
                if chunk:
                    done.append(chunk)
                chunk = [*key, key[:2] != chunk[:2], batch.column("returns")[lo].as_py(), False, True, False]
            out, within = (_places(from_out[lo:hi], from_in[lo:hi], begins) for begins in chunk[5:7])
            chunk[5:] = bool(out[-1]), bool(within[-1]), chunk[7] or not within[:-1].all()
        if done:
            yield rows(done)
    if chunk:
        yield rows([chunk])


RECORDS = "file string, start bigint, block bigint, head boolean, record string"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that lie in one block, without the headers of files, and the parts in this block of records that do not, with the block where
    such a record begins (``start``). The first row of all lists the blocks that begin inside a quoted field, or in a
    file whose lines end in a carriage return."""
    known = key = start = None
    inside = returns = head = at_head = False
    lines: list[bytes] = []
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def part() -> tuple:
        return key[0], key[1] if start is None else start, key[1], head, b"\n".join(lines)

    def rows(parts: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        columns = [pa.array([p[i] for p in parts], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([*columns[:4], columns[4].view(pa.string())], names)

    for batch in batches:
        if known is None and batch.num_rows:
            known = {(k["file"], k["block"]): k for k in batch.column("known")[0].as_py() or ()}
        whole, long, parts, (from_out, from_in) = [], [], [], _flags(batch)
        for lo, hi in _runs(batch, "file", "block"):
            if (now := tuple(batch.column(c)[lo].as_py() for c in ("file", "block"))) != key:
                if lines:
                    parts.append(part())
                key, here = now, known.get(now, {})
                inside, returns, start = here.get("begins_in", False), here.get("returns", False), here.get("start")
                lines, head, at_head = [], False, now[1] == 0
            # as bytes, which need not be valid text
            text = batch.column("line").slice(lo, hi - lo).view(pa.binary())
            if returns:
                text = pc.replace_substring_regex(text, "\r{1,2}\\z", "")
            place = _places(from_out[lo:hi], from_in[lo:hi], inside)
            begins_in, ends_in, inside = place[:-1], place[1:], bool(place[-1])
            single = ~(begins_in | ends_in)
            for i in np.flatnonzero(~single).tolist():
                if not begins_in[i]:
                    lines, start, head = [], None, at_head and i == 0
                lines.append(text[i].as_py())
                if not ends_in[i]:
                    if start is not None:
                        parts.append(part())
                    elif not head:
                        long.append(b"\n".join(lines))
                    lines = []
            single[0] &= not at_head
            whole.append(text.filter(pa.array(single)))
            at_head = False
        found = pa.concat_arrays([*whole, pa.array(long, pa.binary())]).view(pa.string())
        if len(found):
            missing = [pa.nulls(len(found), kind) for kind in (pa.string(), pa.int64(), pa.int64(), pa.bool_())]
            yield pa.RecordBatch.from_arrays([*missing, found], names)
        if parts:
            yield rows(parts)
    if lines:
        yield rows([part()])


def read_csv_in_blocks(spark: SparkSession, path: str, schema: StructType, *, delimiter: str = ",") -> DataFrame:
    """The same, each file read in blocks by many tasks, line breaks in quotes included.

    Two patterns tell where a line leaves the parser, in or out of quotes, from either place: it keeps the place, swaps
    it, or settles it. A first scan makes one row per chunk (some thousand lines of a block), which acts on the chunks after it like one
    line, and so finds the blocks that begin inside a quoted field. A second one knows them and cuts each block into records where it
    is read: no line is shuffled or sorted but those of records that lie in several blocks, which are put together by where the record
    begins. A file that ends inside a quoted field is refused when it is read.
    """
    def read(*conditions: Column) -> DataFrame:
        text = reduce(DataFrame.where, conditions, spark.read.option("lineSep", "\n").text(path))
        from_out, from_in = _ends(F.col("line"), delimiter)
        return text.select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
        ).withColumns({"from_out": from_out, "from_in": from_in})

    def track(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
        """Adds the swaps up to each row, and what the last settled row up to it (``last``) or before it (``prior``) says."""
        upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        df = df.withColumn("swaps", F.sum("swap").over(upto))
        known = F.when(F.col("settled").isNotNull(), F.struct("settled", "swaps"))
        return df.withColumns({"last": F.last(known, ignorenulls=True).over(upto),
                               "prior": F.last(known, ignorenulls=True).over(upto.rowsBetween(Window.unboundedPreceding, -1))})

    def place(last: str, swaps: Column, otherwise: Column) -> Column:
        odd = (swaps - F.coalesce(F.col(f"{last}.swaps"), F.lit(0))) % 2 == 1
        return F.coalesce(F.col(f"{last}.settled"), otherwise) != odd

    # one row per chunk: it settles the place, or swaps it or not; ids of lines go up within a block
    chunks = read().select("file", "block", F.shiftright("at", CHUNK_BITS).alias("chunk"), "from_out", "from_in",
                           F.col("line").endswith("\r").alias("returns")).mapInArrow(_chunk_ends, CHUNK_ENDS)
    chunks = track(chunks.withColumns({"settled": F.when(F.col("ends_out") == F.col("ends_in"), F.col("ends_out")),
                                       "swap": (F.col("ends_out") & ~F.col("ends_in")).cast("int")}), ["file"], "block", "chunk")
    in_file = Window.partitionBy("file").orderBy("block", "chunk")
    whole = in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    outside = F.lit(False)
    chunks = chunks.withColumn("begins_in", place("prior", F.col("swaps") - F.col("swap"), outside)).withColumns({
        "open": F.last(place("last", F.col("swaps"), outside)).over(whole),
        # the first line tells how the lines of a file end, as for Spark's own reader
        "returns": F.first("returns").over(whole),
        # the last earlier block in which a record begins
        "start": F.last(F.when(~F.col("begins_in") | F.col("starts_in"), F.col("block")), ignorenulls=True).over(
            in_file.rowsBetween(Window.unboundedPreceding, -1))})
    refused = F.when(F.col("open"), F.raise_error(F.concat(F.lit("the file ends inside a quoted field: "), "file")))
    blocks = chunks.where("first").where(F.coalesce(refused.cast("boolean"), F.col("begins_in") | F.col("returns")))
    # at most an entry per block, of which Spark's driver has the list as well
    known = blocks.agg(F.struct(
        F.collect_list(F.struct("file", "block", "begins_in", "returns", "start")).alias("blocks"),
        F.coalesce(F.bool_or("begins_in"), F.lit(False)).alias("crossed")).alias("known")).scalar()

    def records(*conditions: Column) -> DataFrame:
        first = F.col("at").bitwiseAND((1 << 33) - 1) == 0  # of the lines of a task
        return read(*conditions).select("file", "block", "line", "from_out", "from_in", F.when(first, known["blocks"]).alias("known")).mapInArrow(
            _records, RECORDS)

    single = records().where("start IS NULL").select("record")
    longer = records(known["crossed"]).where("start IS NOT NULL").groupBy("file", "start").agg(
        F.array_sort(F.collect_list(F.struct("block", "record", "head"))).alias("parts")).where(~F.col("parts")[0]["head"]).select(
        F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    options = {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    return single.unionByName(longer).where("record <> ''").select(F.from_csv("record", columns, options).alias("r")).select("r.*")


def raw_table(spark: SparkSession, folder: str, table: str, files: Mapping[str, str] | None = None,
              multiline: bool | str = "blocks") -> DataFrame:
    """One of the nine raw tables as text columns. ``multiline="blocks"`` reads each file by many tasks."""
    path = f"{folder.rstrip('/')}/{(files or FILES)[table]}"
    if multiline == "blocks":
        return read_csv_in_blocks(spark, path, raw_schema(table))
    return read_csv(spark, path, raw_schema(table), multiline=bool(multiline))


def in_parallel(tasks: Iterable[Callable[[], object]], threads: int = PARALLEL_LOADS) -> list:
    """Run independent Spark jobs side by side; the first error is raised."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


def load_bronze(warehouse: Warehouse, folder: str, files: Mapping[str, str] | None = None,
                tables: Iterable[str] = tuple(COLUMNS), multiline: bool | str = "blocks") -> dict[str, int]:
    """Replace each bronze table by the contents of its file, and give the rows per table. The rows that the job read from the file are
    counted on their way into the table and compared with what the table then holds; no file is read for a second time."""
    spark, tables = warehouse.spark, list(tables)

    def load(table: str) -> int:
        return warehouse.write_table(f"bronze.{table}", raw_table(spark, folder, table, files, multiline))["rows"]

    counts = dict(zip(tables, in_parallel(lambda t=t: load(t) for t in tables), strict=True))
    verify_bronze(warehouse, counts)
    return counts


def verify_bronze(warehouse: Warehouse, counts: Mapping[str, int]) -> None:
    """Every bronze table must hold as many rows as were read; stored rows are counted from the footers of their files."""
    held = [warehouse.read(f"bronze.{t}").agg(F.count("*").alias("n")).select(F.lit(t).alias("table"), "n") for t in counts]
    seen = {r["table"]: r["n"] for r in reduce(DataFrame.unionByName, held).collect()} if held else {}
    wrong = {t: (n, seen[t]) for t, n in counts.items() if seen[t] != n}
    if wrong:
        raise ValueError(f"row counts differ (raw, bronze): {wrong}")


def load_seed(warehouse: Warehouse, table: str, path: str, *, delimiter: str = ",",
              column_types: Mapping[str, str] | None = None, full_refresh: bool = False) -> None:
    """CSV → table with inferred types and overrides per column. A rerun refills the table it finds;
    ``full_refresh`` makes it anew, so that columns and types may change."""
    spark = warehouse.spark
    df = spark.read.csv(path, header=True, sep=delimiter, quote='"', escape='"', multiLine=True, inferSchema=True)
    if column_types:
        text = spark.read.csv(path, header=True, sep=delimiter, quote='"', escape='"', multiLine=True)
        # overrides are cast from the text, so that an override to string keeps leading zeros
        keep = {f.name: f.dataType for f in df.schema}
        df = text.select(*[
            F.col(c).cast(spark_type(column_types[c]) if c in column_types else keep[c]).alias(c) for c in text.columns
        ])
    if warehouse.exists(table) and not full_refresh:
        have = warehouse.read(table).schema
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in have])
    warehouse.write_table(table, df)
