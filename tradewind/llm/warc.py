"""WARC archives compressed with a dictionary of their own (.warc.zst).

An archive is a leading skippable frame (magic 0x184D2A5D) with a Zstandard dictionary, then one Zstandard frame per
record, each compressed with that dictionary and readable by itself. A writing task gathers about ARCHIVE_BYTES of records,
trains the dictionary on records spread evenly over these, and compresses them one by one. Where Zstandard finds too
little to train on there is no dictionary frame. The first record of an archive is its ``warcinfo``.

Equal payloads are stored once: the row with the smallest id is a ``response``, the others are ``revisit`` records that
refer to it and keep only the HTTP header, whose Content-Length is that of the payload left out. Which payloads occur
again is found by grouping digests; payloads meet that list, not one another, so a payload that a third of the rows
share is no hot group, and the list is broadcast only where its file is small enough for Spark to do so by itself.

Archives are rows of an uncompressed Parquet folder, which any store that Spark writes to can keep; ``export`` makes plain
files of them, and ``records`` reads either.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.staging import written

ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 64 << 10
# most bytes that a dictionary is trained on, and the longest piece taken from one record
SAMPLE_BYTES, PIECE_BYTES = 4 << 20, 64 << 10
SKIPPABLE, FRAME = struct.pack("<I", 0x184D2A5D), struct.pack("<I", 0xFD2FB528)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVES = "part int, seq int, n_records long, offsets array<long>, archive binary"
RECORDS = "id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(key: str | None) -> str:
    return "<urn:x-row:none>" if key is None else f"<urn:x-row:id:{quote(key, safe='')}>"


def key_of(name: str) -> str | None:
    known = re.fullmatch(r"<urn:x-row:id:(.*)>", name)
    return unquote(known[1]) if known else None


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(key: str | None, url: str | None, payload: bytes | None, size: int, sha1: str, first: str | None, date: str) -> bytes:
    """The record of one page: a response with its payload, or, without a payload, a revisit of record ``first``."""
    fields = [("WARC-Type", "revisit" if payload is None else "response"), ("WARC-Record-ID", record_name(key)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{sha1}"))
    if payload is None:
        fields += [("WARC-Refers-To", record_name(first)), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Type", "application/http;msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return _record(fields, http + (payload or b""))


def train(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from pieces of records spread evenly, or None where there is too little to train on."""
    pieces = [(i, at) for i, r in enumerate(records) for at in range(0, len(r), PIECE_BYTES)]
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    samples = [records[i][at:at + PIECE_BYTES] for i, at in pieces[::step]]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, total // 8)), samples, k=256, d=8, f=18, split_point=1.0, accel=4, level=3)
    except zstandard.ZstdError:
        return None


def build_archive(records: list[bytes], date: str) -> tuple[bytes, list[int]]:
    """The archive of some records, and where the frame of each begins."""
    shared = train(records)
    if shared:
        shared.precompute_compress(level=3)
    press = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=True)
    info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-archive:{digest(b''.join(r[:200] for r in records))}>"),
                    ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC file version 1.1\r\n")
    parts = [SKIPPABLE + struct.pack("<I", len(shared)) + shared.as_bytes()] if shared else []
    parts.append(press.compress(info))
    at, offsets = sum(map(len, parts)), []
    for record in records:
        parts.append(press.compress(record))
        offsets.append(at)
        at += len(parts[-1])
    return b"".join(parts), offsets


def _unpacker(archive) -> tuple[zstandard.ZstdDecompressor, int]:
    """What decompresses the frames of an archive, and where the first one begins."""
    head = bytes(archive[:8])
    if head[:4] != SKIPPABLE:
        return zstandard.ZstdDecompressor(), 0
    end = 8 + struct.unpack("<I", head[4:])[0]
    shared = bytes(archive[8:end])
    if shared[:4] == FRAME:  # a dictionary may itself be compressed
        shared = zstandard.ZstdDecompressor().decompress(shared)
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(shared)), end


def _parse(data: bytes, at: int = 0) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, in lower case, and block of every record from ``at`` on."""
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/1."):
            raise ValueError(f"not a WARC record: {first[:40]}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(fields["content-length"])
        if data[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('warc-record-id')} ends early")
        yield fields, data[end + 4:end + 4 + size]
        at = end + 8 + size


def records_of(archive) -> Iterator[tuple[dict[str, str], bytes]]:
    unpack, start = _unpacker(archive)
    with unpack.stream_reader(memoryview(archive)[start:], read_across_frames=True) as frames:
        data = frames.readall()
    return _parse(data)


def fetch(archive, offset: int) -> tuple[dict[str, str], bytes]:
    """The one record whose frame begins at ``offset``; no other frame is decompressed."""
    unpack, _ = _unpacker(archive)
    return next(_parse(unpack.decompress(memoryview(archive)[offset:], allow_extra_data=True)))


def page_of(fields: dict[str, str], block: bytes) -> tuple | None:
    """The row of RECORDS of a record; None for kinds that hold no page. A payload must have the digest its header states."""
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if digest(payload) != stated:
            raise ValueError(f"payload of {fields['warc-record-id']} has changed")
        size = len(payload)
    else:
        payload, size = None, int(re.search(rb"(?mi)^content-length:\s*(\d+)", head)[1])
    first = fields.get("warc-refers-to")
    return key_of(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, size, stated, first and key_of(first), payload


def with_firsts(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int) -> DataFrame:
    """k, u, size, sha1 (in hex), first, t of every row: ``first`` is the id, as text, that a revisit refers to, and then t is null."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("u"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.unhex(F.lit(""))).alias("t"))
    rows = rows.withColumns({"size": F.octet_length("t").cast("long"), "sha1": F.sha1("t")})
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"))
    again = rows.filter(F.col("size") >= least).groupBy("sha1", "size").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    again = written(again.filter("n > 1").select("sha1", "size", F.col("first.id").alias("first")))
    joined = rows.join(again.withColumn("shared", F.lit(True)), ["sha1", "size"], "left")
    revisits = F.coalesce(F.col("shared"), F.lit(False)) & ~F.col("id").eqNullSafe(F.col("first"))
    return joined.select(F.col("id").cast("string").alias("k"), "u", "size", "sha1", F.when(revisits, F.col("first").cast("string")).alias("first"),
                         F.when(~revisits, F.col("t")).alias("t"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0,
          date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Archives of ``pages`` into a Parquet folder at ``path``: one record per row.

    A null payload is empty; text is written as UTF-8. Rows with equal payloads of ``least`` bytes or more refer to
    the row with the smallest id (a null id is larger than all others); rows that share that smallest id are all responses, and a payload
    shorter than ``least`` is always one. Repeated rows are one record each. A null address is left out; blanks and control
    characters in one are percent-encoded. Other columns are not read. An empty table gives no archive. A task holds one
    archive's records, or one longer record, at a time.
    """
    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            archive, offsets = build_archive(held, date)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(held)], pa.int64()),
                                               pa.array([offsets], pa.list_(pa.int64())), pa.array([archive], pa.binary())],
                                              ["part", "seq", "n_records", "offsets", "archive"])

        for batch in batches:
            keys, urls, sizes, sums, firsts = (batch.column(i).to_pylist() for i in range(5))
            for i, payload in enumerate(batch.column(5)):
                sha1 = base64.b32encode(bytes.fromhex(sums[i])).decode()
                held.append(page_record(keys[i], urls[i], payload.as_py(), sizes[i], sha1, firsts[i], date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield close()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield close()

    rows = with_firsts(pages, id_col, url_col, payload_col, least)
    rows.mapInArrow(archives, ARCHIVES).write.option("compression", "uncompressed").parquet(path)


def records(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """RECORDS of the archives in binary column ``archive``, without the payloads if so asked. Revisits have no payload."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORDS.split(", ")]
        types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        for batch in batches:
            for archive in batch.column(0):
                rows, size = [], 0
                for fields, block in records_of(archive.as_buffer()):
                    row = page_of(fields, block)
                    if row:
                        rows.append(row if payloads else (*row[:6], None))
                        size += 200 + len(row[6] or b"") * payloads
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    found = archives.select("archive").mapInArrow(work, RECORDS)
    return found if payloads else found.drop("payload")


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """RECORDS of the archives that ``write`` made."""
    return records(spark.read.schema(ARCHIVES).parquet(path), payloads)


def resolved(found: DataFrame) -> DataFrame:
    """RECORDS with the payload of its response in every revisit."""
    first = found.filter("record_type = 'response'").select(F.col("id").alias("_id"), F.col("payload").alias("_payload")).dropDuplicates(["_id"])
    joined = found.join(first, F.col("refers_to") == F.col("_id"), "left")
    return joined.withColumn("payload", F.coalesce("payload", "_payload")).drop("_id", "_payload")


def export(archives: DataFrame, folder: str) -> DataFrame:
    """Each archive as a file ``<part>-<seq>.warc.zst`` under ``folder``, a path or URI that executors share. Gives
    name and bytes of the files. A file gets its name when it is whole, so a task that runs twice leaves one."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        for batch in batches:
            for part, seq, archive in zip(*(batch.column(i) for i in range(3)), strict=True):
                name, image = f"{part.as_py():05d}-{seq.as_py():05d}.warc.zst", archive.as_buffer()
                unfinished = f"{root}/.{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(unfinished) as out:
                    out.write(image)
                store.move(unfinished, f"{root}/{name}")
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(image)], pa.int64())], ["name", "bytes"])

    return archives.select("part", "seq", "archive").mapInArrow(work, "name string, bytes long")


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SQL = f"""
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h FROM p),
    r AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
    SELECT page_id, payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('{_ALPHABET}',
               (((('0x' || substr(h, (5 * (i // 4) + 1)::integer, 5))::bigint >> (15 - 5 * (i % 4))::integer) & 31) + 1)::integer, 1)), '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM r"""
