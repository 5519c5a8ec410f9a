"""Token ids in directly addressable codes.

A file holds the ids of whole documents. Every id is split into chunks of 8 bits. Level 0 has the low chunk of all
ids, level 1 the next chunk of those that go on, and so forth; a bitmap per level says which ids go on and a rank
directory counts the set bits before every 512th, so id number i is found by one lookup and one rank per level,
without decoding any other id. Layout, all numbers little-endian:

    magic "DACS", version u32, documents u32, levels u32, ids u64
    per document: id present u8, document id i64, first id u64 (relative to the file)
    per level: ids u64, chunk bytes, bitmap (bits in order, low bit first, padded to 64 bytes), rank u32 per 512 bits

Spark deals the documents out by range of id, tasks encode and write them in order, so a task holds one file of
about FILE_IDS ids at a time. Files are rows of a Parquet folder, which any store that Spark writes to can keep.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAGIC, VERSION, BLOCK = b"DACS", 1, 512
FILE_IDS = 1 << 18
CACHED_WORDS = 500_000
_HEAD, _DOC = struct.Struct("<4sIIIQ"), struct.Struct("<BqQ")
FILES = "part int, seq int, n_docs long, n_ids long, file binary"


def build_file(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """The file of some documents: their ids, how many token ids each has, and all token ids in order."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little").tobytes()
        bits += bytes(-len(bits) % (BLOCK // 8))
        ones = np.unpackbits(np.frombuffer(bits, np.uint8)).reshape(-1, BLOCK).sum(1, dtype=np.uint32)
        rank = np.concatenate([[0], np.cumsum(ones)])[:len(ones)].astype("<u4")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits + rank.tobytes())
        if not more.any():
            break
        rest = rest[more] >> 8
    firsts = np.concatenate([[0], np.cumsum(counts)])[:len(counts)]
    docs = b"".join(_DOC.pack(d is not None, d or 0, int(f)) for d, f in zip(doc_ids, firsts, strict=True))
    return _HEAD.pack(MAGIC, VERSION, len(doc_ids), len(levels), len(ids)) + docs + b"".join(levels)


class TokenFile:
    """Random access to one file."""

    def __init__(self, data: bytes):
        magic, version, n_docs, n_levels, self.n_ids = _HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token file of this version")
        at = _HEAD.size
        docs = [_DOC.unpack_from(data, at + i * _DOC.size) for i in range(n_docs)]
        self.doc_ids = [d if present else None for present, d, _ in docs]
        self.firsts = np.array([f for *_, f in docs] + [self.n_ids], np.int64)
        at += n_docs * _DOC.size
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            n_blocks = -(-n // BLOCK)
            chunk = np.frombuffer(data, np.uint8, n, at + 8)
            bits = np.frombuffer(data, np.uint8, n_blocks * BLOCK // 8, at + 8 + n)
            rank = np.frombuffer(data, "<u4", n_blocks, at + 8 + n + len(bits))
            self.levels.append((chunk, bits, rank))
            at += 8 + n + len(bits) + 4 * n_blocks

    def __getitem__(self, i: int) -> int:
        """Token id number ``i`` of the file."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value, shift = 0, 0
        for chunk, bits, rank in self.levels:
            value |= int(chunk[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            before = np.unpackbits(bits[block * BLOCK // 8:(i >> 3) + 1], bitorder="little")[:i - block * BLOCK]
            i, shift = int(rank[block]) + int(before.sum()), shift + 8
        return value

    def ids(self) -> np.ndarray:
        """All ids, level by level."""
        out = np.zeros(self.n_ids, np.uint32)
        at = np.arange(self.n_ids)
        for level, (chunk, bits, _) in enumerate(self.levels):
            out[at] |= chunk.astype(np.uint32) << (8 * level)
            at = at[np.unpackbits(bits, count=len(chunk), bitorder="little").astype(bool)]
        return out


Encoder = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]

# One run of letters that NFC and lower case treat one by one, and a run of punctuation behind it without apostrophes: the
# tokenizer's pattern always splits between the two, so their ids are those of the parts.
_PLAIN = r"""^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"""


class WordEncoder:
    """From texts (an Arrow array) to the ids of all and the number of each, by distinct words.

    For tokenizers that drop white space and split letters from punctuation before they merge: a word between ASCII
    white space is encoded apart, and a plain word as its letters and its punctuation, which gives the same ids. Words
    and parts are made distinct in Arrow; parts that the bounded cache does not hold are encoded in strings of
    some, each of which ends with its first token that ends in ``word_end``.
    """

    def __init__(self, path: str, word_end: str = "</w>", most: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith(word_end)]] = True
        self.known: dict[str, bytes] = {"": b""}

    def _encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for i in range(0, len(texts), 1_000):
            for e in self.tokenizer.encode_batch_fast(texts[i:i + 1_000], add_special_tokens=False):
                yield np.array(e.ids, "<u4")

    def _parts(self, parts: list[str], single: bool) -> list[bytes]:
        """Ids of each part; ``single``: the tokenizer never splits one before it merges."""
        if len(self.known) > self.most:
            self.known = {"": b""}
        new = [p for p in parts if p not in self.known]
        if new and single:
            ids = np.concatenate(list(self._encode([" ".join(new[i:i + 50]) for i in range(0, len(new), 50)])))
            ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            raw = ids.tobytes()
            self.known.update(zip(new, [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
        elif new:
            self.known.update(zip(new, (ids.tobytes() for ids in self._encode(new)), strict=True))
        return [self.known[p] for p in parts]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words, which = coded.dictionary, coded.indices.to_numpy()
        match = pc.extract_regex(words, _PLAIN)
        plain = match.is_valid().to_numpy(zero_copy_only=False)
        letters = pc.utf8_lower(pc.struct_field(match.filter(plain), "letters")).dictionary_encode()
        marks = pc.struct_field(match.filter(plain), "marks").dictionary_encode()
        other = words.filter(pa.array(~plain)).to_pylist()
        parts = [*self._parts(letters.dictionary.to_pylist(), True), *self._parts(marks.dictionary.to_pylist(), True),
                 *self._parts(other, False), b""]
        sizes = np.array([len(p) >> 2 for p in parts], np.int64)
        starts, pool = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(parts), "<u4")
        # two parts of every word, the second one empty for words that are not plain
        two = np.full((len(words), 2), len(parts) - 1)
        n = len(letters.dictionary)
        two[plain, 0], two[plain, 1] = letters.indices.to_numpy(), n + marks.indices.to_numpy()
        two[~plain, 0] = n + len(marks.dictionary) + np.arange(len(other))
        pool, sizes = pool[ranges(starts[two].ravel(), sizes[two].ravel())], sizes[two].sum(1)
        counts = np.concatenate([[0], np.cumsum(sizes[which])])
        offsets = split.offsets.to_numpy()
        return pool[ranges((np.cumsum(sizes) - sizes)[which], sizes[which])], np.diff(counts[offsets - offsets[0]])


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (size numbers) of every range, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """One per worker process, so that its cache serves all of the worker's tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def by_size(texts: pa.Array, most: int = 16_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes, or of one longer text."""
    sizes, start, size = pc.fill_null(pc.binary_length(texts), 0).to_pylist(), 0, 0
    for i, n in enumerate(sizes):
        size += n
        if size >= most or i + 1 == len(sizes):
            yield start, i + 1
            start, size = i + 1, 0


def write(docs: DataFrame, path: str, encoder: Callable[[], Encoder], end_id: int | None,
          id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS) -> None:
    """Writes the ids of every text, each with ``end_id`` behind, in ascending order of document id.

    ``encoder()`` is called in the tasks. A null text is empty; a null document id comes first; equal document ids are
    ordered by a hash of the text. A document is never split, so a file is as long as its longest document where that
    has more than ``file_ids`` ids. Other columns are not read. An empty table gives no file.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                       F.xxhash64(F.col(text_col)).alias("m"))
    rows = rows.repartitionByRange("k", "m").sortWithinPartitions("k", "m")

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode, tail = TaskContext.get().partitionId(), encoder(), np.array([] if end_id is None else [end_id], np.uint32)
        seq, keys, counts, held, n = 0, [], [], [], 0

        def close() -> pa.RecordBatch:
            file = build_file(keys, counts, np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(keys)], pa.int64()),
                                               pa.array([n], pa.int64()), pa.array([file], pa.binary())], ["part", "seq", "n_docs", "n_ids", "file"])

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in by_size(texts):
                ids, sizes = encode(texts.slice(a, b - a))
                at = 0
                for name, size in zip(names[a:b], sizes.tolist(), strict=True):
                    keys.append(name)
                    counts.append(size + len(tail))
                    held += [ids[at:at + size], tail]
                    at, n = at + size, n + size + len(tail)
                    if n >= file_ids:
                        yield close()
                        seq, keys, counts, held, n = seq + 1, [], [], [], 0
        if keys:
            yield close()

    rows.select("k", "t").mapInArrow(files, FILES).write.parquet(path)


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files: id, start (ids of all documents before it), n_tokens, ids_crc32.

    ids_crc32 is over the document's ids as little-endian unsigned 32-bit numbers.
    """
    files = spark.read.schema(FILES).parquet(path)
    # ids before each file: before its partition (one row per partition), and before it in the partition
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn(
        "part_start", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "part_start")
    starts = files.select("part", "seq", "n_ids").join(parts, "part").withColumn("file_start", F.col("part_start") + F.sum("n_ids").over(
        Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")).select("part", "seq", "file_start")

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, seq, data in zip(batch["part"], batch["seq"], batch["file"], strict=True):
                file = TokenFile(data)
                raw, firsts = file.ids().astype("<u4"), file.firsts
                yield pd.DataFrame({
                    "part": part, "seq": seq, "k": pd.array(file.doc_ids, dtype="Int64"), "first": firsts[:-1], "n_tokens": np.diff(firsts),
                    "ids_crc32": [zlib.crc32(raw[a:b]) for a, b in zip(firsts[:-1], firsts[1:], strict=True)]})

    found = files.select("part", "seq", "file").mapInPandas(
        documents, "part int, seq int, k long, first long, n_tokens long, ids_crc32 long")
    return found.join(starts, ["part", "seq"]).select(
        F.col("k").alias(id_col), (F.col("file_start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
