"""SentencePiece encoding and decoding by suffix-array matching.

The words of a batch that are not known yet are joined into one text, whose suffixes are sorted by their first bytes. Every
piece of the vocabulary is found by binary search as a range of suffixes, which gives an edge from each place
where the piece occurs to the place where it ends. Edges are sorted by their end and relaxed in that order, for all
words at once.

Models that merge pairs (BPE) have no score of a whole path. What makes a path right there is that no merge could reach over
any of its borders, and it is enough to look at two pieces at a time: exactly one edge into a place has a piece that
stays apart from the last piece of the text before it. So an edge is taken if its two pieces, merged
together, come out as the same two pieces; the answers are kept in a table. Places that no piece covers are spelled in bytes.

A space begins a word and no piece has one inside, so words are encoded apart and known ones come from a bounded
cache. Words behind several spaces, where the order of merges of spaces counts, are merged directly.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from tradewind.llm.staging import free_name
from tradewind.llm.token_files import by_size, ranges

SPACE = "▁"
CACHED_WORDS = 100_000
_DEPTH = 32  # bytes by which suffixes are sorted; no piece but runs of spaces is longer
_TABLE_BITS = 22
_CHUNK = 2_500_000  # bytes of text at a time
_DECODED = 100_000  # ids at a time, or one longer text's
_UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class SuffixIndex:
    """The suffixes of a text in order of their first _DEPTH bytes."""

    def __init__(self, text: bytes):
        b = np.frombuffer(text + bytes(_DEPTH), np.uint8)
        n = len(text)
        key = np.zeros(len(b), np.uint64)
        for j in range(8):
            key[:len(b) - j] |= b[j:].astype(np.uint64) << np.uint64(56 - 8 * j)
        self.words = [np.ascontiguousarray(key[8 * w:8 * w + n]) for w in range(_DEPTH // 8)]
        rank = self._rank(key[:n])
        width = 8
        while True:
            behind = np.zeros(n, np.int64)
            behind[:max(n - width, 0)] = rank[width:] + 1
            joined = rank * (n + 1) + behind
            width *= 2
            if width >= _DEPTH:
                break
            rank = self._rank(joined)
        self.order = np.argsort(joined)
        self.first = self.words[0][self.order]

    @staticmethod
    def _rank(keys: np.ndarray) -> np.ndarray:
        order = np.argsort(keys)
        ordered = keys[order]
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]) if len(keys) else 0
        return rank

    def find(self, targets: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the suffixes that start with each target (rows of 8-byte words under ``masks``)."""
        if targets.shape[1] == 1:
            low = np.searchsorted(self.first, targets[:, 0])
            return low, np.searchsorted(self.first, targets[:, 0] | ~masks[:, 0], side="right")
        return self._bound(targets, masks, False), self._bound(targets, masks, True)

    def _bound(self, targets: np.ndarray, masks: np.ndarray, after: bool) -> np.ndarray:
        low, high = np.zeros(len(targets), np.int64), np.full(len(targets), len(self.order))
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            at = self.order[np.minimum(mid, len(self.order) - 1)]
            smaller, equal = np.zeros(len(targets), bool), np.ones(len(targets), bool)
            for w in range(targets.shape[1]):
                have = self.words[w][at] & masks[:, w]
                smaller |= equal & (have < targets[:, w])
                equal &= have == targets[:, w]
            right = open_ & (smaller | (equal if after else False))
            low, high = np.where(right, mid + 1, low), np.where(open_ & ~right, mid, high)
        return low


class Pieces:
    """Encoder and decoder for a SentencePiece BPE model with byte fallback and no normalization."""

    def __init__(self, path: str, most: int = CACHED_WORDS):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        text = [model.id_to_piece(i) for i in range(self.size)]
        self.byte_ids = np.zeros(256, np.int32)
        special = set()
        for i, piece in enumerate(text):
            if model.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
            if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                special.add(i)
        self.text, self.special = text, special
        self.ids = {p: i for i, p in enumerate(text) if i not in special}
        self.rank = {p: -model.get_score(i) for p, i in self.ids.items()}
        self.is_byte = np.zeros(self.size + 1, bool)
        self.is_byte[self.byte_ids] = True
        self.begin = self.size
        # pieces to search for, by number of 8-byte words
        searched = [(p.encode(), i) for p, i in self.ids.items() if SPACE * 2 not in p]
        if any(len(raw) > _DEPTH for raw, _ in searched):
            raise ValueError(f"a piece has more than {_DEPTH} bytes")
        self.groups = []
        for words in range(1, _DEPTH // 8 + 1):
            group = [(raw, i) for raw, i in searched if -(-len(raw) // 8) == words]
            if group:
                fill = [raw.ljust(8 * words, b"\0") for raw, _ in group]
                ones = [(b"\xff" * len(raw)).ljust(8 * words, b"\0") for raw, _ in group]
                as_words = lambda rows, n=words: np.frombuffer(b"".join(rows), ">u8").reshape(-1, n).astype(np.uint64)
                self.groups.append((as_words(fill), as_words(ones), np.array([i for _, i in group], np.int32),
                                    np.array([len(raw) for raw, _ in group], np.int64)))
        self.single = np.zeros(self.size, bool)
        self.single[[i for p, i in self.ids.items() if len(p) == 1]] = True
        self.table_keys = np.full(1 << _TABLE_BITS, -1, np.int32 if (self.size + 1) ** 2 < 1 << 31 else np.int64)
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.most, self.known = most, {}
        raw = [bytes([int(p[3:-1], 16)]) if self.is_byte[i] else b"" if i in special else p.replace(SPACE, " ").encode() for i, p in enumerate(text)]
        self.raw, self.raw_sizes = np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw], np.int64)

    # merging

    def _merged(self, text: str) -> list[str]:
        """A short text, merged pair by pair."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                rank = self.rank.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _merged_long(self, text: str) -> list[str]:
        """The same with a queue of pairs, for texts of any length."""
        parts: list[str | None] = list(text)
        before, behind = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        queue: list[tuple[float, int, str, str]] = []

        def offer(i: int) -> None:
            j = behind[i]
            if i >= 0 and j < len(parts):
                rank = self.rank.get(parts[i] + parts[j])
                if rank is not None:
                    heapq.heappush(queue, (rank, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = behind[i]
            if parts[i] != a or j >= len(parts) or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            behind[i] = behind[j]
            if behind[j] < len(parts):
                before[behind[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def _ids_of(self, parts: list[str]) -> np.ndarray:
        out: list[int] = []
        for p in parts:
            i = self.ids.get(p)
            out += [i] if i is not None else self.byte_ids[np.frombuffer(p.encode(), np.uint8)].tolist()
        return np.array(out, "<i4")

    # the graph

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two neighbours stay two pieces. Bytes stand for characters without a piece, over which nothing merges."""
        right_byte = self.is_byte[right]
        left = np.where(self.is_byte[left], self.begin, left)
        key = left.astype(np.int64) * self.size + right
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        unknown = np.flatnonzero((self.table_keys[slot] != key) & ~right_byte)
        out = self.table[slot]
        if len(unknown):
            keys, back = np.unique(key[unknown], return_inverse=True)
            answers = np.empty(len(keys), bool)
            for n, (a, b) in enumerate(zip((keys // self.size).tolist(), (keys % self.size).tolist(), strict=True)):
                pair = [self.text[b]] if a == self.begin else [self.text[a], self.text[b]]
                answers[n] = self._merged("".join(pair)) == pair
            out[unknown] = answers[back]
            self.table_keys[slot[unknown]], self.table[slot[unknown]] = key[unknown], answers[back]
        return out | right_byte

    def _edges(self, text: bytes, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, size and piece of every edge: matches of pieces, and bytes of characters without one."""
        index = SuffixIndex(text)
        starts, sizes, pieces = [], [], []
        for targets, masks, ids, lengths in self.groups:
            low, high = index.find(targets, masks)
            count = high - low
            starts.append(index.order[ranges(low, count)])
            sizes.append(np.repeat(lengths, count))
            pieces.append(np.repeat(ids, count))
        start, size, piece = map(np.concatenate, (starts, sizes, pieces))
        b = np.frombuffer(text, np.uint8)
        lead = (b & 0xC0) != 0x80
        character = np.cumsum(lead) - 1
        covered = np.zeros(character[-1] + 1, bool)
        covered[character[start[self.single[piece]]]] = True
        bare = np.flatnonzero(~covered[character] & in_word)
        return (np.concatenate([start, bare]), np.concatenate([size, np.ones(len(bare), np.int64)]),
                np.concatenate([piece, self.byte_ids[b[bare]]]))

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, none of which has a space but at its start."""
        raw = [w.encode("utf-8", "replace") for w in words]
        text = b"\xff".join(raw) + b"\xff"
        sizes = np.array([len(r) for r in raw], np.int64)
        ends = np.cumsum(sizes + 1) - 1
        begins = ends - sizes
        in_word = np.ones(len(text), bool)
        in_word[ends] = False
        start, size, piece = self._edges(text, in_word)
        word_begin = np.repeat(begins, sizes + 1)
        reach = start + size - word_begin[start]
        small = reach.astype(np.uint16) if len(reach) and reach.max() < 1 << 16 else reach
        order = np.argsort(small, kind="stable")
        start, size, piece = start[order], size[order], piece[order]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(reach))])
        last, back = np.full(len(text) + 1, -1, np.int32), np.zeros(len(text) + 1, np.int64)
        last[begins] = self.begin
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if a == b:
                continue
            s, p = start[a:b], piece[a:b]
            before = last[s]
            live = before >= 0
            s, p, end = s[live], p[live], s[live] + size[a:b][live]
            good = self._apart(before[live], p)
            last[end[good]], back[end[good]] = p[good], s[good]
        # walk back from all ends at once
        which, at, found, owner = np.arange(len(words)), ends.copy(), [], []
        while len(which):
            go = at > begins[which]
            which, at = which[go], at[go]
            found.append(last[at])
            owner.append(which)
            at = back[at]
        found, owner = np.concatenate(found)[::-1], np.concatenate(owner)[::-1]
        ids = found[np.argsort(owner, kind="stable")].astype("<i4").tobytes()
        stops = (4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()
        return [ids[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    # texts

    def _learn(self, units: list[str]) -> None:
        if len(self.known) > self.most:
            self.known = {}
        new = [u for u in units if u not in self.known]
        many = [u for u in new if u.startswith(SPACE * 2)]
        if many:
            self.known.update((u, self._ids_of(self._merged_long(u)).tobytes()) for u in many)
            new = [u for u in new if not u.startswith(SPACE * 2)]
        size, part = 0, []
        for u in new:
            part.append(u)
            size += len(u)
            if size > 400_000:
                self.known.update(zip(part, self._encode_words(part), strict=True))
                size, part = 0, []
        if part:
            self.known.update(zip(part, self._encode_words(part), strict=True))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has. A null text is empty."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")
        odd = pc.or_(pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")), pc.or_(pc.match_substring(texts, "  "), pc.equal(texts, "")))
        split = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        coded = split.flatten().dictionary_encode()
        distinct = [SPACE + w if w else "" for w in coded.dictionary.to_pylist()]
        which, offsets = coded.indices.to_numpy(), split.offsets.to_numpy()
        offsets = offsets - offsets[0]
        # texts with more than single spaces between words are split here; only their own words are listed
        place = {u: i for i, u in enumerate(distinct)}
        if odd_rows := np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            lists, at = [], 0
            for row in odd_rows:
                units = _UNITS.findall(SPACE + t.replace(" ", SPACE)) if (t := texts[row].as_py()) else []
                lists += [which[at:offsets[row]], np.array([place.setdefault(u, len(place)) for u in units], which.dtype)]
                at = offsets[row + 1]
            sizes = np.diff(offsets)
            sizes[odd_rows] = [len(x) for x in lists[1::2]]
            which, offsets = np.concatenate([*lists, which[at:]]), np.concatenate([[0], np.cumsum(sizes)])
        distinct = list(place)
        self._learn([u for u in distinct if u])
        found = [self.known[u] if u else b"" for u in distinct]
        pool, sizes = np.frombuffer(b"".join(found), "<i4"), np.array([len(f) >> 2 for f in found], np.int64)
        counts = np.concatenate([[0], np.cumsum(sizes[which])])
        return pool[ranges((np.cumsum(sizes) - sizes)[which], sizes[which])], np.diff(counts[offsets])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of some id lists, one after the other in ``ids``."""
        ends, texts, a = np.cumsum(counts), [], 0
        while a < len(counts):  # every byte takes several numbers, so some lists at a time
            start = int(ends[a] - counts[a])
            b = max(a + 1, int(np.searchsorted(ends, start + _DECODED, "right")))
            texts += self._decode(ids[start:ends[b - 1]], counts[a:b])
            a = b
        return texts

    def _decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        sizes = self.raw_sizes[ids]
        raw = self.raw[ranges((np.cumsum(self.raw_sizes) - self.raw_sizes)[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        texts = (raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True))
        return [t[1:] if t.startswith(" ") else t for t in texts]


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One per worker process, so that its caches serve all of the worker's tasks."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "pieces") -> DataFrame:
    """``docs`` with, behind its columns, ``ids_col`` (array of piece ids), n_pieces, ids_crc32 and round_trip.

    ids_crc32 is over the ids as little-endian unsigned 32-bit numbers; round_trip says whether decoding them gives the text
    back (a U+2581 in a text comes back as the space it stands for, which counts as equal). A null or empty text has no
    pieces. Whole texts of any length are encoded. The new columns get underscores in front where ``docs`` has such
    names; repeated rows give repeated results; an empty table an empty one. Nothing is shuffled.
    """
    names = [free_name(docs, c) for c in (ids_col, "n_pieces", "ids_crc32", "round_trip")]
    columns, at = [*docs.columns, *names], docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            texts = batch.column(at)
            for a, b in by_size(texts, _CHUNK):
                part = batch.slice(a, b - a)
                own = part.column(at)
                ids, counts = model(own)
                ends = np.concatenate([[0], np.cumsum(counts)])
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[x:y]) for x, y in zip(ends[:-1], ends[1:], strict=True)]
                plain = pc.replace_substring(pc.fill_null(own, ""), SPACE, " ")
                same = pc.equal(pa.array(model.decode(ids, counts), plain.type), plain)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(counts, pa.int64()), pa.array(crc, pa.int64()), same], columns)

    kinds = [ArrayType(IntegerType()), LongType(), LongType(), BooleanType()]
    schema = StructType([*docs.schema.fields, *[StructField(name, kind) for name, kind in zip(names, kinds, strict=True)]])
    return docs.mapInArrow(work, schema)
