"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of words that repeats with some smallest period and that no neighbouring word extends. Every stretch of
2^k words of a text (a basic factor) has a name; names of 2^(k+1) words are pairs of names of 2^k words, made equal
by one sort per level. In that sort the places of a factor come in order, so each place has its successor, the next
place of the same factor. Places of a factor of 2^k words within a window of twice that length form one
arithmetic progression, whose difference is a period of the words they cover: a successor at most 2^k words away
proposes that period. Places side by side with the same difference extend one another to the whole run. A run
that several levels propose is kept once.

A period q is seen at the level with q <= 2^k < 2 q, so that runs of three periods and more are all found. Places
whose factor occurs once in the text leave the dictionary, which for prose is nearly all of them after three levels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tradewind.llm.staging import free_name
from tradewind.llm.token_files import by_size


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words between ASCII white space, one text after the other, and where each text's words begin and end."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, offsets = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    # white space at the ends of a text leaves empty strings
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(full)])
    return flat.filter(pa.array(full)), before[offsets - offsets[0]]


def find_runs(names: np.ndarray, longest: int, exponent: int = 4, least: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every run of ``least`` words and ``exponent`` periods or more, by start and
    period. ``names`` are non-negative numbers, those of different texts different; ``longest`` is the longest text's length."""
    n = len(names)
    at, key = np.arange(n), names.astype(np.int64)
    found = [np.zeros((3, 0), np.int64)]
    width = 1
    while len(at):
        order = np.argsort(key, kind="stable")
        sorted_key, place = key[order], at[order]
        same = sorted_key[1:] == sorted_key[:-1]
        apart = np.diff(place)
        near = same & (apart <= width)
        if near.any():
            first, period = place[:-1][near], apart[near]
            by_place = np.argsort(first)
            first, period = first[by_place], period[by_place]
            begins = np.flatnonzero(np.concatenate([[True], (np.diff(first) != 1) | (np.diff(period) != 0)]))
            steps = np.diff(np.append(begins, len(first)))
            first, period = first[begins], period[begins]
            length = steps + period + width - 1
            long = (length >= least) & (length >= exponent * period)
            found.append(np.stack([first[long], length[long], period[long]]))
        if width >= longest // exponent:  # all periods that fit were seen
            break
        # names of the next level: pairs of names that both occur again
        again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        named = np.full(n + width, -1, np.int64)
        named[place[again]] = np.cumsum(np.concatenate([[0], ~same]))[again]
        at = np.sort(place[again])
        at = at[named[at + width] >= 0]
        key = named[at] * n + named[at + width]
        width *= 2
    start, length, period = np.concatenate(found, axis=1)
    _, once = np.unique(start * (n + 1) + period, return_index=True)
    return start[once], length[once], period[once]


def find(docs: DataFrame, text_col: str = "text", exponent: int = 4, least: int = 6) -> DataFrame:
    """``docs`` with three more columns: ``n_words``; ``runs``, the text's runs as (start, length, period) in words, numbered from
    0, by start and then period; and ``collapsed``, the words joined by one space without those that any run holds after
    its first period.

    Words are what ASCII white space separates. A run has at least ``least`` words and ``exponent`` (3 or more) periods. A null
    or empty text has no words and no runs, and is collapsed to an empty text. Rows are taken one by one, so repeated
    rows, ties and null ids need no rule; an empty table gives no rows. A column that has one of the new names already
    stays, and the new one gets underscores in front. A text is held whole by one task, in some 100 bytes per word.
    """
    if exponent < 3:
        raise ValueError("runs of fewer than three periods are not found at the level of their period")
    new = [free_name(docs, c) for c in ("n_words", "runs", "collapsed")]
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    column = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in by_size(batch.column(column), 4_000_000):
                part = batch.slice(a, b - a)
                words, ends = split_words(part.column(column))
                coded = words.dictionary_encode()
                sizes = np.diff(ends)
                text = np.repeat(np.arange(len(sizes)), sizes)
                names = text * max(len(coded.dictionary), 1) + coded.indices.to_numpy()
                start, length, period = find_runs(names, int(sizes.max(initial=0)), exponent, least)
                edges = np.zeros(len(words) + 1, np.int64)
                np.add.at(edges, start + period, 1)
                np.add.at(edges, start + length, -1)
                kept = np.cumsum(edges[:-1]) == 0
                left = np.concatenate([[0], np.cumsum(kept)])[ends]
                texts = pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(kept)))
                of = np.searchsorted(ends, start, "right") - 1
                rows = pa.StructArray.from_arrays([pa.array(start - ends[of]), pa.array(length), pa.array(period)], fields=list(run_type))
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(sizes) + 1)), pa.int32()), rows)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sizes), lists, pc.binary_join(texts, " ")], [*part.schema.names, *new])

    run = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
    kinds = (LongType(), ArrayType(run), StringType())
    return docs.mapInArrow(work, StructType([*docs.schema, *map(StructField, new, kinds)]))


def longest_run(runs) -> F.Column:
    """The run of greatest length, of these the one with the smallest start, then period; null where there is none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(best.isNotNull(), F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))
