"""Near duplicates by ProbMinHash.

A text is its five-word shingles, weighted by how often they occur. Every shingle is a Poisson process whose rate is its
weight; its arrivals fall into random registers, and each register keeps the shingle that arrived first. Two texts agree in a
register with the probability that is their probability Jaccard similarity. Arrivals are drawn in rounds, and a shingle
stops as soon as its next arrival is later than what every register has seen. Registers are banded, texts that share a band
are candidates, and candidates are verified by their exact similarity.

Equal word sequences are one node. First every member of a bucket is tested against the bucket's most central member alone,
which joins most near copies into classes. Then members that share a bucket but not a class are told apart: a task holds a block of
a bucket's texts, or two blocks, and tests their pairs, each pair in the first band it shares. No pair is a row, only links
are; but where a bucket holds many members that are not linked, the tests grow with the square of their number, as each has to be made
to lose no link. Most of them end at an upper bound of the similarity, from the counts of shingles in 448 cells; the bound is
exact, so it never drops a pair that is similar enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tradewind.llm.staging import free_name, released, written
from tradewind.llm.token_files import by_size
from tradewind.llm.words import words

# Shingles are counted in this many cells for the bound of a similarity.
CELLS = 448
# A block of a bucket holds about this many words, and this many texts at most.
BLOCK_WORDS, BLOCK_TEXTS = 1_000_000, 2_000
_CHUNK = 1_000_000  # bytes of text at a time

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD,
                         0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, size: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct shingles as sorted 64-bit hashes, and their counts.

    A text of fewer words is one shingle, a text without a word has none.
    """
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = split.flatten().dictionary_encode()
    hashed = pd.util.hash_array(np.array(coded.dictionary.to_pylist(), dtype=object), categorize=False) if len(coded) else np.array([], np.uint64)
    empty = pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False) if len(coded) else np.array([], bool)
    which, offsets = coded.indices.to_numpy(), split.offsets.to_numpy()
    offsets = offsets - offsets[0]
    word = hashed[which] if len(which) else np.array([], np.uint64)
    blank = empty[which] if len(which) else np.array([], bool)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        w = word[a:b]
        if b > a and (blank[a] or blank[b - 1]):  # white space at the ends leaves empty strings
            w = w[~blank[a:b]]
        n = max(len(w) - size + 1, min(len(w), 1))
        width = min(size, len(w))
        h = np.zeros(n, np.uint64)
        for j in range(width):
            h += _mix(w[j:j + n] + np.uint64(j)) * _MULTIPLIERS[j]
        out.append(np.unique(_mix(h + np.uint64(width)), return_counts=True))
    return out


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """The shingle in each register of each text; 0 for texts without shingles."""
    q = np.full(len(sets) * registers, np.inf)
    z = np.zeros(len(sets) * registers, np.uint64)
    if not sets:
        return z.reshape(0, registers)
    sizes = np.array([len(h) for h, _ in sets])
    text = np.repeat(np.arange(len(sets)), sizes)
    element = np.concatenate([h for h, _ in sets])
    rate = np.concatenate([c for _, c in sets]).astype(float)
    time = np.zeros(len(element))
    last = np.full(len(sets), np.inf)
    draw = 0
    while len(element):
        draw = (draw + 0x9E3779B97F4A7C15) % (1 << 64)
        bits = _mix(element + np.uint64(draw))
        time += -np.log(((bits >> np.uint64(24)) + np.uint64(1)) * 2.0**-40) / rate
        early = time < last[text]  # the others arrive after every register is taken, and so does all that follows
        if not early.all():
            element, rate, time, text, bits = element[early], rate[early], time[early], text[early], bits[early]
        at = text * registers + ((bits & np.uint64(0xFFFFFF)) * np.uint64(registers) >> np.uint64(24)).astype(np.int64)
        np.minimum.at(q, at, time)
        first = time <= q[at]
        z[at[first]] = element[first]
        alive = np.unique(text)
        last[alive] = q.reshape(-1, registers)[alive].max(1)
    return z.reshape(-1, registers)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard: the sum over common i of 1 / sum over all j of max(a_j / a_i, b_j / b_i)."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    _, in_a, in_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(in_a):
        return 0.0
    x, y = a[1][in_a].astype(float), b[1][in_b].astype(float)
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    ratio, group = np.unique(y / x, return_inverse=True)
    # a_j / a_i is the larger one where b_j / a_j is not above the ratio of i
    below = only_a + np.cumsum(np.bincount(group, x, len(ratio)))
    above = only_b + y.sum() - np.cumsum(np.bincount(group, y, len(ratio)))
    return float((1 / (below[group] / x + above[group] / y)).sum())


def node(text: Column) -> Column:
    """128-bit name of a word sequence."""
    return F.unhex(F.md5(F.array_join(words(text), " ")))


def _counts(sets: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: its shingles per cell, all its shingles, and whether none occurs twice."""
    cells = np.empty((len(sets), CELLS), np.int32)
    for row, (h, c) in zip(cells, sets, strict=True):
        row[:] = np.bincount((h % np.uint64(CELLS)).astype(np.int64), c, CELLS)
    return cells, cells.sum(1), np.array([int(c.max(initial=1)) == 1 for _, c in sets], bool)


def bound(cells: np.ndarray, totals: np.ndarray, once: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """What the similarity of text ``i`` and each of ``others`` is at most.

    They have no more in common than the sum over cells of the smaller count. Probability Jaccard is at most common / (n + m -
    common) if no shingle of either occurs twice, and common / min(n, m) in any case.
    """
    common = np.minimum(cells[others], cells[i]).sum(1)
    whole = np.where(once[others] & once[i], totals[others] + totals[i] - common, np.minimum(totals[others], totals[i]))
    return common / np.maximum(whole, 1)


def _banded(docs: DataFrame, bands: int, rows: int, size: int) -> DataFrame:
    """id, x (a hash of the text), u, bands, total of each row of ``docs`` (id, t): the hash of each band of the signature with its
    number, none without a word, and how many shingles there are."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3)
            for a, b in by_size(texts, _CHUNK):
                sets = shingles(texts.slice(a, b - a), size)
                parts = signatures(sets, bands * rows).reshape(len(sets), bands, rows)
                hashed = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sets), bands)).copy()
                for j in range(rows):
                    hashed = _mix(hashed * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
                lists = [h if len(s) else h[:0] for h, (s, _) in zip(hashed.view(np.int64), sets, strict=True)]
                total = pa.array([int(c.sum()) for _, c in sets], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, b - a) for c in batch.columns[:3]), pa.array(lists, pa.list_(pa.int64())), total], ["id", "x", "u", "bands", "total"])

    kind = docs.schema["id"].dataType.simpleString()
    named = docs.select("id", F.xxhash64("t").alias("x"), node(F.col("t")).alias("u"), "t")
    return named.mapInArrow(work, f"id {kind}, x long, u binary, bands array<long>, total long")


def _linked(pairs: DataFrame, texts: DataFrame, least: float, size: int) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = batch.column(2), batch.column(3)
            for a, b in by_size(other, _CHUNK):
                coded = one.slice(a, b - a).dictionary_encode()  # a text with many partners is read once
                left, right = shingles(coded.dictionary, size), shingles(other.slice(a, b - a), size)
                near = [similarity(left[i], r) >= least for i, r in zip(coded.indices.to_pylist(), right, strict=True)]
                yield pa.RecordBatch.from_arrays([c.slice(a, b - a).filter(pa.array(near, pa.bool_())) for c in (batch.column(0), batch.column(1))], ["a", "b"])

    # a centre with many partners comes last, when the rows are long and a skewed partition is seen and split
    full = pairs.join(texts.select(F.col("u").alias("b"), F.col("t").alias("tb")), "b")
    full = full.join(texts.select(F.col("u").alias("a"), F.col("t").alias("ta")), "a")
    return full.select("a", "b", "ta", "tb").mapInArrow(work, "a binary, b binary")


def links(h: int, blocks: np.ndarray, labels: np.ndarray, bands: np.ndarray, texts: list[str], least: float, size: int) -> list[tuple[int, int]]:
    """Pairs of members of bucket ``h`` that are similar enough, of one block or, where there are two, one of each. Members of one class
    are not compared, nor pairs that share an earlier band, nor members whose classes a link found here has joined."""
    return _links_of(h, blocks, labels, bands, shingles(pa.array(texts, pa.string()), size), least)


def _links_of(h: int, blocks: np.ndarray, labels: np.ndarray, bands: np.ndarray, sets: list[tuple[np.ndarray, np.ndarray]],
              least: float) -> list[tuple[int, int]]:
    """``links`` of texts whose shingles are ``sets``."""
    cells, totals, once = _counts(sets)
    labels, found = labels.copy(), []
    here = int(np.flatnonzero(bands[0] == h)[0])
    two = len(np.unique(blocks)) > 1
    for i in range(len(sets) - 1):
        others = np.arange(i + 1, len(sets))
        others = others[(labels[others] != labels[i]) & (not two or blocks[others] != blocks[i])]
        if here:
            others = others[~(bands[others, :here] == bands[i, :here]).any(1)]
        if len(others):
            others = others[bound(cells, totals, once, i, others) >= least - 1e-9]
        for j in others.tolist():
            if labels[j] != labels[i] and similarity(sets[i], sets[j]) >= least:
                found.append((i, j))
                labels[labels == labels[j]] = labels[i]
    return found


def _links_within(rows: DataFrame, least: float, size: int) -> DataFrame:
    """a, b of all links inside the groups (h, lo, hi) of ``rows`` (h, lo, hi, block, u, l, bands, t). Of a group a task holds the
    shingles, not the texts."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            key, block, u, l, bands, sets = zip(*held, strict=True)
            _, label = np.unique(np.array(l, dtype=object), return_inverse=True)
            pairs = _links_of(key[0][0], np.array(block), label, np.array(bands), list(sets), least)
            return pa.RecordBatch.from_arrays([pa.array([u[i] for i, _ in pairs], pa.binary()), pa.array([u[j] for _, j in pairs], pa.binary())], ["a", "b"])

        for batch in batches:
            for a, b in by_size(batch.column(7), _CHUNK):
                *columns, bands, texts = batch.slice(a, b - a).columns
                columns = [c.to_pylist() for c in columns]
                own = np.array(bands.to_pylist(), np.int64)
                sets = [(h, c.astype(np.int32)) for h, c in shingles(texts, size)]
                for key, *row in zip(zip(*columns[:3], strict=True), *columns[3:], own, sets, strict=True):
                    if held and held[-1][0] != key:
                        yield close()
                        held = []
                    held.append((key, *row))
        if held:
            yield close()

    dealt = rows.select("h", "lo", "hi", "block", "u", "l", "bands", "t").repartition("h", "lo", "hi").sortWithinPartitions("h", "lo", "hi")
    return dealt.mapInArrow(work, "a binary, b binary")


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """u, l for every node of ``edges`` (a, b) but the smallest of each component, which is l.

    Alternates between linking the larger neighbours of a node and the smaller ones to its smallest neighbour,
    so chains halve; each half step is a grouping and a join, written to the shared folder.
    """
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    seen = _state(now)
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = written(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        released(now, large)
        now, before, seen = after, seen, _state(after)
        if before == seen:
            return now.select("u", F.col("v").alias("l"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8, size: int = 5,
                    bands: int = 32, rows: int = 7) -> DataFrame:
    """One row per row of ``docs``: id, class_id, class_size, ``mark`` (the name of its word sequence) and ``first``
    (whether it is the row, or one of equal rows, that names the class).

    Texts are linked if the probability Jaccard of their counted shingles is ``least`` or more; classes are what links
    connect, and class_id is the smallest id in the class (a null id counts as the largest). Texts of equal words are always in
    one class; so are all texts without a word, null ones included. Repeated rows are in one class and count in its size. With
    32 bands of 7 a pair at 0.8 is a candidate with probability 0.9995, and with more above; every candidate pair is
    verified, in one class by other links, or below ``least`` by an exact bound. Other columns are not read; an empty table
    gives no rows.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    signed = written(_banded(slim, bands, rows, size))
    order = F.struct(F.col("id").isNull(), "id", "x")
    groups = written(signed.groupBy("u").agg(F.min(order).alias("rep"), F.count("*").alias("n"), F.first(F.struct("bands", "total")).alias("own"))
                     .select("u", F.col("rep.id").alias("rep"), F.col("rep.x").alias("rep_x"), "n", "own.*"))
    ids, names = written(signed.select("id", "u")), written(groups.select("u", "rep", "n"))
    released(signed)
    each = groups.select("u", F.explode("bands").alias("h"))
    members = written(each.withColumn("size", F.count("*").over(Window.partitionBy("h"))).filter("size > 1"))
    # who shares most bands with most others comes first: in a group of copies that is what they are copies of
    place = members.groupBy("u").agg((-F.sum("size")).alias("place"))
    nodes = written(groups.join(place, "u"))
    wanted = nodes.select("u", "rep", "rep_x")
    texts = slim.join(wanted, F.col("id").eqNullSafe(F.col("rep")) & (F.xxhash64("t") == F.col("rep_x")))
    texts = written(texts.select("u", "t").dropDuplicates(["u"]))
    released(groups)

    # all members of a bucket against its first one
    placed = members.select("h", "u").join(nodes.select("u", F.struct("place", "u").alias("order")), "u")
    head = placed.groupBy("h").agg(F.min("order").alias("head")).select("h", F.col("head.u").alias("a"))
    pairs = members.select("h", "u").join(head, "h").filter("u != a").select("a", F.col("u").alias("b")).distinct()
    edges = written(_linked(pairs, texts, least, size))
    labels = components(edges)

    # members of different classes, in blocks
    marked = written(members.select("h", "u").join(nodes.select("u", "total").join(labels, "u", "left").select("u", "total", F.coalesce("l", "u").alias("l")), "u"))
    open_ = marked.groupBy("h").agg(F.min("l").alias("lo"), F.max("l").alias("hi")).filter("lo != hi").select("h")
    weight = F.greatest(F.col("total") / BLOCK_WORDS, F.lit(1 / BLOCK_TEXTS))
    bucket = Window.partitionBy("h").orderBy("u")
    blocks = marked.join(open_, "h").withColumn("block", F.floor(F.sum(weight).over(bucket.rowsBetween(Window.unboundedPreceding, 0)) - weight))
    blocks = blocks.withColumn("last", F.max("block").over(bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    pairs = blocks.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).select(
        "h", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "block", "u", "l")
    more = written(_links_within(pairs.join(nodes.select("u", "bands"), "u").join(texts, "u"), least, size))
    if not more.isEmpty():
        labels = components(edges.unionAll(more))
    released(members, marked, nodes, texts)

    members = written(names.join(labels, "u", "left").select("u", "rep", "n", F.coalesce("l", "u").alias("l")))
    classes = members.groupBy("l").agg(F.min(F.struct(F.col("rep").isNull(), "rep", "u")).alias("least"), F.sum("n").alias("class_size"))
    members = members.join(classes, "l").select("u", F.col("least.rep").alias("class_id"), "class_size", (F.col("u") == F.col("least.u")).alias("named"))
    return ids.join(members, "u").select(
        F.col("id").alias(id_col), "class_id", "class_size", F.col("u").alias("mark"),
        (F.col("named") & F.col("id").eqNullSafe(F.col("class_id"))).alias("first"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each class: the one that gave the class its id.

    Of repeated rows one stays, and so does one of those rows of that id and word sequence that differ in other columns. Nulls, empty
    and very long texts, empty tables and clashing names are as in ``near_duplicates``; all columns of ``docs`` are kept.
    """
    mark, key, own = (free_name(docs, c) for c in ("_mark", "_key", "_own"))
    kept = near_duplicates(docs, id_col, text_col, **how).filter("first").select(F.col(id_col).alias(key), F.col("mark").alias(mark)).distinct()
    named = docs.withColumn(own, node(F.col(text_col)))
    out = named.join(kept, (named[own] == kept[mark]) & named[id_col].eqNullSafe(kept[key]))
    return out.dropDuplicates([own, id_col]).select(*docs.columns)
