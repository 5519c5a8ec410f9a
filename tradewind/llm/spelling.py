"""Spelling variants by finite-state composition.

Two words are near if one inserted, deleted or replaced code point makes one of the other. The pairs of near words are what
V o E o V accepts, where V is the minimised acceptor of the vocabulary and E the transducer that copies, makes one
edit, and copies again. A state of the composition is (state of V for the one word, edits made, state of V for the other);
from a state without an edit one symbol of both words is copied, replaced, or inserted into the longer word, and from one with an edit only
symbols that both states of V have are copied. An inserted symbol must differ from the next one of the shorter word, so
every pair is accepted on one path only.

Spark deals the work out by initial state. A partition of the composition begins where both words have taken the same
first half (the edit is in the other half), or, for edits in the first half, holds words that end in the same half; lengths
of at most one apart are kept apart from others by the length of the shorter word. So a group is (length, window where the edit may be,
text left and right of it), and V is the acceptor of what its words have in the window. A group of more than ``most``
words gives way to two groups of half its window, again and again down to one place, where there are at most as many words
as there are symbols and pairs of symbols. A near pair has its edit in exactly one window.

States of V carry the number of words they accept, so that a path gives the place of its word in the sorted
group, and the composition is walked one symbol at a time for all groups of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.staging import written
from tradewind.llm.token_files import ranges

LETTERS = r"[A-Za-zÀ-ÿ]"
# words of groups that a task composes at once, and symbols of them when padded to the longest
BATCH_WORDS, BATCH_CELLS = 50_000, 8_000_000
KEY = ["shorter", "low", "high", "left", "right"]


class Acceptor:
    """The minimised acceptor of groups of words, each with an initial state of its own.

    ``words`` are sorted by code point inside their groups and distinct there; ``begins`` are the places where groups begin.
    """

    def __init__(self, words: list[str], begins: np.ndarray):
        sizes = np.array([len(w) for w in words])
        longest, n = int(sizes.max()), len(words)
        cells = np.full((n, longest + 1), -1, np.int32)
        rows = np.repeat(np.arange(n), sizes)
        cells[rows, ranges(np.zeros(n, np.int64), sizes)] = np.frombuffer("".join(words).encode("utf-32-le"), np.int32)
        unlike = np.ones((n, longest + 1), bool)
        unlike[1:] = cells[1:] != cells[:-1]
        shared = unlike.argmax(1)  # symbols in common with the word before
        shared[begins] = -1
        # nodes of the trie, by depth and then in order; a node is also the arc that leads to it
        now = np.cumsum(shared < 0) - 1
        parents, symbols, counts, levels = [np.full(len(begins), -1)], [np.full(len(begins), -1)], [np.bincount(now)], [0, len(begins)]
        finals = [np.bincount(now[sizes == 0], minlength=len(begins)) > 0]
        for depth in range(1, longest + 1):
            at = np.flatnonzero(sizes >= depth)
            new = shared[at] < depth
            ids = np.cumsum(new) - 1
            parents.append(now[at[new]])
            symbols.append(cells[at[new], depth - 1])
            counts.append(np.bincount(ids))
            finals.append(np.bincount(ids[sizes[at] == depth], minlength=len(counts[-1])) > 0)
            now[at] = ids + levels[-1]
            levels.append(levels[-1] + len(counts[-1]))
        parent, symbol, count, final = (np.concatenate(x) for x in (parents, symbols, counts, finals))
        height = np.zeros(len(parent), np.int64)
        for a, b in zip(levels[-2:0:-1], levels[:1:-1], strict=True):
            np.maximum.at(height, parent[a:b], height[a:b] + 1)
        children = np.bincount(parent[len(begins):], minlength=len(parent))
        first = len(begins) + np.cumsum(children) - children  # children of a node are side by side
        self._merge(symbol, count, final, height, children, first, len(begins))
        self.initial, self.begins = self.state[:len(begins)], begins

    def _merge(self, symbol, count, final, height, children, first, n_roots) -> None:
        """Makes one state of all nodes with equal finality and equal arcs, from the ends of the words inwards."""
        state, made, kept = np.zeros(len(symbol), np.int64), 0, []
        order = np.argsort(height, kind="stable")
        for nodes in np.split(order, np.flatnonzero(np.diff(height[order])) + 1):
            name, spare = final[nodes].astype(np.int64), 2
            for j in range(int(children[nodes].max())):
                more = np.flatnonzero(children[nodes] > j)
                child = first[nodes[more]] + j
                _, arc = np.unique(symbol[child] * (len(state) + 1) + state[child], return_inverse=True)
                _, both = np.unique(name[more] * len(state) + arc, return_inverse=True)
                name[more] = both + spare
                spare += len(more)
            _, one, same = np.unique(name, return_index=True, return_inverse=True)
            state[nodes] = same + made
            made += len(one)
            kept.append(nodes[one])
        node = np.concatenate(kept)
        self.state, self.final, self.arcs = state, final[node], children[node]
        arc = ranges(first[node], self.arcs)
        self.first = np.cumsum(self.arcs) - self.arcs
        self.symbol, self.to = symbol[arc], state[arc]
        # words of a state before those of an arc
        before = np.cumsum(count[arc]) - count[arc]
        own = np.repeat(np.arange(len(node)), self.arcs)
        self.skip = before - before[self.first[own]] + self.final[own] if len(arc) else before
        self.key = own * (1 << 21) + self.symbol

    def out(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arcs of each state, and which of ``states`` each is of."""
        n = self.arcs[states]
        return ranges(self.first[states], n), np.repeat(np.arange(len(states)), n)

    def near(self, widths: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of near words: those of words as long as the group's width, and of their longer or equally long partners.
        Of two words of that length the one with the smaller replaced symbol is first. Only in groups that are ``last``, whose
        window ends where the words end, may a symbol be inserted at the end; elsewhere that is a place of the next window."""
        group = np.arange(len(self.begins))
        same = np.stack([self.initial, self.begins, group])  # no edit yet: state, place of its first word, group
        edited = np.zeros((6, 0), np.int64)  # state and place of both, symbol that must not come next, group
        depth = 0
        while same.shape[1] or edited.shape[1]:
            arc, row = self.out(same[0])
            q, place, g = same[:, row]
            here = (widths[g] > depth) | last[g]
            inserted = np.stack([q, place, self.to[arc], place + self.skip[arc], self.symbol[arc], g])[:, here]
            edited = np.concatenate([edited, inserted], axis=1)
            ended = widths[edited[5]] == depth
            both = ended & self.final[edited[0]] & self.final[edited[2]]
            if both.any():
                yield edited[1, both], edited[3, both]
            edited = edited[:, ~ended]
            # both take the symbols they share
            a, row = self.out(edited[0])
            q1, r1, q2, r2, barred, g1 = edited[:, row]
            wanted = q2 * (1 << 21) + self.symbol[a]
            b = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            go = np.flatnonzero((self.key[b] == wanted) & (self.symbol[a] != barred)) if len(a) else np.zeros(0, np.int64)
            a, b = a[go], b[go]
            copied = np.stack([self.to[a], r1[go] + self.skip[a], self.to[b], r2[go] + self.skip[b], np.full(len(go), -1), g1[go]])
            # a symbol is replaced by a later one of the same state
            on = widths[g] > depth
            arc, q, place, g = arc[on], q[on], place[on], g[on]
            later = self.first[q] + self.arcs[q] - arc - 1
            one, other = np.repeat(arc, later), ranges(arc + 1, later)
            place2, g2 = np.repeat(place, later), np.repeat(g, later)
            replaced = np.stack([self.to[one], place2 + self.skip[one], self.to[other], place2 + self.skip[other], np.full(len(one), -1), g2])
            same = np.stack([self.to[arc], place + self.skip[arc], g])
            edited = np.concatenate([copied, replaced], axis=1)
            depth += 1


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 1) -> DataFrame:
    """id, run of every longest run of letters of ``least`` or more in the whole texts, with A to Z as a to z. A null text has none."""
    found = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{least},}}"), 0))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return docs.select(F.col(id_col).alias("id"), found.alias("run")).select("id", F.translate("run", upper, upper.lower()).alias("run"))


def vocabulary(words: DataFrame, least_length: int = 7, least_count: int = 2) -> DataFrame:
    """word, n of the words (column ``word``) long and frequent enough; null is no word."""
    return words.filter(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _halves(rows: DataFrame) -> DataFrame:
    """Every row once for each half of its window."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    parts = F.array(F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), "high"))
    return rows.select("word", "n", "size", "shorter", F.inline(parts))


def _keyed(rows: DataFrame) -> DataFrame:
    behind = F.col("shorter") - F.col("high")
    word = F.col("word")
    return rows.select("word", "n", "size", "shorter", "low", "high", F.substr(word, F.lit(1), F.col("low")).alias("left"),
                       F.substr(word, F.col("size") - behind + 1, behind).alias("right"),
                       F.substr(word, F.col("low") + 1, F.col("size") - behind - F.col("low")).alias("middle"))


def _windows(vocabulary: DataFrame, most: int) -> DataFrame:
    """word, n, size, shorter, low, high: each word with the windows of its groups, none of which has more than ``most``
    words unless its window is one place."""
    sizes = vocabulary.agg(F.min(F.char_length("word"))).first()[0]
    rows = vocabulary.withColumn("size", F.char_length("word"))
    rows = rows.select("*", F.explode(F.array("size", F.col("size") - 1)).alias("shorter")).filter(F.col("shorter") >= (sizes or 0))
    rows = _halves(rows.withColumns({"low": F.lit(0), "high": F.col("shorter")}))
    done = None
    while True:
        count = _keyed(rows).groupBy(*KEY).agg(F.count("*").alias("members"))
        large = written(count.filter((F.col("members") > most) & (F.col("high") - F.col("low") > 1)).select(*KEY, F.lit(True).alias("large")))
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        told = _keyed(rows).join(large, KEY, "left").select(*rows.columns, F.coalesce("large", F.lit(False)).alias("large"))
        told = written(told)
        small = told.filter(~F.col("large")).drop("large")
        done = small if done is None else done.unionByName(small)
        rows = _halves(told.filter("large").drop("large"))


def near_pairs(vocabulary: DataFrame, most: int = 20_000) -> DataFrame:
    """a, n_a, b, n_b for each unordered pair of near words of ``vocabulary`` (distinct word, n), once."""
    kept = _keyed(_windows(vocabulary, most))
    group = Window.partitionBy(*KEY).orderBy("middle")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # a group needs two words, one of them of the shorter length
    kept = kept.withColumns({"place": F.row_number().over(group), "members": F.count("*").over(whole),
                             "short": F.min("size").over(whole)}).filter("members > 1 AND short = shorter")
    kept = kept.select((F.col("place") == 1).alias("begins"), (F.col("high") - F.col("low")).alias("width"),
                       (F.col("high") == F.col("shorter")).alias("last"), "middle", "word", "n")

    def compose(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        begins = np.flatnonzero(rows["begins"].to_numpy())
        widths, last = rows["width"].to_numpy()[begins].astype(np.int64), rows["last"].to_numpy()[begins]
        word, n = rows["word"].combine_chunks(), rows["n"].combine_chunks()
        for a, b in Acceptor(rows["middle"].to_pylist(), begins).near(widths, last):
            for at in range(0, len(a), 100_000):
                i, j = pa.array(a[at:at + 100_000]), pa.array(b[at:at + 100_000])
                yield pa.RecordBatch.from_arrays([word.take(i), n.take(i), word.take(j), n.take(j)], ["a", "n_a", "b", "n_b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held else pa.Table.from_batches([batch])
            if len(held) < BATCH_WORDS and len(held) * max(held["width"].to_numpy().max(initial=0), 1) < BATCH_CELLS:
                continue
            # the last group may go on in the next batch
            last = int(np.flatnonzero(held["begins"].to_numpy())[-1])
            if last:
                yield from compose(held.slice(0, last))
                held = held.slice(last)
        if held:
            yield from compose(held)

    return kept.mapInArrow(work, "a string, n_a long, b string, n_b long")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of the chain from each word of ``forms`` (word, form). Chains must not close; each step halves them."""
    now = written(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = written(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if step.filter("moved").isEmpty():
            return step.drop("moved")
        now = step.drop("moved")


def variants(words: DataFrame, least_length: int = 7, least_count: int = 2, ratio: int = 10, most: int = 20_000) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``words`` (column ``word``, one row per occurrence) that is long and
    frequent enough.

    ``n_near`` counts its near words. ``form`` is the near word that occurs most often (of equally frequent ones the
    smallest in code-point order) if it occurs at least ``ratio`` times as often as the word, else null, as is ``form_n``, its n; ``root``
    is where forms lead from word to word, the word itself if it has no form. Null words are none; other columns are not read; an
    empty table gives no rows. ``ratio`` must be above 1, or forms could lead in circles.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    known = written(vocabulary(words, least_length, least_count))
    pairs = written(near_pairs(known, most))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near"))).alias("best"))
    known = known.join(best, "word", "left")
    has_form: Column = F.coalesce(-F.col("best.n") >= ratio * F.col("n"), F.lit(False))
    grouped = written(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("best.near")).alias("form"),
                                   F.when(has_form, -F.col("best.n")).alias("form_n")))
    ends = roots(grouped.filter("form IS NOT NULL"))
    return grouped.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
