"""Quality rules: text statistics of each document, and lines that too many documents of one host share.

Built-in functions only. The statistics look at whole texts inside a row; the line counts are one grouping that
combines before the shuffle, so neither a hot host nor a line in a third of all documents lands in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.line_windows import without_lines
from tradewind.llm.staging import free_name, written
from tradewind.llm.words import has_word, let, lines, n_words, normal_line, words

SYMBOLS = r"[#*$%&|<>]"


def _repeated(w: Column) -> Column:
    """Words inside a 3-word window that the text has twice or more (``w``: the words).

    Each window's 64-bit hash is cut to its high bits and joined with its position; sorted as plain numbers,
    equal windows are neighbours. Neighbours count as equal only if their whole hashes are.
    """
    none = F.lit(0).cast("long")
    n = F.size(w) - 2

    def positions(h: Column) -> Column:
        # coalesce: arrays known to hold no null are sorted as primitive numbers
        bits = F.coalesce(F.ceil(F.log2(F.size(h).cast("double") + 1)).cast("int"), F.lit(1))
        keys = F.transform(h, lambda x, i: _up(_down(x, bits), bits).bitwiseOR(i.cast("long")))
        at = let(F.sort_array(keys), lambda s: F.transform(s, lambda x: x.bitwiseAND(_up(none + 1, bits) - 1).cast("int")))
        return let(at, lambda p: let(F.transform(p, lambda i: F.get(h, i)), lambda g: F.filter(
            p, lambda i, j: (F.get(g, j) == F.get(g, j - 1)) | (F.get(g, j) == F.get(g, j + 1)))))

    def covered(f: Column) -> Column:
        steps = F.zip_with(f, F.slice(f, 2, F.size(f)), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, none, lambda total, x: total + x)

    hashes = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    # most texts repeat no window, which a hash set tells without sorting
    return F.when(n >= 2, let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none)
                              .otherwise(let(F.sort_array(positions(h)), covered)))).otherwise(none)


def _up(x: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", x, bits)


def _down(x: Column, bits: Column) -> Column:
    return F.call_function("shiftright", x, bits)


def statistics(text: Column) -> tuple[Column, Column, Column]:
    """Of a whole text (null: empty): a struct of n_words, word_chars and n_repeat_words; n_symbols; n_dup_lines."""
    counts = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeated(w).alias("n_repeat_words")))
    repeats = let(F.filter(lines(text), has_word), lambda k: F.size(k) - F.size(F.array_distinct(k)))
    symbols = F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0))
    return counts, symbols.cast("long"), repeats.cast("long")


def remove_frequent(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                    max_docs: int = 20) -> DataFrame:
    """``docs`` with the frequent lines of each host removed from its texts, plus n_frequent_lines: how many went.

    A line of a host is frequent if more than ``max_docs`` documents of the host have it (normalised, see
    ``normal_line``; each document counts once), however many documents the host has. Every row is a document, so
    repeated rows count as often as they occur. A null text stays null; rows without a host share the null host.
    Lines without a word stay. Other columns pass through; the new one gets underscores in front if ``docs`` has it.
    """
    removed = free_name(docs, "n_frequent_lines")
    key, mark, own, gone, at = (free_name(docs, f"_{n}") for n in ("key", "mark", "own", "gone", "at"))
    text, host = F.col(text_col), F.col(host_col).cast("string")
    line = F.transform(F.filter(lines(text), has_word), lambda x: F.xxhash64(normal_line(x)))
    read = written(docs.select(F.col(id_col).alias("k"), F.xxhash64(text).alias("m"), host.alias("host"), line.alias("lines")))
    frequent = read.select("host", F.explode(F.array_distinct("lines")).alias("h")) \
        .groupBy("host", "h").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") > max_docs)
    frequent = written(frequent.select(F.col("host").alias("f_host"), F.col("h").alias("f_h")))
    every = read.select("k", "m", "host", F.posexplode("lines").alias("pos", "h"))
    # rows of equal id, text and host lose the same lines
    hits = every.join(frequent, (every["h"] == frequent["f_h"]) & every["host"].eqNullSafe(frequent["f_host"])) \
        .groupBy("k", "m", "host").agg(F.collect_set("pos").alias("pos"))
    hits = hits.select(F.col("k").alias(key), F.col("m").alias(mark), F.col("host").alias(at), F.col("pos").alias(gone))
    marked = docs.withColumn(own, F.xxhash64(text))
    joined = marked.join(hits, marked[id_col].eqNullSafe(hits[key]) & (marked[own] == hits[mark])
                         & marked[host_col].cast("string").eqNullSafe(hits[at]), "left")
    return joined.select(
        *[F.when(F.col(gone).isNull(), text).otherwise(without_lines(text, F.col(gone))).alias(c) if c == text_col else docs[c]
          for c in docs.columns],
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(removed))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          min_words: int = 50, max_repeat_percent: int = 50, max_docs: int = 20,
          min_left: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: id, the statistics, n_frequent_lines, n_left_words, base_failed, kept, left_text.

    ``left_text`` is the text without frequent lines (see ``remove_frequent``); the statistics are those of the whole
    text. A document that keeps less than ``min_left`` of its words is depleted and rejected, as is one that fails
    the base rules. A null text is empty (and fails the base rules); other columns are not read. An empty table gives
    no rows.
    """
    counts, symbols, repeats = statistics(F.col("t"))
    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"), F.col(host_col).cast("string").alias("host"))
    left = remove_frequent(rows.select("k", "t", "host", counts.alias("w"), symbols.alias("n_symbols"), repeats.alias("n_dup_lines")),
                           "k", "t", "host", max_docs)
    left = left.select("k", "t", "w.*", "n_symbols", "n_dup_lines", "n_frequent_lines", n_words(F.col("t")).alias("n_left_words"))
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return left.select(
        F.col("k").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_frequent_lines",
        "n_left_words", base_failed.alias("base_failed"),
        (~base_failed & (F.col("n_left_words") >= min_left * F.col("n_words"))).alias("kept"), F.col("t").alias("left_text"))
