"""Line deduplication by overlapping windows of three lines.

The lines with a word are hashed, every run of three consecutive ones is a window, and a window that occurred
before (by document id, then position) is a later occurrence. The positions that later occurrences cover are
merged and removed. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.staging import free_name, written
from tradewind.llm.words import BLANKS, has_word, let, lines

SIZE = 3


def _windows(text: Column) -> Column:
    """Hashes of the windows, in order; position i starts at the i-th line with a word."""
    hashes = F.transform(F.filter(lines(text), has_word), lambda x: F.xxhash64(F.btrim(x, F.lit(BLANKS))))
    return let(hashes, lambda h: F.when(F.size(h) >= SIZE, F.transform(
        F.sequence(F.lit(0), F.size(h) - SIZE), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(SIZE)])))
        .otherwise(F.array().cast("array<bigint>")))


def without_lines(text: Column, covered: Column) -> Column:
    """``text`` without the lines whose number among the lines with a word is in ``covered``."""
    def rest(all_lines: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(all_lines) - 1)
        numbered = F.filter(every, lambda i: has_word(F.get(all_lines, i)))
        gone = let(numbered, lambda n: F.transform(covered, lambda i: F.get(n, i)))
        return F.array_join(F.transform(F.array_except(every, gone), lambda i: F.get(all_lines, i)), "\n")

    return let(lines(text), rest)


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every line removed that a later occurrence of a window covers, plus n_lines and n_removed.

    Lines are compared trimmed; lines without a word neither count nor go. The first occurrence is the one with the
    smallest (id, text hash, position), a null id first; it keeps its lines even where a later occurrence in the
    same text overlaps it, so a run of equal lines shrinks to three. Rows with equal id and text are one document:
    each gets the same result. Texts of fewer than three lines with a word, empty and null texts stay as they are.
    Columns of ``docs`` pass through, and n_lines/n_removed get underscores in front if ``docs`` has such columns.
    An empty table gives an empty one.
    """
    total, removed = free_name(docs, "n_lines"), free_name(docs, "n_removed")
    key, mark, own, gone = (free_name(docs, f"_{n}") for n in ("key", "mark", "own", "gone"))
    text = F.col(text_col)
    found = docs.select(F.col(id_col).alias("k"), F.xxhash64(text).alias("m"), _windows(text).alias("w")).filter(F.size("w") > 0)
    found = written(found)
    each = found.select("k", "m", F.posexplode("w").alias("pos", "h"))
    first = each.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("k", "m", "pos")).alias("f")).filter("n > 1")
    first = written(first.select(F.col("h").alias("fh"), F.col("f.k").alias("fk"), F.col("f.m").alias("fm"), F.col("f.pos").alias("fpos")))
    same = F.col("k").eqNullSafe(F.col("fk")) & (F.col("m") == F.col("fm"))
    later = each.join(first, F.col("h") == F.col("fh")).filter(~(same & (F.col("pos") == F.col("fpos"))))
    start = F.when(same, F.greatest("pos", F.col("fpos") + SIZE)).otherwise(F.col("pos"))
    later = later.withColumn("start", start).filter(F.col("start") < F.col("pos") + SIZE)
    spans = later.groupBy("k", "m").agg(F.collect_set(F.struct("start", (F.col("pos") + SIZE - 1).alias("end"))).alias("spans"))
    merged = spans.select(F.col("k").alias(key), F.col("m").alias(mark), F.array_distinct(F.flatten(
        F.transform("spans", lambda s: F.sequence(s["start"], s["end"])))).alias(gone))
    marked = docs.withColumn(own, F.xxhash64(text))
    joined = marked.join(merged, marked[id_col].eqNullSafe(merged[key]) & (marked[own] == merged[mark]), "left")
    return joined.select(
        *[F.when(F.col(gone).isNull(), text).otherwise(without_lines(text, F.col(gone))).alias(c) if c == text_col else docs[c]
          for c in docs.columns],
        F.size(F.filter(lines(text), has_word)).cast("long").alias(total),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(removed))


# The same in SQL, on texts with unique ids: windows compared as texts instead of hashes.
SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM documents
), worded AS (
    SELECT doc_id, ln, trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS t,
           row_number() OVER (PARTITION BY doc_id ORDER BY ln) - 1 AS pos
    FROM lines WHERE trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') <> ''
), windows AS (
    SELECT doc_id, pos, t || chr(10) || lead(t, 1) OVER d || chr(10) || lead(t, 2) OVER d AS w FROM worded
    WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), firsts AS (
    SELECT *, first_value(doc_id) OVER o AS fdoc, first_value(pos) OVER o AS fpos FROM windows WHERE w IS NOT NULL
    WINDOW o AS (PARTITION BY w ORDER BY doc_id, pos)
), spans AS (
    SELECT doc_id, CASE WHEN fdoc = doc_id THEN greatest(pos, fpos + 3) ELSE pos END AS a, pos + 2 AS b
    FROM firsts WHERE NOT (doc_id = fdoc AND pos = fpos)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS pos FROM spans WHERE a <= b
), kept AS (
    SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.ln) AS text
    FROM lines l LEFT JOIN worded w ON w.doc_id = l.doc_id AND w.ln = l.ln
    LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.pos = w.pos WHERE g.pos IS NULL GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       (SELECT count(*) FROM worded w WHERE w.doc_id = d.doc_id) AS n_lines,
       (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id) AS n_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
