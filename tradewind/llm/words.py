"""Word and line expressions over whole texts, all built-in functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII white space: tab to carriage return, and the blank
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def n_words(text: Column) -> Column:
    """Number of runs of other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """The words of ``text`` in order; an empty array for null and for texts without a word."""
    core = F.btrim(text, F.lit(BLANKS))
    return F.when(core != "", F.split(core, SPACE + "+", -1)).otherwise(F.array().cast("array<string>"))


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def lines(text: Column) -> Column:
    """The ``\\n``-split lines; an empty array for null."""
    return F.coalesce(F.split(text, "\n", -1), F.array().cast("array<string>"))


def normal_line(line: Column) -> Column:
    """A line as it is compared: lower case, digits as 0, white space as one blank, trimmed."""
    plain = F.regexp_replace(F.lower(line), "[0-9]+", "0")
    return F.btrim(F.regexp_replace(plain, SPACE + "+", " "))
