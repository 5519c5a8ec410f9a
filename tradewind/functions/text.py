"""String functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_string(c: Column | str) -> Column:
    """Cast to string and strip white space of any kind from both ends (Spark's ``trim`` only
    strips U+0020). A character-set trim stays inside generated code; no regular expression."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITE_SPACE))


def concat(*cols: Column | str) -> Column:
    """Joined text; NULL as soon as one part is NULL."""
    return F.concat(*[_col(c).cast("string") for c in cols])


def length(c: Column | str) -> Column:
    return F.length(_col(c))


def position(substring: Column | str, text: Column | str) -> Column:
    """1-based position of ``substring`` (a literal when given as ``str``), 0 if absent."""
    sub = F.lit(substring) if isinstance(substring, str) else substring
    return F.locate(substring, _col(text)) if isinstance(substring, str) else F.instr(_col(text), sub)


def replace(c: Column | str, old: str, new: str) -> Column:
    return F.replace(_col(c), F.lit(old), F.lit(new))


def right(c: Column | str, n: int) -> Column:
    """Last ``n`` characters; the empty string for 0."""
    return F.right(_col(c), F.lit(n))


def split_part(c: Column | str, delimiter: str, n: int) -> Column:
    """``n``-th part of the text around a literal delimiter, counted from the end when negative;
    NULL when there is no such part."""
    if n == 0:
        return F.lit(None).cast("string")
    # the delimiter is literal: quote it for the regular expression of ``split``
    quoted = "\\Q" + delimiter.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    return F.try_element_at(F.split(_col(c), quoted, -1), F.lit(n))


def hash_text(c: Column | str) -> Column:
    """Hex MD5 of the value's text."""
    return F.md5(_col(c).cast("string"))


def regexp_extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """The captured group, or NULL when the pattern does not occur."""
    col = _col(c)
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


def regexp_contains(c: Column | str, pattern: str) -> Column:
    return _col(c).rlike(pattern)
