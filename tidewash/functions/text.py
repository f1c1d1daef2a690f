"""Column -> Column text helpers, all built from JVM-side Spark functions.

Nothing here is a Python UDF: every helper returns a Catalyst expression that
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewash.functions.common import col_of

# --- fixed values -----------------------------------------------------------
# Python's str.strip()/str.split() whitespace set (the characters for which
# str.isspace() is true), written as one regex class that both Java regex and
# RE2 (the oracle's engine) read the same way:
#   U+0009-U+000D, U+001C-U+001F, U+0020, U+0085, U+00A0, U+1680,
#   U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000
PY_WHITESPACE_CLASS = (
    r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# The same set as a plain string, for trimming.
PY_WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Whitespace cleanup rules of the cleaning step, applied in this order:
# three or more newlines become two, two or more spaces become one, then strip.
NEWLINE_RUN_PATTERN = r"\n{3,}"
NEWLINE_RUN_REPLACEMENT = "\n\n"
SPACE_RUN_PATTERN = r" {2,}"
SPACE_RUN_REPLACEMENT = " "
# -----------------------------------------------------------------------------

_TOKEN_SPLIT_PATTERN = rf"{PY_WHITESPACE_CLASS}+"


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends.

    Plain ``trim`` only removes U+0020; ``btrim`` with the full set removes
    any of those characters at either end, without a regex.
    """
    return F.btrim(col_of(c), F.lit(PY_WHITESPACE_CHARS))


def normalize_whitespace(c) -> Column:
    """Collapse newline runs, then space runs, then strip (order matters)."""
    x = F.regexp_replace(col_of(c), NEWLINE_RUN_PATTERN, NEWLINE_RUN_REPLACEMENT)
    x = F.regexp_replace(x, SPACE_RUN_PATTERN, SPACE_RUN_REPLACEMENT)
    return py_strip(x)


def key_normalize(c) -> Column:
    """Grouping key: lower case, then strip."""
    return py_strip(F.lower(col_of(c)))


def content_hash(a, b, separator_free: bool = False) -> Column:
    """MD5 hex over two text fields.

    Plain concatenation makes ("ab","c") and ("a","bc") collide; by default a
    length prefix of the first field removes that ambiguity.  Set
    ``separator_free=True`` for the plain ``md5(a || b)`` form.

    The hash is never null: a null first field has the length -1, a null
    second field is marked by a leading ``~`` (no length starts so), so nulls
    differ from empty texts.  The plain form reads null as empty.
    """
    a, b = col_of(a), col_of(b)
    empty = F.lit("")
    if separator_free:
        return F.md5(F.concat(F.coalesce(a, empty), F.coalesce(b, empty)))
    return F.md5(F.concat(F.when(b.isNull(), F.lit("~")).otherwise(empty),
                          F.coalesce(F.char_length(a), F.lit(-1)).cast("string"), F.lit(":"),
                          F.coalesce(a, empty), F.coalesce(b, empty)))


def char_length(c) -> Column:
    """Length in code points (agrees with Python ``len`` on astral characters)."""
    return F.char_length(col_of(c))


def substring_count(c, needle: str, case_insensitive: bool = False) -> Column:
    """Non-overlapping, left-to-right count of a literal (Python ``str.count``)."""
    if not needle:
        raise ValueError("needle must be non-empty")
    s = col_of(c)
    n = needle
    if case_insensitive:
        s, n = F.lower(s), needle.lower()
    removed = F.char_length(s) - F.char_length(F.replace(s, F.lit(n), F.lit("")))
    return (removed / F.lit(len(n))).cast("bigint")


def capped_linear(c, scale: float, cap: float) -> Column:
    """``min(x / scale, cap)`` as a double."""
    return F.least(col_of(c).cast("double") / F.lit(float(scale)), F.lit(float(cap)))


def head_slice(c, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(col_of(c), 1, n)


def tail_slice(c, n: int) -> Column:
    """Last ``n`` characters (whole string when shorter)."""
    return F.right(col_of(c), F.lit(int(n)))


def prefix_label(*parts, sep: str = "/") -> Column:
    """Compose ``a/b`` style labels."""
    return F.concat_ws(sep, *[col_of(p) for p in parts])


def label_part(c, index: int, sep: str = "/") -> Column:
    """1-based part of a composed label ('' when absent)."""
    return F.split_part(col_of(c), F.lit(sep), F.lit(index))


def tokens(c) -> Column:
    """Distinct lower-case whitespace tokens (Python ``set(s.lower().split())``)."""
    parts = F.split(F.lower(col_of(c)), _TOKEN_SPLIT_PATTERN)
    return F.array_distinct(F.array_remove(parts, ""))

