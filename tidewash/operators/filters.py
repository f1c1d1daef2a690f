"""Row filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewash.functions.common import col_of
from tidewash.functions.text import py_strip


def min_length_filter(df: DataFrame, c, n: int, strict: bool = True) -> DataFrame:
    """Keep rows whose code-point length is > n (or >= n)."""
    length = F.char_length(col_of(c))
    return df.where(length > n if strict else length >= n)


def category_filter(df: DataFrame, c, value=None) -> DataFrame:
    """Equality filter on one field; ``None`` means no filter."""
    return df if value is None else df.where(col_of(c) == F.lit(value))


def any_of_pattern(words: list[str]) -> str:
    """One regular expression that finds any of ``words``, shaped as a trie.

    Words with a common start share it, so a position of the text is tried
    against each next character once, however many words there are."""
    trie: dict = {}
    for w in words:
        node = trie
        for ch in w:
            if "" in node:  # a shorter word already ends here: any find of this one is a find of that
                break
            node = node.setdefault(ch, {})
        else:
            node.clear()
            node[""] = {}

    def shape(node: dict) -> str:
        if "" in node:
            return ""
        parts = []
        for ch, below in sorted(node.items()):
            run = ch
            while len(below) == 1 and "" not in below:
                (nxt, below), = below.items()
                run += nxt
            parts.append("".join(f"\\x{{{ord(x):x}}}" for x in run) + shape(below))
        return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"

    return shape(trie)


def keyword_any(c, keywords: list[str], empty_is_hit: bool = True) -> Column:
    """Case-insensitive: does the text contain any keyword?

    Null or empty text counts as a hit when ``empty_is_hit``.  The text is
    lower-cased once and searched with one pattern, for lists of any size.
    """
    words = sorted({k.lower() for k in keywords if k})
    s = col_of(c)
    hit = F.lower(s).rlike(any_of_pattern(words)) if words else F.lit(False)
    if empty_is_hit:
        return F.when(s.isNull() | (s == F.lit("")), F.lit(True)).otherwise(hit)
    return F.coalesce(hit, F.lit(False))


def code_in_set(c, codes) -> Column:
    """Numeric membership (planned as ``InSet`` for long lists)."""
    return col_of(c).isin(list(codes))


def prefix_predicate(c, marker: str) -> Column:
    """Does the text start with ``marker``?"""
    return F.startswith(col_of(c), F.lit(marker))


def non_empty(df: DataFrame, c) -> DataFrame:
    """Drop rows whose text is empty after a Unicode strip (and nulls)."""
    return df.where(py_strip(c) != F.lit(""))
