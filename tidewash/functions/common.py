"""Small shared helpers for building Column expressions."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def cols_of(cs) -> list[Column]:
    if cs is None:
        return []
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [col_of(c) for c in cs]


def names_of(cs) -> list[str]:
    if cs is None:
        return []
    if isinstance(cs, str):
        return [cs]
    return list(cs)


def as_fraction(threshold) -> Fraction:
    """Exact rational form of a threshold such as 0.85 -> 17/20.

    Similarity tests compare integers (``den*inter > num*union``) so binary
    floating error can never flip a decision at the boundary.
    """
    f = Fraction(str(threshold)) if not isinstance(threshold, Fraction) else threshold
    if not (0 < f <= 1):
        raise ValueError(f"threshold must be in (0, 1], got {threshold}")
    return f
