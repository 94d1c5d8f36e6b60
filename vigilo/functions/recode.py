"""Recodes, bands and flags. A missing input stays missing unless stated."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def recode_map(col: Column, mapping: Mapping[str, str]) -> Column:
    """Codes in ``mapping`` are replaced, all others stay as they are."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[col], col)


def band(col: Column, cuts: Sequence[float], labels: Sequence[str], *, closed: str = "left") -> Column:
    """Ordered bands. ``closed='left'``: ``[cut, next)``; ``'right'``: ``(cut, next]``."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one more label than cuts")
    out = F.when(col.isNull(), F.lit(None))
    for cut, label in zip(cuts, labels):
        below = col < F.lit(cut) if closed == "left" else col <= F.lit(cut)
        out = out.when(below, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def flag(col: Column, cases: Mapping[str, str], otherwise: str) -> Column:
    """Named values get their own label, every other value ``otherwise``."""
    out = F.when(col.isNull(), F.lit(None))
    for value, label in cases.items():
        out = out.when(col == F.lit(value), F.lit(label))
    return out.otherwise(F.lit(otherwise))


def attendance_rate(absences: Column, days: Column) -> Column:
    """Share of enrolled days attended; missing when no day was enrolled."""
    return F.lit(1.0) - F.try_divide(absences, days)


def shifted_log(col: Column, offset: float) -> Column:
    return F.log(col.cast("double") + F.lit(offset))


def unshifted(col: Column, offset: float) -> Column:
    return F.exp(col) - F.lit(offset)


def contains_flags(col: Column, words: Sequence[str]) -> dict[str, Column]:
    """One 0/1 column per word, missing where the text is missing."""
    return {w: col.contains(w).cast("int") for w in words}


def matches_or_missing(cond: Column) -> Column:
    """Counting rule in which an unknown comparison counts as a match."""
    return F.coalesce(cond, F.lit(True))
