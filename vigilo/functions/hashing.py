"""Deterministic, engine-neutral hashes for splits, folds and draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGE = 4294967296.0


def digest(*parts: Column | str | int) -> Column:
    """Hex MD5 of the parts joined by a colon."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))


def leading_int(hex_digest: Column) -> Column:
    """The first 32 bits of a hex digest as a non-negative integer."""
    return F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("long")


def unit_hash(*parts: Column | str | int) -> Column:
    """Uniform value in [0, 1) that depends on the parts only."""
    return leading_int(digest(*parts)) / F.lit(_RANGE)
