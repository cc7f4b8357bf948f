"""Stable pseudo-random keys that any engine with md5 reproduces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32


def hash32(*parts: Column) -> Column:
    """First 32 bits of md5 over the parts joined with ``:``, as a non-negative bigint."""
    text = F.concat_ws(":", *[part.cast("string") for part in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def unit_hash(*parts: Column) -> Column:
    """The same key scaled to [0, 1)."""
    return hash32(*parts) / F.lit(float(HASH_RANGE))
