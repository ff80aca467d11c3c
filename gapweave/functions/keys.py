"""Seeded pseudo-random keys.

Every random choice is an md5 of (salt, seed, stable id): independent of
partitioning and task retries, and reproducible in any SQL engine.  Each operator
uses its own salt so that, for instance, the split does not correlate with the
sample taken inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def shuffle_key(salt: str, seed: int, *ids: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(salt), F.lit(str(seed)), *[c.cast("string") for c in ids]))


def draw_below(key: Column, span: Column) -> Column:
    """Integer in ``[0, span)`` from the first 32 bits of a hex key."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") % span


def key_fraction(key: Column) -> Column:
    """The first 32 bits of a hex key as a double in ``[0, 1)``."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
