"""Seeded, engine-independent pseudo-random values.

Built on md5 of plain text, so a recomputed task, another cluster or another SQL engine
all get the same order and the same draws.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def seeded_digest(seed: Column, *keys: Column) -> Column:
    """Hex digest of ``seed:key:...``; ordering by it is a seeded shuffle."""
    return F.md5(F.concat_ws(":", seed.cast("string"), *[k.cast("string") for k in keys]))


def hex_prefix_number(digest: Column, digits: int) -> Column:
    """The first ``digits`` hex digits as a number (at most 15 digits)."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def seeded_uniform(seed: Column, *keys: Column) -> Column:
    """A double in [0, 1) with 52 random bits."""
    return hex_prefix_number(seeded_digest(seed, *keys), 13) / F.lit(float(1 << 52))
