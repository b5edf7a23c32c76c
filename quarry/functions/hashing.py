"""Seeded hashing as column expressions.

Every pick uses sha256/md5 so the same numbers come out of any SQL engine;
``hash``/``xxhash64`` are engine-specific and never used for picks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hex_prefix_int(hex_col: Column, digits: int = 15) -> Column:
    """First ``digits`` hex digits as a non-negative BIGINT (digits <= 15)."""
    return F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("long")


def seeded_int(*parts) -> Column:
    """``int(sha256(p1:p2:...))`` truncated to 60 bits; pmod it by n for a pick."""
    cols = [(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts]
    return hex_prefix_int(F.sha2(F.concat_ws(":", *cols), 256))


def seeded_pick(n: Column, *parts) -> Column:
    """Index in [0, n) drawn by the seeded hash."""
    return F.pmod(seeded_int(*parts), n)


def seed_from_string(s: Column) -> Column:
    """A string seed is read as its first 8 hex digits."""
    return F.conv(F.left(s, F.lit(8)), 16, 10).cast("long")
