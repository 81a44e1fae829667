"""Seeded, reproducible order and draws derived from row keys.

A shuffle or a draw must give the same rows on every retry of a task, so randomness
is a hash of the seed and the key instead of a generator's state.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 42


def order_digest(seed: int, *keys: str | Column) -> Column:
    """MD5 hex digest of ``seed:key1:key2...``; sorting by it is a seeded shuffle."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def digest_number(digest: Column) -> Column:
    """The leading 60 bits of a hex digest as a non-negative long."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
