"""Deterministic, partition-independent pseudo-random keys.

Every "random" order in the library (per-user shuffles, samples, weighted
picks) is derived from ``md5(seed:col1:col2...)``.  The key depends only on
row values, so results do not change with partitioning, retries or engine;
the SQL oracle computes exactly the same keys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hex digits = 52 bits: exactly representable in a double.
_HEX_DIGITS = 13
_HEX_SPAN = float(16 ** _HEX_DIGITS)


def order_key(seed: int, *cols) -> Column:
    """Hex md5 of ``seed:c1:c2...``; the shuffle order used everywhere."""
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                  for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def unit_interval(key: Column) -> Column:
    """Map an md5 hex key to [0, 1); monotone in the key's string order."""
    return F.conv(F.substring(key, 1, _HEX_DIGITS), 16, 10).cast("double") / F.lit(_HEX_SPAN)


def open_unit_interval(key: Column) -> Column:
    """Map an md5 hex key to the open interval (0, 1), safe under ``log``."""
    return (F.conv(F.substring(key, 1, _HEX_DIGITS), 16, 10).cast("double") + F.lit(1.0)) / F.lit(_HEX_SPAN + 1.0)


def block_of(col, n_blocks: int) -> Column:
    """Stable block number in ``[0, n_blocks)`` for an id column."""
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.xxhash64(c), F.lit(n_blocks)).cast("int")
