"""Seeded pseudo-random order and draws that any engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fifteen hexadecimal digits fit a signed 64-bit integer.
_DIGITS = 15
_SPAN = float(16 ** _DIGITS)


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def order_hash(seed: int, *keys) -> Column:
    """md5 of ``seed:key[:key...]``; sorting by it shuffles reproducibly."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_col(k).cast("string") for k in keys]))


def draw_int(seed: int, *keys) -> Column:
    """Uniform non-negative 60-bit integer for the key."""
    return F.conv(F.substring(order_hash(seed, *keys), 1, _DIGITS), 16, 10).cast("bigint")


def draw_unit(seed: int, *keys) -> Column:
    """Uniform double in [0, 1) for the key."""
    return draw_int(seed, *keys).cast("double") / F.lit(_SPAN)
