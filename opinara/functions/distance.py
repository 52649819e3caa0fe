"""Vector distances as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minkowski(a: Column, b: Column, p: int = 2) -> Column:
    """Minkowski distance of two equally long numeric arrays."""
    def term(x, y):
        gap = F.abs(x.cast("double") - y.cast("double"))
        return gap if p == 1 else gap * gap if p == 2 else F.pow(gap, F.lit(float(p)))

    total = F.aggregate(F.zip_with(a, b, term), F.lit(0.0), lambda acc, x: acc + x)
    return total if p == 1 else F.sqrt(total) if p == 2 else F.pow(total, F.lit(1.0 / p))
