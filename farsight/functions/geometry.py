"""Distance and grid-cell expressions, all JVM-side (whole-stage codegen).

Every distance is written as ``sqrt(dx*dx + dy*dy)`` (n-D: a left-to-right sum
of squared differences) so the numpy code in the FFT groups and the SQL
oracle produce bit-identical doubles.
"""

from __future__ import annotations

import math
from pyspark.sql import Column
from pyspark.sql import functions as F


def dist2d(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx = x1 - x2
    dy = y1 - y2
    return F.sqrt(dx * dx + dy * dy)


def dist_nd(a: Column, b: Column) -> Column:
    """Euclidean distance of two equal-length ``ARRAY<DOUBLE>`` columns."""
    sq = F.zip_with(a, b, lambda p, q: (p - q) * (p - q))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda s, e: s + e))


def omega_for(D: float) -> float:
    """Cell side so that a cell's diagonal is D/2."""
    if not D > 0:
        raise ValueError(f"radius D must be > 0, got {D!r}")
    return D / (2 * math.sqrt(2))


def cell_index(coord: Column, omega) -> Column:
    """floor(coord / omega) as BIGINT (floor, not truncation: negatives
    go down)."""
    return F.floor(coord / omega).cast("bigint")
