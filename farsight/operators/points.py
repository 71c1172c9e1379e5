"""Point-set basics: counting, duplicate detection, de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def point_count(points: DataFrame) -> DataFrame:
    return points.agg(F.count(F.lit(1)).cast("bigint").alias("n_points"))


def duplicate_points(points: DataFrame, coords=("x", "y")) -> DataFrame:
    """Coordinates that occur more than once, with their multiplicity."""
    return (points.groupBy(*coords).agg(F.count(F.lit(1)).cast("bigint").alias("cnt"))
            .where(F.col("cnt") > 1))


def distinct_points(points: DataFrame, coords=("x", "y")) -> DataFrame:
    return points.select(*coords).distinct()
