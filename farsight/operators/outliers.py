"""Approximate (M, D) distance outliers on a 2-D grid.

A point is an (M, D)-outlier when at most M points (itself included) lie
within distance D of it.  Points are mapped to square cells of side
omega = D / (2*sqrt(2)); for each non-empty cell the counts of its 3x3 block
(N3) and 7x7 block (N7) bound the ball count from below and above:

* N7 <= M  -> every point of the cell is a sure outlier
* N3 <= M  -> its points are uncertain (and N7 > M)
* else     -> inliers

Plan shape (no theta join, no driver lookup tables):

1. ``grid_cells``: floor the coordinates and count per cell (partial +
   final HashAggregate: a hot cell becomes one row before any shuffle).
2. ``region_counts``: the 7x7 window sum is separable.  Explode each cell
   over x-offsets -3..3 and aggregate by (cx+dx, cy); then explode those
   partial sums over y-offsets and aggregate by (cx, cy+dy).  The 3x3 sums
   ride along as conditional sums, and the cell's own count rides along
   at offset 0 so the result keeps exactly the non-empty cells without a
   join back.  Two shuffles of at most 7x / 49x the (already aggregated)
   cell count.
3. Classification is one CASE over (n3, n7); point counts per class are sums
   of cell counts, so the points are not rescanned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farsight.functions.geometry import cell_index, omega_for
from farsight.operators.joins import broadcast_if_small

SURE, UNCERTAIN, INLIER = "sure", "uncertain", "inlier"


def _omega_col(D) -> Column | float:
    if isinstance(D, Column):
        return D / (F.lit(2.0) * F.sqrt(F.lit(2.0)))
    return omega_for(float(D))


def with_cells(points: DataFrame, D) -> DataFrame:
    """Adds ``cx, cy`` (cell indices) to a 2-D point frame."""
    omega = _omega_col(D)
    return points.withColumn("cx", cell_index(F.col("x"), omega)) \
                 .withColumn("cy", cell_index(F.col("y"), omega))


def grid_cells(points: DataFrame, D) -> DataFrame:
    """``cx, cy, n``: points per non-empty cell."""
    return (with_cells(points.select("x", "y"), D)
            .groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n")))


def region_counts_from_cells(cells: DataFrame, keys: tuple[str, ...] = (),
                             method: str = "push") -> DataFrame:
    """``<keys>, cx, cy, n, n3, n7`` for every non-empty cell (input:
    ``<keys>, cx, cy, n``; ``keys`` are extra grouping columns, e.g. the K
    of a sweep).

    Stage 1 pushes each cell to its 7 row neighbours and aggregates the
    partial row sums (h7, h3) at (cx+dx, cy).  Stage 2 combines them along
    y:

    * ``push`` (default): every stage-1 row is pushed to its 7 column
      neighbours and aggregated; the cell's own count rides along, so no
      join.  About 7x the cells in a dense grid (the pipeline's case, where
      D is the clustering radius), up to 49x in a very sparse one.
    * ``pull``: every real cell requests its 7 column neighbours' partial
      sums through an equi-join and sums them: about 21x the cells however
      sparse the grid, at the price of a join.
    """
    keys = list(keys)
    offs = F.sequence(F.lit(-3), F.lit(3))
    by_row = (cells.select(*keys, "cx", "cy", "n", F.explode(offs).alias("d"))
              .groupBy(*keys, (F.col("cx") + F.col("d")).alias("cx"), "cy")
              .agg(F.sum("n").alias("h7"),
                   F.sum(F.when(F.abs("d") <= 1, F.col("n"))).alias("h3"),
                   F.sum(F.when(F.col("d") == 0, F.col("n"))).alias("own")))
    if method == "pull":
        req = cells.select(*keys, "cx", "cy", "n", F.explode(offs).alias("d")) \
                   .withColumn("sy", F.col("cy") + F.col("d"))
        src = by_row.select(*keys, "cx", F.col("cy").alias("sy"), "h7", "h3")
        joined = req.join(src, keys + ["cx", "sy"])
        return (joined.groupBy(*keys, "cx", "cy")
                .agg(F.first("n").alias("n"),
                     F.coalesce(F.sum(F.when(F.abs("d") <= 1, F.col("h3"))), F.lit(0)).alias("n3"),
                     F.sum("h7").alias("n7"))
                .select(*keys, "cx", "cy", "n", "n3", "n7"))
    if method != "push":
        raise ValueError(f"method must be push or pull, got {method!r}")
    by_col = (by_row.select(*keys, "cx", "cy", "h7", "h3", "own", F.explode(offs).alias("d"))
              .groupBy(*keys, "cx", (F.col("cy") + F.col("d")).alias("cy"))
              .agg(F.sum(F.when(F.col("d") == 0, F.col("own"))).alias("n"),
                   F.sum(F.when(F.abs("d") <= 1, F.col("h3"))).alias("n3"),
                   F.sum("h7").alias("n7")))
    return by_col.where(F.col("n").isNotNull()) \
                 .select(*keys, "cx", "cy", "n", F.coalesce("n3", F.lit(0)).alias("n3"), "n7")


def region_counts(points: DataFrame, D, method: str = "push") -> DataFrame:
    return region_counts_from_cells(grid_cells(points, D), method=method)


def classify_cells(regions: DataFrame, M: int) -> DataFrame:
    """Adds ``status`` in {sure, uncertain, inlier}; ``<= M`` is inclusive."""
    M = int(M)
    status = (F.when(F.col("n7") <= M, F.lit(SURE))
              .when(F.col("n3") <= M, F.lit(UNCERTAIN))
              .otherwise(F.lit(INLIER)))
    return regions.withColumn("status", status)


def classified_cells(points: DataFrame, D, M: int) -> DataFrame:
    return classify_cells(region_counts(points, D), M)


def outlier_cells(points: DataFrame, D, M: int) -> DataFrame:
    """Cells whose 7x7 block holds at most M points: ``cx, cy, n, n7``."""
    return region_counts(points, D).where(F.col("n7") <= int(M)).select("cx", "cy", "n", "n7")


def uncertain_cells_anti(points: DataFrame, D, M: int) -> DataFrame:
    """Cells with N3 <= M that are not sure-outlier cells, written as the
    reference's set difference (left anti join) rather than the CASE."""
    regions = region_counts(points, D)
    low3 = regions.where(F.col("n3") <= int(M)).select("cx", "cy", "n", "n3")
    sure = regions.where(F.col("n7") <= int(M)).select("cx", "cy")
    return low3.join(sure, ["cx", "cy"], "left_anti")


def approx_outliers(points: DataFrame, D, M: int) -> DataFrame:
    """One summary row: points and cells per class."""
    return summarize_classes(classified_cells(points, D, M))


def summarize_classes(cells: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Points and cells per class from classified cells (grouped by keys)."""
    def pts(s):
        return F.coalesce(F.sum(F.when(F.col("status") == s, F.col("n"))), F.lit(0)).cast("bigint")

    def cnt(s):
        return F.count(F.when(F.col("status") == s, F.lit(1))).cast("bigint")

    grouped = cells.groupBy(*keys) if keys else cells
    return grouped.agg(
        pts(SURE).alias("sure_outliers"),
        pts(UNCERTAIN).alias("uncertain_points"),
        pts(INLIER).alias("inlier_points"),
        F.count(F.lit(1)).cast("bigint").alias("non_empty_cells"),
        cnt(SURE).alias("sure_cells"),
        cnt(UNCERTAIN).alias("uncertain_cells"),
    )


def approx_outliers_points(points: DataFrame, D, M: int,
                           max_broadcast_rows: int | None = None) -> DataFrame:
    """Every point with its label: ``id, x, y, cx, cy, status``.

    Only the non-inlier cells (outliers are rare by design) are joined; their
    count is measured first and they are broadcast when below the bound,
    otherwise the join is a shuffle join.
    """
    flagged = classified_cells(points, D, M).where(F.col("status") != INLIER) \
        .select("cx", "cy", "status")
    kw = {} if max_broadcast_rows is None else {"max_rows": max_broadcast_rows}
    flagged, _ = broadcast_if_small(flagged, **kw)
    labelled = with_cells(points.select("id", "x", "y"), D).join(flagged, ["cx", "cy"], "left")
    return labelled.select("id", "x", "y", "cx", "cy",
                           F.coalesce("status", F.lit(INLIER)).alias("status"))
