"""End-to-end plans built from the operators.

``outlier_pipeline`` (C6): D := radius of the MapReduce k-center clustering,
then approximate (M, D)-outliers with that D.  D is a true data dependency of
the grid: MR-FFT rounds 1-3 compute it (the centers, the boxes of at most
64x64 cells and one double reach the driver) and the grid plan takes it as a
literal, so the FFT rounds run exactly once however often the grid plan refers
to D.

``k_sweep`` (C7): the same for several K in one plan.  Farthest-first is
greedy, so the centers for K are a prefix of those for any larger K: round 1
runs once with max(K) and each K keeps the coreset rows with ``it <= K``.
Round 2 merges the buckets' coresets per K; the sum(Ks) centers are collected
(parameter-bounded) and the same scans compute every K's radius; the per-K cell
sides are then literals, and cells, region counts and classes are grouped by
(k, cell).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farsight.functions.geometry import omega_for
from farsight.operators import kcenter, outliers


def outlier_pipeline(points: DataFrame, K: int, L: int, M: int) -> DataFrame:
    """One row: ``radius, sure_outliers, uncertain_points, inlier_points,
    non_empty_cells, sure_cells, uncertain_cells``."""
    pts = points.select("id", "x", "y")
    D = mr_radius(pts, K, L)
    summary = outliers.approx_outliers(pts, D, M)
    return summary.select(F.lit(D).alias("radius"), *summary.columns)


def outlier_pipeline_points(points: DataFrame, K: int, L: int, M: int) -> DataFrame:
    """Every point with its label under D := MR-FFT radius:
    ``id, x, y, cx, cy, status``."""
    pts = points.select("id", "x", "y")
    return outliers.approx_outliers_points(pts, mr_radius(pts, K, L), M)


def mr_radius(points: DataFrame, K: int, L: int) -> float:
    """Radius of the MapReduce k-center clustering."""
    centers = kcenter.mr_fft_centers(points, K, L)
    radius, = kcenter.kcenter_radii(points, [kcenter.collect_centers(centers)])
    if radius is None:
        raise ValueError("empty point set")
    return radius


def k_sweep(points: DataFrame, Ks, L: int, M: int) -> DataFrame:
    """One row per K: ``k, radius, sure_outliers, uncertain_points,
    inlier_points, non_empty_cells, sure_cells, uncertain_cells``."""
    Ks = sorted({int(k) for k in Ks})
    pts = points.select("id", "x", "y")
    core = kcenter.mr_fft_coreset(pts, max(Ks), L)
    by_k: dict[int, list] = {k: [] for k in Ks}
    per_k = (core.select("*", F.explode(F.array(*[F.lit(k) for k in Ks])).alias("k"))
             .where(F.col("it") <= F.col("k")))
    centers = kcenter.merge_coresets(per_k, max(Ks), int(L), "pid", ["k"])
    # sum(Ks) centers in all: a parameter-bounded transfer
    for r in centers.where(F.col("it") <= F.col("k")).select("k", "it", "x", "y").collect():
        by_k[int(r["k"])].append(r)
    # every K's radius from the same scans
    radii = kcenter.kcenter_radii(pts, [sorted(by_k[k], key=lambda r: r["it"]) for k in Ks])
    if None in radii:
        raise ValueError("empty point set")
    grid = list(zip(Ks, radii))
    params = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(D).alias("radius"),
                                F.lit(omega_for(D)).alias("omega")) for k, D in grid])
    cells = (pts.select("x", "y", F.explode(params).alias("o"))
             .select(F.col("o.k").alias("k"), F.col("o.radius").alias("radius"),
                     F.floor(F.col("x") / F.col("o.omega")).cast("bigint").alias("cx"),
                     F.floor(F.col("y") / F.col("o.omega")).cast("bigint").alias("cy"))
             .groupBy("k", "radius", "cx", "cy").agg(F.count(F.lit(1)).alias("n")))
    # radius is a function of k: carrying it as a key avoids a join back
    regions = outliers.region_counts_from_cells(cells, keys=("k", "radius"))
    return outliers.summarize_classes(outliers.classify_cells(regions, M), keys=("k", "radius"))
