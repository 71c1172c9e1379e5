import math

import numpy as np
import pytest

from conftest import SF001, pts_df
from farsight.functions.geometry import omega_for
from farsight.operators import outliers
from farsight.sources import points2d


def test_one_cluster_one_far(spark):
    coords = [(0.01 * i, 0.01 * i) for i in range(10)] + [(100.0, 100.0)]
    row = outliers.approx_outliers(pts_df(spark, coords), 1.0, 3).collect()[0]
    assert row["sure_outliers"] == 1
    assert row["uncertain_points"] == 0
    assert row["inlier_points"] == 10
    labels = {r["id"]: r["status"] for r in
              outliers.approx_outliers_points(pts_df(spark, coords), 1.0, 3).collect()}
    assert labels[10] == "sure"
    assert all(labels[i] == "inlier" for i in range(10))


def test_negative_coords_floor(spark):
    D = 2 * math.sqrt(2)  # omega = 1
    cells = outliers.grid_cells(pts_df(spark, [(-0.1, 0.1), (0.1, -0.1)]), D).collect()
    assert sorted((r["cx"], r["cy"]) for r in cells) == [(-1, 0), (0, -1)]


def test_boundary_M_inclusive(spark):
    # three points in one cell, nothing else near: N7 = 3 <= M = 3 -> sure
    coords = [(0.1, 0.1), (0.2, 0.2), (0.3, 0.1)] + [(50 + i * 0.01, 50.0) for i in range(10)]
    row = outliers.approx_outliers(pts_df(spark, coords), 2 * math.sqrt(2), 3).collect()[0]
    assert row["sure_outliers"] == 3
    row = outliers.approx_outliers(pts_df(spark, coords), 2 * math.sqrt(2), 2).collect()[0]
    assert row["sure_outliers"] == 0


def test_zero_radius_raises():
    with pytest.raises(ValueError):
        omega_for(0.0)


def _brute(spark, D):
    pdf = points2d(spark, SF001).toPandas().sort_values("id")
    X = pdf[["x", "y"]].to_numpy()
    omega = omega_for(D)
    cx = np.floor(X[:, 0] / omega).astype(np.int64)
    cy = np.floor(X[:, 1] / omega).astype(np.int64)
    return pdf, X, cx, cy


def test_region_counts_match_brute_force(spark):
    D = 15.0
    _, _, cx, cy = _brute(spark, D)
    cells = {}
    for a, b in zip(cx, cy):
        cells[(a, b)] = cells.get((a, b), 0) + 1
    got = {(r["cx"], r["cy"]): (r["n"], r["n3"], r["n7"])
           for r in outliers.region_counts(points2d(spark, SF001), D).collect()}
    assert set(got) == set(cells)
    for (a, b), (n, n3, n7) in got.items():
        assert n == cells[(a, b)]
        assert n3 == sum(cells.get((a + i, b + j), 0) for i in range(-1, 2) for j in range(-1, 2))
        assert n7 == sum(cells.get((a + i, b + j), 0) for i in range(-3, 4) for j in range(-3, 4))


def test_sandwich_invariant(spark):
    D, M = 15.0, 10
    pdf, X, _, _ = _brute(spark, D)
    d = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    exact = set(pdf["id"].to_numpy()[(d <= D).sum(1) <= M].tolist())
    lab = outliers.approx_outliers_points(points2d(spark, SF001), D, M).toPandas()
    sure = set(lab[lab.status == "sure"].id)
    unc = set(lab[lab.status == "uncertain"].id)
    assert sure <= exact <= (sure | unc)
    assert len(lab) == len(pdf)


def test_anti_join_form_equals_case_form(spark):
    p = points2d(spark, SF001)
    anti = {(r["cx"], r["cy"]) for r in outliers.uncertain_cells_anti(p, 15.0, 10).collect()}
    case = {(r["cx"], r["cy"]) for r in outliers.classified_cells(p, 15.0, 10).collect()
            if r["status"] == "uncertain"}
    assert anti == case


def test_pull_equals_push(spark):
    from conftest import pts_df
    import numpy as np
    rng = np.random.default_rng(5)
    sparse = [tuple(v) for v in rng.uniform(-500, 500, size=(300, 2))]
    for df, D in ((points2d(spark, SF001), 15.0), (pts_df(spark, sparse), 2.0)):
        a = {tuple(r) for r in outliers.region_counts(df, D).collect()}
        b = {tuple(r) for r in outliers.region_counts(df, D, method="pull").collect()}
        assert a == b and len(a) > 0


def test_labels_shuffle_join_fallback_equals_broadcast(spark):
    p = points2d(spark, SF001)
    a = {tuple(r) for r in outliers.approx_outliers_points(p, 15.0, 10).collect()}
    b = {tuple(r) for r in outliers.approx_outliers_points(p, 15.0, 10, max_broadcast_rows=0).collect()}
    assert a == b and len(a) == 1000
