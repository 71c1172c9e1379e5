"""Empty inputs and degenerate parameters."""

import pytest

from conftest import items_df, pts_df
from farsight.operators import items as itemops, kcenter, outliers, sampling
from farsight.plans import pipeline


def test_empty_points(spark):
    empty = pts_df(spark, [])
    row = outliers.approx_outliers(empty, 1.0, 3).collect()[0]
    assert (row["sure_outliers"], row["uncertain_points"], row["inlier_points"], row["non_empty_cells"]) == (0, 0, 0, 0)
    assert kcenter.mr_fft_centers(empty, 5, 2).count() == 0
    assert kcenter.kcenter_radius(empty, kcenter.mr_fft_centers(empty, 5, 2)).collect()[0]["radius"] is None
    assert kcenter.kcenter_global(empty, 3).count() == 0
    with pytest.raises(ValueError):
        pipeline.outlier_pipeline(empty, 5, 2, 3)


def test_single_point(spark):
    one = pts_df(spark, [(1.0, 2.0)])
    assert [r["id"] for r in kcenter.mr_fft_centers(one, 4, 3).collect()] == [0]
    assert kcenter.kcenter_radius(one, kcenter.mr_fft_centers(one, 4, 3)).collect()[0]["radius"] == 0.0
    with pytest.raises(ValueError):          # D = 0 -> no grid
        pipeline.outlier_pipeline(one, 4, 3, 1)


def test_empty_items(spark):
    empty = items_df(spark, [])
    assert itemops.item_histogram(empty).count() == 0
    assert itemops.frequent_exact(empty, 0.1).count() == 0
    assert sampling.sticky_table(empty, 0.1, 0.05, 0.1).count() == 0
    assert sampling.reservoir_sample(empty, 5).count() == 0
    row = sampling.sticky_rate(empty, 0.1, 0.05, 0.1).collect()[0]
    assert row["n"] == 0 and row["rate"] == 1.0
    row = itemops.stream_stats(empty).collect()[0]
    assert (row["n_items"], row["n_distinct"], row["max_item"]) == (0, 0, None)
