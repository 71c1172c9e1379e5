"""Hot keys (a third of all rows on one cell / item / point) and plan shape."""

import hashlib

import numpy as np
import pytest

import __spark_entry__ as E
from conftest import SF001, items_df, pts_df
from farsight.functions.geometry import omega_for
from farsight.operators import kcenter, outliers, sampling, items as itemops


def _skewed_points(n=900, seed=3):
    rng = np.random.default_rng(seed)
    hot = [(5.0, 5.0)] * (n // 3)
    rest = [tuple(v) for v in rng.uniform(-50, 50, size=(n - n // 3, 2))]
    return hot + rest


def test_hot_cell_labels_match_brute_force(spark):
    coords = _skewed_points()
    D, M = 4.0, 3
    got = {r["id"]: r["status"] for r in
           outliers.approx_outliers_points(pts_df(spark, coords), D, M).collect()}
    om = omega_for(D)
    cells = {}
    ids = []
    for i, (x, y) in enumerate(coords):
        c = (int(np.floor(x / om)), int(np.floor(y / om)))
        ids.append(c)
        cells[c] = cells.get(c, 0) + 1

    def block(c, r):
        return sum(cells.get((c[0] + i, c[1] + j), 0) for i in range(-r, r + 1) for j in range(-r, r + 1))

    for i, c in enumerate(ids):
        n7, n3 = block(c, 3), block(c, 1)
        want = "sure" if n7 <= M else ("uncertain" if n3 <= M else "inlier")
        assert got[i] == want
    # the hot cell is one row per task before the shuffle
    plan = outliers.grid_cells(pts_df(spark, coords), D)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_duplicate_heavy_fft_buckets_balanced(spark):
    coords = _skewed_points(1200)
    df = pts_df(spark, coords)
    L = 4
    sizes = [r["count"] for r in kcenter.with_bucket(df, L).groupBy("pid").count().collect()]
    assert max(sizes) <= 1.5 * len(coords) / L
    centers = kcenter.mr_fft_centers(df, 20, L).collect()
    hot = [c for c in centers if (c["x"], c["y"]) == (5.0, 5.0)]
    assert len(hot) <= 1
    assert len({c["id"] for c in centers}) == len(centers)


def _py_draw(seed, pos):
    return int(hashlib.md5(f"{seed}:{pos}".encode()).hexdigest()[:15], 16)


def test_hot_item_sticky_and_reservoir(spark):
    rng = np.random.default_rng(7)
    n = 3000
    items = [int(v) for v in rng.integers(0, 400, size=n)]
    for i in range(0, n, 3):
        items[i] = 7          # a third of the stream
    df = items_df(spark, items)
    hist = {r["item"]: r["cnt"] for r in itemops.item_histogram(df).collect()}
    assert hist[7] == len(range(0, n, 3)) + sum(1 for i in range(n) if i % 3 and items[i] == 7)
    # sticky == sequential loop under the same draws
    from farsight.functions.draws import threshold_for
    from farsight.functions.params import sticky_r
    T = threshold_for(sticky_r(0.05, 0.01, 0.1) / n)
    S = {}
    for pos, it in enumerate(items):
        if it in S:
            S[it] += 1
        elif _py_draw(42, pos) <= T:
            S[it] = 1
    got = {r["item"]: r["est"] for r in sampling.sticky_table(df, 0.05, 0.01, 0.1).collect()}
    assert got == S
    assert 7 in {r["item"] for r in sampling.frequent_sticky(df, 0.05, 0.01, 0.1).collect()}
    # reservoir == Algorithm R
    m = 20
    res = list(items[:m])
    for pos in range(m, n):
        j = _py_draw(43, pos) % (pos + 1)
        if j < m:
            res[j] = items[pos]
    got_r = {r["slot"]: r["item"] for r in sampling.reservoir_sample(df, m).collect()}
    assert got_r == dict(enumerate(res))


BATCH_QUERIES = sorted(q for q in E.queries() if not q.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_plan_has_no_cartesian_and_prunes_columns(spark, name):
    df = E.queries()[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"
    # the events table has 6 columns; no query needs ts, event_type or props
    scans = [line for line in plan.splitlines() if "FileScan" in line and "events.parquet" in line]
    for line in scans:
        cols = line.split("FileScan parquet [", 1)[1].split("]", 1)[0]
        names = {c.split("#")[0] for c in cols.split(",")}
        assert not names & {"ts", "event_type", "props"}, f"{name} reads {names}"
        assert len(names) <= 3
