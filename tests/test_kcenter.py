import numpy as np
import pytest

from conftest import SF001, pts_df
from farsight.operators import kcenter
from farsight.sources import points2d


def test_all_same_stops_at_one_center(spark):
    X = np.zeros((5, 2))
    assert kcenter.farthest_first(X, 3) == [0]
    out = kcenter.mr_fft_centers(pts_df(spark, [(1.0, 1.0)] * 5), 3, 2).collect()
    assert len(out) == 1


def test_tie_goes_to_smallest_id(spark):
    square = [(0, 0), (1, 0), (0, 1), (1, 1)]
    X = np.array(square, dtype=float)
    assert kcenter.farthest_first(X, 4) == [0, 3, 1, 2]
    got = kcenter.fft_groups(pts_df(spark, square), 4, []).orderBy("it").collect()
    assert [r["id"] for r in got] == [0, 3, 1, 2]
    glob = kcenter.kcenter_global(pts_df(spark, square), 4).orderBy("it").collect()
    assert [r["id"] for r in glob] == [0, 3, 1, 2]


def test_fewer_distinct_points_than_k(spark):
    df = pts_df(spark, [(0, 0), (0, 0), (5, 5), (9, 0)])
    assert kcenter.mr_fft_centers(df, 10, 2).count() == 3
    assert kcenter.kcenter_global(df, 10).count() == 3


def test_numpy_fft_is_sequential_definition():
    rng = np.random.default_rng(1)
    X = rng.normal(size=(200, 3))
    got = kcenter.farthest_first(X, 8)
    chosen = [0]
    while len(chosen) < 8:
        best, bd = None, -1.0
        for i in range(len(X)):
            d = min(np.sqrt(((X[i] - X[c]) ** 2).sum()) for c in chosen)
            if d > bd + 1e-12:
                best, bd = i, d
        chosen.append(best)
    assert got == chosen


def test_global_prefix_and_monotone_radius(spark):
    p = points2d(spark, SF001)
    c6 = [r["id"] for r in kcenter.kcenter_global(p, 6).orderBy("it").collect()]
    c5 = [r["id"] for r in kcenter.kcenter_global(p, 5).orderBy("it").collect()]
    assert c6[:5] == c5
    radii = []
    for k in (2, 4, 6):
        cen = kcenter.kcenter_global(p, k)
        radii.append(kcenter.kcenter_radius(p, cen).collect()[0]["radius"])
    assert radii == sorted(radii, reverse=True)


def test_global_equals_single_group_fft(spark):
    p = points2d(spark, SF001)
    a = [r["id"] for r in kcenter.kcenter_global(p, 7).orderBy("it").collect()]
    b = [r["id"] for r in kcenter.fft_groups(p, 7, []).orderBy("it").collect()]
    assert a == b


def test_mr_radius_within_factor_of_global(spark):
    p = points2d(spark, SF001)
    K, L = 10, 4
    core = kcenter.mr_fft_coreset(p, K, L)
    assert core.count() <= K * L
    mr = kcenter.kcenter_radius(p, kcenter.mr_fft_centers(p, K, L)).collect()[0]["radius"]
    gl = kcenter.kcenter_radius(p, kcenter.kcenter_global(p, K)).collect()[0]["radius"]
    assert mr >= 0.5 * gl


def _merged(X, ids, K, L, bits):
    """Centers by plain numpy: bucket, hashed parts, merges level by level."""
    fan = max(1, bits - (K - 1).bit_length())
    h = (ids % 2147483647) * 1583458089 % 2147483647
    pid, parts = h % L, kcenter.parts_of_bucket(len(ids), L, bits)
    groups: dict = {}
    for i in np.argsort(ids):
        groups.setdefault((pid[i], int(h[i] // L % parts)), []).append(i)
    seen = max(map(len, groups.values()))

    def level(groups):
        out = {k: [v[j] for j in kcenter.farthest_first(X[v], K)] for k, v in groups.items()}
        return {k: sorted(v, key=lambda i: ids[i]) for k, v in out.items()}

    def up(groups, key):
        out: dict = {}
        for k, v in groups.items():
            out.setdefault(key(k), []).extend(v)
        return {k: sorted(v, key=lambda i: ids[i]) for k, v in out.items()}

    groups = level(groups)
    while max(k[1] for k in groups):
        groups = up(groups, lambda k: (k[0], k[1] >> fan))
        seen = max(seen, *map(len, groups.values()))
        groups = level(groups)
    while True:
        groups = up(groups, lambda k: (k[0] >> fan, 0))
        seen = max(seen, *map(len, groups.values()))
        if len(groups) == 1:
            (v,) = groups.values()
            return [int(ids[v[j]]) for j in kcenter.farthest_first(X[v], K)], seen
        groups = level(groups)


def test_groups_are_bounded_and_merges_equal_brute_force(spark):
    g = np.random.default_rng(3)
    X = g.normal(size=(600, 2))
    # dense ids, ids far apart, ids of both signs over the whole range
    for ids in (5_000_000_000 + np.arange(600) * 2, np.arange(600) << 21, np.sort(g.integers(-(1 << 62), 1 << 62, 600))):
        df = spark.createDataFrame([(int(i), float(x), float(y)) for i, (x, y) in zip(ids, X)], "id long, x double, y double")
        for K, L, bits in ((5, 4, 7), (5, 20, 6)):
            want, seen = _merged(X, ids, K, L, bits)
            assert seen <= 1 << bits  # no task holds more
            got = kcenter.mr_fft_centers(df, K, L, chunk_bits=bits).orderBy("it").collect()
            assert [r["id"] for r in got] == want


def test_parts_follow_the_row_count():
    assert [kcenter.parts_of_bucket(n, 4, 10) for n in (0, 1, 3072, 3073, 6144, 6145, 1 << 30)] == [1, 1, 1, 2, 2, 4, 1 << 19]


def test_string_ids(spark):
    g = np.random.default_rng(6)
    rows = [(f"p{i:04d}", float(x), float(y)) for i, (x, y) in enumerate(g.normal(size=(300, 2)))]
    df = spark.createDataFrame(rows, "id string, x double, y double")
    got = kcenter.mr_fft_centers(df, 6, 3, chunk_bits=6)
    assert got.count() == 6 and {r["id"] for r in got.collect()} <= {r[0] for r in rows}
    one = [r["id"] for r in kcenter.fft_groups(df, 6, []).orderBy("it").collect()]
    assert one == [r["id"] for r in kcenter.kcenter_global(df, 6).orderBy("it").collect()]
    assert one == [r["id"] for r in kcenter.mr_fft_centers(df, 6, 1).orderBy("it").collect()]
    assert kcenter.kcenter_radius(df, got).first()[0] == max(r["d"] for r in kcenter.kcenter_assign(df, got).collect())


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_points_without_coordinates_fail_by_name(spark, bad):
    df = pts_df(spark, [(0, 0), (1, 1), (2, 2)]).unionByName(spark.createDataFrame([(77, 1.0, bad)], "id long, x double, y double"))
    nd = df.selectExpr("id", "array(x, y) AS v")
    cen = kcenter.fft_groups(pts_df(spark, [(0, 0), (1, 1)]), 2, [])
    for run in (lambda: kcenter.mr_fft_centers(df, 2, 2), lambda: kcenter.mr_fft_centers(df, 2, None), lambda: kcenter.kcenter_radius(df, cen),
                lambda: kcenter.kcenter_assign(df, cen), lambda: kcenter.kcenter_global(df, 2), lambda: kcenter.mr_fft_centers(nd, 2, 2, coords="v")):
        with pytest.raises(Exception, match="not a point: 77"):
            run().collect()


def _brute_closest(X, C):
    d = [sum((X[:, j] - c[j]) * (X[:, j] - c[j]) for j in range(X.shape[1])) for c in C]
    return np.min(d, axis=0), np.argmin(d, axis=0)


@pytest.mark.filterwarnings("ignore:overflow")
@pytest.mark.parametrize("dims,K", [(1, 20), (2, 3), (2, 9), (2, 100), (2, 700), (5, 40), (64, 30)])
def test_closest_center_equals_brute_force(dims, K):
    g = np.random.default_rng(K)
    for C in (g.normal(size=(K, dims)), g.integers(-3, 4, (K, dims)).astype(float), np.ones((K, dims)), g.normal(size=(K, dims)) * 1e12):
        # integer points tie often; some lie outside the centers' box, some are centers
        X = np.concatenate([g.normal(size=(500, dims)) * 2 * np.abs(C).max(), g.integers(-4, 5, (500, dims)), C, np.full((1, dims), 1e300)])
        d, which = kcenter.ClosestCenter(C).of(X)
        want, at = _brute_closest(X, C)
        ok = np.isfinite(want)
        assert (d[ok] == want[ok]).all() and (which[ok] == at[ok]).all()


def test_fewer_centers_are_measured_than_there_are():
    g = np.random.default_rng(1)
    mean = []
    for K in (100, 400, 1600):
        near = kcenter.ClosestCenter(g.uniform(size=(K, 2)))
        mean.append(near.many.mean())
    assert mean[0] < 5 and mean[2] < 2 * mean[0]


def test_radius_measures_few_points(spark):
    g = np.random.default_rng(2)
    X = g.uniform(size=(5000, 2))
    df = pts_df(spark, X)
    centers = kcenter.collect_centers(kcenter.mr_fft_centers(df, 60, 2))
    C = np.array([[r["x"], r["y"]] for r in centers])
    assert kcenter.kcenter_radii(df, [centers, centers[:3], []]) == [
        np.sqrt(_brute_closest(X, C)[0].max()), np.sqrt(_brute_closest(X, C[:3])[0].max()), None]
    assert kcenter.kcenter_radii(df.limit(0), [centers]) == [None]


def test_global_reads_fewer_points_each_round(spark):
    g = np.random.default_rng(4)
    X = np.concatenate([g.uniform(size=(3000, 2)), np.full((1500, 2), 0.5)])  # a third on one point
    df, trace = pts_df(spark, X), []
    got = [r["id"] for r in kcenter.kcenter_global(df, 110, trace=trace).orderBy("it").collect()]
    assert got == kcenter.farthest_first(X, 110)
    assert len(trace) == 109 and sum(trace) < 110 * len(X) / 10 and max(trace[20:]) < len(X) / 5


def test_seeded_start_is_a_drawn_point(spark):
    p = points2d(spark, SF001)
    runs = [[r["id"] for r in kcenter.mr_fft_centers(p, 5, 2, seed=s).orderBy("it").collect()] for s in (1, 1, 2)]
    assert runs[0] == runs[1] and runs[0][0] != runs[2][0]
    assert kcenter.mr_fft_centers(p.where("id < 0"), 5, 2, seed=1).count() == 0


def test_assign_consistent_with_radius(spark):
    p = points2d(spark, SF001)
    cen = kcenter.mr_fft_centers(p, 5, 2)
    assign = kcenter.kcenter_assign(p, cen).toPandas()
    assert len(assign) == p.count()
    assert assign.d.max() == kcenter.kcenter_radius(p, cen).collect()[0]["radius"]
    ids = {r["id"] for r in cen.collect()}
    assert kcenter.non_center_points(p, cen).count() == p.count() - len(ids)


def test_one_split_equals_one_bucket(spark):
    p = points2d(spark, SF001)
    auto = [r["id"] for r in kcenter.mr_fft_centers(p.coalesce(1), 5, None).orderBy("it").collect()]
    one = [r["id"] for r in kcenter.mr_fft_centers(p, 5, 1).orderBy("it").collect()]
    assert auto == one


def test_dist_nd_expression_matches_kernel(spark):
    from pyspark.sql import functions as F
    from farsight.functions.geometry import dist_nd
    from farsight.sources import points_nd
    p = points_nd(spark, SF001)
    c = p.where("id = 7").collect()[0]["v"]
    got = {r["id"]: r["d"] for r in p.select("id", dist_nd(F.col("v"), F.array(*[F.lit(float(e)) for e in c]))
                                             .alias("d")).collect()}
    X = np.stack([np.asarray(r["v"]) for r in p.orderBy("id").collect()])
    want = kcenter._dist_to(X, np.asarray(c, dtype=float))
    assert all(got[i] == want[i] for i in range(len(want)))


def test_split_local_round1(spark):
    p = points2d(spark, SF001).repartition(3)
    core = kcenter.mr_fft_coreset(p, 5, None).collect()
    assert len(core) <= 15 and len({r["id"] for r in core}) == len(core)
    cen = kcenter.mr_fft_centers(p, 5, None)
    mr = kcenter.kcenter_radius(p, cen).collect()[0]["radius"]
    gl = kcenter.kcenter_radius(p, kcenter.kcenter_global(p, 5)).collect()[0]["radius"]
    assert 0.5 * gl <= mr


def test_min_distance_equals_assigned_distance(spark):
    p = points2d(spark, SF001)
    cen = kcenter.mr_fft_centers(p, 40, 2)
    X = np.array([[r["x"], r["y"]] for r in p.orderBy("id").collect()])
    C = np.array([[r["x"], r["y"]] for r in kcenter.collect_centers(cen)])
    assert np.sqrt(_brute_closest(X, C)[0]).tolist() == [r["d"] for r in kcenter.kcenter_assign(p, cen).orderBy("id").collect()]


def test_split_local_round1_nd(spark):
    from farsight.sources import points_nd
    p = points_nd(spark, SF001).repartition(3)
    core = kcenter.mr_fft_coreset(p, 4, None, coords="v").collect()
    assert 0 < len(core) <= 12 and len({r["id"] for r in core}) == len(core)
    cen = kcenter.mr_fft_centers(p, 4, None, coords="v")
    r = kcenter.kcenter_radius(p, cen, coords="v").collect()[0]["radius"]
    g = kcenter.kcenter_radius(p, kcenter.kcenter_global(p, 4, coords="v"), coords="v").collect()[0]["radius"]
    assert r >= 0.5 * g


def test_closest_center_does_not_depend_on_k(spark):
    # the two distances differ by less than a rounded square root shows
    from farsight.operators import kcenter
    near = [(1, 1, 1.0, 1.5e-8), (2, 2, 0.0, 1.0)]
    far = [(i, i, 1e3 + i, 1e3) for i in range(3, 31)]
    point = spark.createDataFrame([(0, 0.0, 0.0)], "id long, x double, y double")
    got = [kcenter.kcenter_assign(point, spark.createDataFrame(c, "it int, id long, x double, y double")).collect()[0]["cid"]
           for c in (near, near + far)]
    assert got[0] == got[1]
