"""Property tests on random small inputs (few examples: each runs Spark jobs)."""

import hashlib

import numpy as np
from hypothesis import HealthCheck, given, settings, strategies as st

from conftest import items_df, pts_df
from farsight.functions.draws import threshold_for
from farsight.operators import kcenter, outliers, sampling

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

coords = st.lists(st.tuples(st.integers(-40, 40), st.integers(-40, 40)), min_size=1, max_size=60)


@SETTINGS
@given(pts=coords, D=st.sampled_from([1.5, 4.0, 9.0]), M=st.integers(0, 5))
def test_sandwich_on_random_points(spark, pts, D, M):
    P = [(x * 0.5, y * 0.5) for x, y in pts]
    lab = {r["id"]: r["status"] for r in outliers.approx_outliers_points(pts_df(spark, P), D, M).collect()}
    X = np.array(P)
    within = (np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)) <= D).sum(1)
    for i in range(len(P)):
        exact = within[i] <= M
        if lab[i] == "sure":
            assert exact
        if exact:
            assert lab[i] in ("sure", "uncertain")


@SETTINGS
@given(pts=coords, K=st.integers(1, 6))
def test_fft_matches_brute_force(spark, pts, K):
    P = [(float(x), float(y)) for x, y in pts]
    got = [r["id"] for r in kcenter.fft_groups(pts_df(spark, P), K, []).orderBy("it").collect()]
    X = np.array(P)
    chosen = [0]
    d = np.sqrt(((X - X[0]) ** 2).sum(1))
    while len(chosen) < K and d.max() > 0:
        j = int(np.argmax(d))
        chosen.append(j)
        d = np.minimum(d, np.sqrt(((X - X[j]) ** 2).sum(1)))
    assert got == chosen
    # radius equals the brute-force max-min distance
    r = kcenter.kcenter_radius(pts_df(spark, P), kcenter.fft_groups(pts_df(spark, P), K, [])).collect()[0]["radius"]
    assert abs(r - d.max()) < 1e-9


def _u(seed, pos):
    return int(hashlib.md5(f"{seed}:{pos}".encode()).hexdigest()[:15], 16)


@SETTINGS
@given(items=st.lists(st.integers(0, 12), min_size=1, max_size=300), m=st.integers(1, 15),
       phi=st.sampled_from([0.1, 0.2]), seed=st.integers(0, 1000))
def test_samplers_match_sequential(spark, items, m, phi, seed):
    df = items_df(spark, items)
    res = list(items[:m])
    for pos in range(m, len(items)):
        j = _u(seed, pos) % (pos + 1)
        if j < m:
            res[j] = items[pos]
    got = {r["slot"]: r["item"] for r in sampling.reservoir_sample(df, m, seed).collect()}
    assert got == dict(enumerate(res))
    eps, delta = phi / 2, 0.1
    from farsight.functions.params import sticky_r
    T = threshold_for(sticky_r(phi, eps, delta) / len(items))
    S = {}
    for pos, it in enumerate(items):
        if it in S:
            S[it] += 1
        elif _u(seed, pos) <= T:
            S[it] = 1
    got_s = {r["item"]: r["est"] for r in sampling.sticky_table(df, phi, eps, delta, seed=seed).collect()}
    assert got_s == S
