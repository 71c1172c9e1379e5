import hashlib
import math

import pytest

from conftest import SF001, items_df
from farsight.functions import params
from farsight.functions.draws import TWO_POW_60, draw, threshold_for
from farsight.operators import items as itemops, sampling
from farsight.sources import stream_items


def py_draw(seed, pos):
    return int(hashlib.md5(f"{seed}:{pos}".encode()).hexdigest()[:15], 16)


def test_draw_matches_python(spark):
    from pyspark.sql import functions as F
    got = [r[0] for r in spark.range(5).select(draw(42, F.col("id"))).collect()]
    assert got == [py_draw(42, i) for i in range(5)]
    assert all(0 <= g < TWO_POW_60 for g in got)


def test_boundary_phi_is_strict(spark):
    # n = 20, phi = 0.25 -> threshold 5: five copies are not frequent, six are
    items = [1] * 5 + [2] * 6 + list(range(100, 109))
    got = {r["item"] for r in itemops.frequent_exact(items_df(spark, items), 0.25).collect()}
    assert got == {2}


def test_short_stream_reservoir_returns_all(spark):
    got = sampling.reservoir_sample(items_df(spark, [7, 8, 9]), 10).collect()
    assert sorted(r["item"] for r in got) == [7, 8, 9]


def test_rate_above_one_sticky_is_exact(spark):
    df = items_df(spark, [3, 3, 4, 5, 3])
    S = {r["item"]: r["est"] for r in sampling.sticky_table(df, 0.5, 0.1, 0.1).collect()}
    assert S == {3: 3, 4: 1, 5: 1}


def test_batch_cut(spark):
    assert itemops.stream_cutoff(stream_items(spark, SF001), 361, 360).count() == 720
    assert itemops.stream_cutoff(stream_items(spark, SF001), 360, 360).count() == 360


def test_reservoir_equals_sequential_algorithm_r(spark):
    seed, m = 43, 20
    pdf = stream_items(spark, SF001).toPandas().sort_values("pos")
    res = [None] * m
    for pos, item in zip(pdf.pos, pdf.item):
        if pos < m:
            res[pos] = item
        else:
            j = py_draw(seed, pos) % (pos + 1)
            if j < m:
                res[j] = item
    got = {r["slot"]: r["item"] for r in sampling.reservoir_sample(stream_items(spark, SF001), m, seed).collect()}
    assert got == dict(enumerate(res))


def test_sticky_equals_sequential_loop(spark):
    phi, eps, delta, seed = 0.05, 0.01, 0.1, 42
    pdf = stream_items(spark, SF001).toPandas().sort_values("pos")
    n = len(pdf)
    T = threshold_for(params.sticky_r(phi, eps, delta) / n)
    S = {}
    for pos, item in zip(pdf.pos, pdf.item):
        if item in S:
            S[item] += 1
        elif py_draw(seed, pos) <= T:
            S[item] = 1
    got = {r["item"]: r["est"] for r in
           sampling.sticky_table(stream_items(spark, SF001), phi, eps, delta, seed=seed).collect()}
    assert got == S
    truth = pdf.item.value_counts().to_dict()
    assert all(est <= truth[i] for i, est in got.items())


def test_sticky_fallback_shuffle_join_same_answer(spark):
    it = stream_items(spark, SF001)
    a = {tuple(r) for r in sampling.sticky_table(it, 0.05, 0.01, 0.1).collect()}
    b = {tuple(r) for r in sampling.sticky_table(it, 0.05, 0.01, 0.1, max_broadcast_rows=0).collect()}
    assert a == b


def test_param_validation():
    with pytest.raises(ValueError):
        params.check_items_params(0.0)
    with pytest.raises(ValueError):
        params.check_items_params(0.1, 0.2)
    with pytest.raises(ValueError):
        params.check_items_params(0.1, 0.05, 1.5)
    assert params.reservoir_size(0.05) == 20
    assert params.reservoir_size(0.3) == 4
    assert math.isclose(params.sticky_r(0.05, 0.01, 0.1), math.log(200) / 0.01)


def test_summary_consistent(spark):
    it = stream_items(spark, SF001)
    row = sampling.frequent_summary(it, 0.05, 0.01, 0.1).collect()[0]
    assert row["hist_size"] == itemops.item_histogram(it).count()
    assert row["n_true"] == itemops.frequent_exact(it, 0.05).count()
    assert row["table_size"] == sampling.sticky_table(it, 0.05, 0.01, 0.1).count()
    assert row["n_estimated"] == sampling.frequent_sticky(it, 0.05, 0.01, 0.1).count()
    assert row["n_common"] == sampling.frequent_common(it, 0.05, 0.01, 0.1).count()


def test_xxhash_draws_keep_invariants(spark):
    it = stream_items(spark, SF001)
    spark.conf.set("farsight.draw.hash", "xxhash64")
    try:
        from pyspark.sql import functions as F
        u = [r[0] for r in spark.range(1000).select(draw(42, F.col("id"))).collect()]
        assert all(0 <= v < TWO_POW_60 for v in u) and len(set(u)) == 1000
        S = {r["item"]: r["est"] for r in sampling.sticky_table(it, 0.05, 0.01, 0.1).collect()}
        truth = {r["item"]: r["cnt"] for r in itemops.item_histogram(it).collect()}
        assert S and all(est <= truth[i] for i, est in S.items())
        res = sampling.reservoir_sample(it, 20).collect()
        assert len(res) == 20 and len({r["pos"] for r in res}) == 20
    finally:
        spark.conf.set("farsight.draw.hash", "md5")


def test_default_draw_is_xxhash_and_pinning(spark):
    from farsight.functions import draws
    spark.conf.unset("farsight.draw.hash")
    try:
        assert draws.current_method() == "xxhash64"
        with draws.pinned("md5"):
            assert draws.current_method() == "md5"
        assert draws.current_method() == "xxhash64"
    finally:
        spark.conf.set("farsight.draw.hash", "md5")


def test_sticky_recall_of_true_frequent_items(spark):
    from conftest import SF01
    it = stream_items(spark, SF01)
    row = sampling.frequent_summary(it, 0.05, 0.01, 0.1).collect()[0]
    assert row["n_true"] > 0
    assert row["n_common"] == row["n_true"]


def test_cutoff_variable_batches(spark):
    batches = [0, 0, 0, 1, 2, 2, 2, 2, 3]
    df = spark.createDataFrame([(i, 10 + i, b) for i, b in enumerate(batches)],
                               "pos long, item int, batch long")
    assert itemops.stream_cutoff(df, 4).count() == 4      # item 4 is in batch 1
    assert itemops.stream_cutoff(df, 5).count() == 8      # item 5 opens batch 2
    assert itemops.stream_cutoff(df, 3).count() == 3
    assert itemops.stream_cutoff(df, 100).count() == 9    # shorter stream: all
