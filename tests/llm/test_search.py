"""Top-k search, whitening and lexical search against brute force, on small and awkward tables."""

import re
from collections import Counter
from math import floor, inf, log, nan

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from farsight import llm
from farsight.llm import lexical, topk, whitening

VECTORS = "vec_id long, embedding array<float>, label int, x long, uid string, query long, score string"


def vectors_df(spark, rows):
    """rows: (vec_id, vector); the other columns clash with names used inside."""
    return spark.createDataFrame([(i, v, None, 1, "u", 2, "s") for i, v in rows], VECTORS)


def awkward_vectors():
    g = np.random.default_rng(4)
    v = g.normal(size=(60, 6)).astype(np.float32).tolist()
    rows = [(i * 10, x) for i, x in enumerate(v)]
    rows += [(50, v[3]), (50, v[3]), (None, v[7]), (3, v[5]), (4, v[5]), (7, None), (100, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
             (150, [nan, 0.0, 0.0, 0.0, 0.0, 0.0]), (8, [inf, 0.0, 0.0, 0.0, 0.0, 0.0]), (200, [0.0] * 6)]
    return rows


def usable(rows):
    return [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]


def brute_topk(rows, every=50, k=5, scale=256):
    rows = [(i, [floor(scale * float(np.float32(x))) for x in v]) for i, v in usable(rows)]
    out = []
    for a, (i, v) in enumerate(rows):
        if i is not None and i % every == 0:
            found = [(-sum(p * q for p, q in zip(v, w)), j is None, j or 0, j) for b, (j, w) in enumerate(rows) if b != a]
            out += [(i, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found, key=lambda f: f[:3])[:k])]
    return sorted(out, key=repr)


def test_topk_awkward(spark):
    rows = awkward_vectors()
    got = topk.nearest(topk.integer_vectors(vectors_df(spark, rows)))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_topk(rows)
    # queries in several chunks
    small = topk.nearest(topk.integer_vectors(vectors_df(spark, rows)), chunk_bytes=200)
    assert sorted(map(tuple, small.collect()), key=repr) == brute_topk(rows)
    # fewer rows than k, one row alone, none, vectors of different length
    assert sorted(map(tuple, topk.nearest(topk.integer_vectors(vectors_df(spark, rows[:3]))).collect()), key=repr) == brute_topk(rows[:3])
    assert topk.nearest(topk.integer_vectors(vectors_df(spark, rows[:1]))).count() == 0
    assert topk.nearest(topk.integer_vectors(vectors_df(spark, []))).count() == 0
    mixed = [(0, [1.0, 2.0]), (1, [1.0]), (2, []), (50, [3.0, 0.0, 1.0])]
    assert sorted(map(tuple, topk.nearest(topk.integer_vectors(vectors_df(spark, mixed))).collect()), key=repr) == brute_topk(mixed)


def searched(rows, queries, own, k, block):
    best, scored = topk.Best(len(queries), k), 0
    for at in range(0, len(rows), block):
        part = np.arange(at, min(len(rows), at + block))
        scored += topk.threshold_search(best, queries, own, rows[part], part, part, np.zeros(len(part), bool))
    return best, scored


@pytest.mark.parametrize("block", [7, 300, 4000])
def test_threshold_search_stops_early(block):
    """Long-tailed dimensions: the lists' heads decide, so few rows are read; ties as brute force has them."""
    g = np.random.default_rng(8)
    rows = np.floor(g.pareto(1.5, (4000, 4)) * 10).astype(np.int64)
    rows[100:200] = rows[0:100]  # ties
    queries, own = rows[:20] - 5, np.arange(20)
    best, scored = searched(rows, queries, own, 5, block)
    s = queries @ rows.T
    s[np.arange(20), own] = topk._LOW
    for i in range(20):
        want = sorted(range(4000), key=lambda r: (-int(s[i, r]), r))[:5]
        assert best.uid[i].tolist() == want and best.score[i].tolist() == s[i, want].tolist()
    assert block < 100 or scored < 20 * 4000 / 4


def test_threshold_search_beyond_doubles():
    g = np.random.default_rng(9)
    rows = g.integers(-(1 << 28), 1 << 28, (300, 6))
    best, _ = searched(rows, rows[:4], np.arange(4), 5, 100)
    for i in range(4):
        s = [sum(int(a) * int(b) for a, b in zip(rows[i], r)) for r in rows]
        want = sorted((r for r in range(300) if r != i), key=lambda r: (-s[r], r))[:5]
        assert best.uid[i].tolist() == want and best.score[i].tolist() == [s[r] for r in want]


# ----------------------------------------------------------------- whitening

def whitened(spark, rows, most=16):
    x = topk.integer_vectors(vectors_df(spark, rows), scale=64).select("vec_id", F.transform("x", lambda v: v + F.lit(1_000_000)).alias("x"))
    return whitening.whiten(x, most)


def check_whitening(spark, rows, most=16):
    got = whitened(spark, rows, most).collect()
    ints = [(i, [floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in usable(rows)]
    fit = np.array(sorted({tuple(x) for _, x in ints}), object)
    n, s = len(fit), fit.sum(axis=0)
    y = (n * fit - s)
    values = np.linalg.eigvalsh((y.astype(float).T @ y.astype(float)) / n ** 3)[::-1]
    rank = int((values > 1e-9 * max(1e-30, values[0])).sum())
    assert len(got) == len(ints) * min(most, rank)
    trace = values.sum()
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
        assert r.n == n and r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9)
        assert r.identity_error < 1e-9
    for i, x in ints:
        d = sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s))
        assert d in {int(q.deviation) for q in by_id[i][1]}
    # whitened values of the fit list: covariance is the identity
    w = np.array([[by_id[i][k][0].whitened for k in range(1, min(most, rank) + 1)] for i, x in
                  {tuple(x): (i, x) for i, x in ints if Counter(j for j, _ in ints)[i] == 1}.values()])
    if len(w) == n:
        assert np.abs(np.cov(w.T, bias=True) - np.eye(w.shape[1])).max() < 1e-9


def test_whitening(spark):
    g = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate((g.normal(size=(200, 20)) * np.linspace(1, 9, 20)).astype(np.float32))]
    check_whitening(spark, rows + [(1000, None), (1001, [nan] * 20), (1002, [None] * 20)])
    check_whitening(spark, rows, 3)
    check_whitening(spark, awkward_vectors())
    # fewer vectors than dimensions; one vector, many times; none
    check_whitening(spark, rows[:6])
    assert whitened(spark, [(i, rows[0][1]) for i in range(9)]).count() == 0
    assert whitened(spark, []).count() == 0
    assert whitened(spark, [(1, []), (2, None)]).count() == 0
    # other lengths are left out
    assert {r.vec_id for r in whitened(spark, rows + [(7000, [1.0, 2.0])]).collect()} == {i for i, _ in rows}


def test_whitening_of_equal_eigenvalues(spark):
    rows = [(2 * i + s, [(1 - 2 * s) * 3.0 if j == i else 0.0 for j in range(5)]) for i in range(5) for s in (0, 1)]
    rows += [(20 + s, [4.0 - 8 * s] * 5) for s in (0, 1)]
    check_whitening(spark, rows)


def test_exact_parts(spark):
    g = np.random.default_rng(1)
    z = g.integers(-(1 << 40), 1 << 40, (50, 7))
    assert (whitening._scatter(z) == z.astype(object).T @ z.astype(object)).all()
    df = spark.createDataFrame([(r.tolist(),) for r in z], "x array<long>")
    n, s, q = whitening.exact_sums(df, 7, offset=5)
    y = z.astype(object) - 5
    assert n == 50 and s == y.sum(axis=0).tolist() and (q == y.T @ y).all()
    # (x - 1)(x - 2)^2(x - 7) by its matrix, turned by an integer unimodular matrix
    base, turn = np.diag([1, 2, 2, 7]), np.array([[1, 2, 0, 1], [0, 1, 3, 0], [0, 0, 1, 4], [0, 0, 0, 1]])
    a = (turn @ base @ np.round(np.linalg.inv(turn)).astype(int)).astype(object)
    p = whitening.primes(40)[0]
    want = np.round(np.poly([1, 2, 2, 7])).astype(int).tolist()
    assert [(int(v) if v < p // 2 else int(v) - p) for v in whitening.hessenberg_polynomial(a, p)] == want
    assert whitening.roots_above(want, 0, 0) == 4 and whitening.roots_above(want, 2, 0) == 1 and whitening.roots_above(want, 3, 1) == 3
    found = whitening.isolate(want, 3)
    assert [m for *_, m in found] == [1, 2]
    roots = [v / 2 ** k for v, k in (whitening.refine(want, *f) for f in found)]
    assert roots == pytest.approx([7, 2], rel=1e-15)


def test_op12_registered(spark):
    got = llm.QUERIES["op12_whitening"](spark, SF001)
    assert dict(got.dtypes)["deviation"] == "bigint" and got.count() == 500 * 16
    assert got.agg(F.max("identity_error")).first()[0] < 1e-9


# ------------------------------------------------------------ lexical search

ITEMS = "item_id long, text string, no long, term string, weight long, shard long"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_ranked(docs, items, top=20):
    split = [(i, terms(t)) for i, t in docs]
    total, words = sum(bool(t) for _, t in split), sum(len(t) for _, t in split)
    df = Counter(x for _, t in split for x in set(t))
    out = []
    for item, text in items:
        asked, found = Counter(terms(text)), []
        for i, t in split:
            tf = Counter(t)
            m = 75 + (25 * len(t) * total) // words if words else 0
            s = sum(k * floor(1000 * log((2 * total + 2) / (2 * df[x] + 1))) * ((10 ** 9 * tf[x]) // (1000 * tf[x] + 12 * m))
                    for x, k in asked.items() if tf[x])
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found, key=lambda f: f[:3])[:top])]
    return sorted(out, key=repr)


def awkward_texts():
    g = np.random.default_rng(5)
    docs = [(i, " ".join(f"W{k}x" for k in g.zipf(1.5, 30) % 50)) for i in range(60)]
    docs += [(5, docs[4][1]), (5, docs[4][1]), (None, docs[9][1]), (None, None), (70, ""), (71, " .,;\n"), (72, "Ünï-cödé ÄÖ w1X w2x's   漢字"),
             (73, " ".join(f"w{k}x" for k in g.integers(0, 40, 20000)))]
    items = [(i, docs[i][1][:60]) for i in range(12)] + [(3, docs[3][1][:60]), (None, "w1x w1x W1X"), (40, None), (41, "nowhere"), (42, "ünï ÜNÏ cödé 漢字")]
    return docs, items


@pytest.mark.parametrize("bounds", [None, (7, 3)])
def test_ranked_awkward(spark, monkeypatch, bounds):
    docs, items = awkward_texts()
    if bounds:  # many shards and bundles
        monkeypatch.setattr(lexical, "SHARD_DOCS", bounds[0])
        monkeypatch.setattr(lexical, "BUNDLE_ITEMS", bounds[1])
    d = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, shard string, score long, place long")
    q = spark.createDataFrame([(i, t, 1, "t", 2, 3) for i, t in items], ITEMS)
    got = lexical.ranked(d, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_ranked(docs, items)
    if not bounds:
        assert lexical.ranked(d.limit(0), q).count() == 0 and lexical.ranked(d, q.limit(0)).count() == 0
        assert lexical.ranked(d.where("doc_id = 70"), q).count() == 0


@pytest.mark.parametrize("name", ["op11_topk_search", "op13_lexical_search"])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got, rel = llm.QUERIES[name](spark, SF001), con.sql(llm.SQL[name])
    assert sorted(got.columns) == sorted(rel.columns)
    key = lambda cols, rows: sorted(tuple(r[cols.index(c)] for c in sorted(cols)) for r in rows)
    assert key(got.columns, [tuple(r) for r in got.collect()]) == key(rel.columns, rel.fetchall())
