"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their SQL
twins.  Parameters are fixed per query so the Spark and SQL sides agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.functions.draws import pinned
from farsight.functions.geometry import omega_for
from farsight.functions.params import reservoir_size, sticky_r
from farsight.operators import items as itemops, kcenter, outliers, points as pointops, sampling
from farsight.plans import pipeline
from farsight.plans import sql_oracle as S
from farsight.session import scratch_path
from farsight.sources import (points2d, points_nd, read_items_text, read_points_text,
                              stream_items, stream_items_timed)
from farsight.streaming import ItemStream, item_stream

# fixed query parameters
GRID_D = 15.0
GRID_M = 10
FFT_L, FFT_K = 4, 20
GLOBAL_K = 10
ND_L, ND_K = 2, 10
PIPE_L, PIPE_K, PIPE_M = 4, 50, 10
SWEEP_KS, SWEEP_L, SWEEP_M = (10, 20, 50), 4, 3
# the reference's own settings
REF_K, REF_L, REF_M = 100, 16, 3
REF_SWEEP_KS = (50, 70, 90, 110, 130)
# small parts, so that the merge of coresets shows on small tables
CHUNK_QUERY_BITS = 10
START_SEED = 7

Query = Callable[[SparkSession, str], DataFrame]


def _p(spark, sf):
    return points2d(spark, sf)


POINT_QUERIES: dict[str, Query] = {
    "point_count": lambda s, d: pointops.point_count(_p(s, d)),
    "duplicate_points": lambda s, d: pointops.duplicate_points(_p(s, d)),
    "distinct_points": lambda s, d: pointops.distinct_points(_p(s, d)),
    "grid_cells": lambda s, d: outliers.grid_cells(_p(s, d), GRID_D),
    "region_counts": lambda s, d: outliers.region_counts(_p(s, d), GRID_D),
    "region_counts_pull": lambda s, d: outliers.region_counts(_p(s, d), GRID_D, method="pull"),
    "outlier_cells": lambda s, d: outliers.outlier_cells(_p(s, d), GRID_D, GRID_M),
    "uncertain_cells_anti": lambda s, d: outliers.uncertain_cells_anti(_p(s, d), GRID_D, GRID_M),
    "approx_outliers": lambda s, d: outliers.approx_outliers(_p(s, d), GRID_D, GRID_M),
    "approx_outliers_points": lambda s, d: outliers.approx_outliers_points(_p(s, d), GRID_D, GRID_M),
    "mr_fft_coreset": lambda s, d: kcenter.mr_fft_coreset(_p(s, d), FFT_K, FFT_L),
    "mr_fft_centers": lambda s, d: kcenter.mr_fft_centers(_p(s, d), FFT_K, FFT_L),
    "mr_fft_centers_chunked": lambda s, d: kcenter.mr_fft_centers(
        _p(s, d), FFT_K, FFT_L, chunk_bits=CHUNK_QUERY_BITS),
    "mr_fft_centers_seeded": lambda s, d: kcenter.mr_fft_centers(_p(s, d), FFT_K, FFT_L, seed=START_SEED),
    "kcenter_assign": lambda s, d: kcenter.kcenter_assign(
        _p(s, d), kcenter.mr_fft_centers(_p(s, d), FFT_K, FFT_L)),
    "kcenter_radius": lambda s, d: kcenter.kcenter_radius(
        _p(s, d), kcenter.mr_fft_centers(_p(s, d), FFT_K, FFT_L)),
    "non_center_points": lambda s, d: kcenter.non_center_points(
        _p(s, d), kcenter.mr_fft_centers(_p(s, d), FFT_K, FFT_L)),
    "kcenter_global": lambda s, d: kcenter.kcenter_global(_p(s, d), GLOBAL_K),
    "kcenter_nd": lambda s, d: kcenter.mr_fft_centers(points_nd(s, d), ND_K, ND_L, coords="v")
        .select("it", "id"),
    "kcenter_nd_radius": lambda s, d: _nd_radius(s, d),
    "outlier_pipeline": lambda s, d: pipeline.outlier_pipeline(_p(s, d), PIPE_K, PIPE_L, PIPE_M),
    "outlier_pipeline_points": lambda s, d: pipeline.outlier_pipeline_points(_p(s, d), PIPE_K, PIPE_L, PIPE_M),
    "k_sweep": lambda s, d: pipeline.k_sweep(_p(s, d), SWEEP_KS, SWEEP_L, SWEEP_M),
    "kcenter_assign_k100": lambda s, d: kcenter.kcenter_assign(
        _p(s, d), kcenter.mr_fft_centers(_p(s, d), REF_K, REF_L)),
    "kcenter_radius_k100": lambda s, d: kcenter.kcenter_radius(
        _p(s, d), kcenter.mr_fft_centers(_p(s, d), REF_K, REF_L)),
    "outlier_pipeline_k100": lambda s, d: pipeline.outlier_pipeline(_p(s, d), REF_K, REF_L, REF_M),
    "k_sweep_k130": lambda s, d: pipeline.k_sweep(_p(s, d), REF_SWEEP_KS, REF_L, REF_M),
}


def _nd_radius(spark, sf):
    pts = points_nd(spark, sf)
    centers = kcenter.mr_fft_centers(pts, ND_K, ND_L, coords="v")
    r = kcenter.kcenter_radius(pts, centers, coords="v")
    return r.select(F.round("radius", 6).alias("radius"))


# ------------------------------------------------------------------ SQL side

def _grid_sql(D: float, M: int, tail: str) -> str:
    omega = S.dbl(omega_for(D))
    return f"""
WITH p AS ({S.POINTS2D}),
cells AS ({S.cells_cte('p', omega)}),
regions AS ({S.regions_cte('cells')}),
classified AS (SELECT *, {S.status_sql(M)} AS status FROM regions)
{tail}"""


def _fft_sql(tail: str, K: int = FFT_K, L: int = FFT_L) -> str:
    return f"""
WITH RECURSIVE p AS ({S.POINTS2D}),
{S.mr_centers_ctes('p', K, L)}
{tail}"""


def _pipeline_sql(K: int, L: int, M: int) -> str:
    return f"""
WITH RECURSIVE p AS ({S.POINTS2D}),
{S.mr_centers_ctes('p', K, L)},
rad AS {S.radius_sql('p', 'r2_centers')},
cells AS ({S.cells_cte('p', S.omega_sql('(SELECT radius FROM rad)'))}),
regions AS ({S.regions_cte('cells')}),
classified AS (SELECT *, {S.status_sql(M)} AS status FROM regions),
summ AS ({S.summary_select()})
SELECT (SELECT radius FROM rad) AS radius, summ.* FROM summ"""


_ASSIGN_TAIL = f"""SELECT id, CAST(arg_min(it, struct_pack(d := d, it := it)) AS INTEGER) AS cid, min(d) AS d
            FROM (SELECT p.id, c.it, {S._d2('p.', 'c.')} AS d FROM p CROSS JOIN r2_centers c)
            GROUP BY id"""

POINT_SQL: dict[str, str] = {
    "point_count": f"SELECT CAST(count(*) AS BIGINT) AS n_points FROM ({S.POINTS2D})",
    "duplicate_points": f"SELECT x, y, CAST(count(*) AS BIGINT) AS cnt FROM ({S.POINTS2D}) "
                        "GROUP BY x, y HAVING count(*) > 1",
    "distinct_points": f"SELECT DISTINCT x, y FROM ({S.POINTS2D})",
    "grid_cells": _grid_sql(GRID_D, GRID_M, "SELECT cx, cy, CAST(n AS BIGINT) AS n FROM cells"),
    "region_counts": _grid_sql(GRID_D, GRID_M, "SELECT cx, cy, CAST(n AS BIGINT) AS n, n3, n7 FROM regions"),
    "region_counts_pull": _grid_sql(GRID_D, GRID_M, "SELECT cx, cy, CAST(n AS BIGINT) AS n, n3, n7 FROM regions"),
    "outlier_cells": _grid_sql(GRID_D, GRID_M,
                               f"SELECT cx, cy, CAST(n AS BIGINT) AS n, n7 FROM regions WHERE n7 <= {GRID_M}"),
    "uncertain_cells_anti": _grid_sql(
        GRID_D, GRID_M,
        f"SELECT cx, cy, CAST(n AS BIGINT) AS n, n3 FROM regions WHERE n3 <= {GRID_M} "
        f"AND NOT EXISTS (SELECT 1 FROM regions r WHERE r.n7 <= {GRID_M} "
        "AND r.cx = regions.cx AND r.cy = regions.cy)"),
    "approx_outliers": _grid_sql(GRID_D, GRID_M, S.summary_select()),
    "approx_outliers_points": _grid_sql(
        GRID_D, GRID_M,
        f"""SELECT p.id, p.x, p.y, c.cx, c.cy, c.status FROM p JOIN classified c
            ON CAST(floor(p.x / {S.dbl(omega_for(GRID_D))}) AS BIGINT) = c.cx
           AND CAST(floor(p.y / {S.dbl(omega_for(GRID_D))}) AS BIGINT) = c.cy"""),
    "mr_fft_coreset": _fft_sql("SELECT CAST(g AS INTEGER) AS pid, CAST(it AS INTEGER) AS it, id, x, y FROM r1_centers"),
    "mr_fft_centers": _fft_sql("SELECT CAST(it AS INTEGER) AS it, id, x, y FROM r2_centers"),
    "mr_fft_centers_chunked": f"""
WITH RECURSIVE p AS ({S.POINTS2D}),
{S.chunked_centers_ctes('p', FFT_K, FFT_L, CHUNK_QUERY_BITS, 5, 3)}
SELECT CAST(it AS INTEGER) AS it, id, x, y FROM r2_centers""",
    "mr_fft_centers_seeded": f"""
WITH RECURSIVE p AS ({S.POINTS2D}),
{S.mr_centers_ctes('p', FFT_K, FFT_L, seed=START_SEED)}
SELECT CAST(it AS INTEGER) AS it, id, x, y FROM r2_centers""",
    "kcenter_assign": _fft_sql(_ASSIGN_TAIL),
    "kcenter_assign_k100": _fft_sql(_ASSIGN_TAIL, REF_K, REF_L),
    "kcenter_radius": _fft_sql(f"SELECT radius FROM {S.radius_sql('p', 'r2_centers')}"),
    "kcenter_radius_k100": _fft_sql(f"SELECT radius FROM {S.radius_sql('p', 'r2_centers')}", REF_K, REF_L),
    "non_center_points": _fft_sql("SELECT id, x, y FROM p WHERE id NOT IN (SELECT id FROM r2_centers)"),
    "kcenter_global": f"""
WITH RECURSIVE p AS ({S.POINTS2D}),
{S.fft_ctes('gl', 'p', GLOBAL_K)}
SELECT CAST(it AS INTEGER) AS it, id, x, y FROM gl_centers""",
    "kcenter_nd": f"""
WITH RECURSIVE p AS ({S.POINTS_ND}),
{S.mr_centers_ctes('p', ND_K, ND_L, nd=True)}
SELECT CAST(it AS INTEGER) AS it, id FROM r2_centers""",
    "kcenter_nd_radius": f"""
WITH RECURSIVE p AS ({S.POINTS_ND}),
{S.mr_centers_ctes('p', ND_K, ND_L, nd=True)}
SELECT round(radius, 6) AS radius FROM {S.radius_sql('p', 'r2_centers', nd=True)}""",
    "outlier_pipeline": _pipeline_sql(PIPE_K, PIPE_L, PIPE_M),
    "outlier_pipeline_k100": _pipeline_sql(REF_K, REF_L, REF_M),
    "outlier_pipeline_points": f"""
WITH RECURSIVE p AS ({S.POINTS2D}),
{S.mr_centers_ctes('p', PIPE_K, PIPE_L)},
rad AS {S.radius_sql('p', 'r2_centers')},
pc AS (SELECT id, x, y, CAST(floor(x / {S.omega_sql('(SELECT radius FROM rad)')}) AS BIGINT) AS cx,
              CAST(floor(y / {S.omega_sql('(SELECT radius FROM rad)')}) AS BIGINT) AS cy FROM p),
cells AS (SELECT cx, cy, count(*) AS n FROM pc GROUP BY ALL),
regions AS ({S.regions_cte('cells')}),
classified AS (SELECT *, {S.status_sql(PIPE_M)} AS status FROM regions)
SELECT pc.id, pc.x, pc.y, pc.cx, pc.cy, c.status FROM pc JOIN classified c USING (cx, cy)""",
}


def _sweep_sql(Ks: tuple[int, ...], L: int, M: int) -> str:
    ks = sorted(Ks)
    kmax = max(ks)
    r2 = []
    rads = []
    for k in ks:
        r2.append(S.fft_ctes(f"k{k}", f"(SELECT id, x, y FROM r1_centers WHERE it <= {k})", k))
        rads.append(f"SELECT {k} AS k, radius FROM {S.radius_sql('p', f'k{k}_centers')}")
    return f"""
WITH RECURSIVE p AS ({S.POINTS2D}),
{S.fft_ctes('r1', f"(SELECT {S.bucket_sql('id', L)} AS pid, id, x, y FROM p)", kmax, group='pid')},
{','.join(r2)},
radii AS ({' UNION ALL '.join(rads)}),
cells AS (SELECT r.k, r.radius, CAST(floor(p.x / {S.omega_sql('r.radius')}) AS BIGINT) AS cx,
                 CAST(floor(p.y / {S.omega_sql('r.radius')}) AS BIGINT) AS cy, count(*) AS n
          FROM p CROSS JOIN radii r GROUP BY ALL),
regions AS ({S.regions_cte('cells', keys=('k', 'radius'))}),
classified AS (SELECT *, {S.status_sql(M)} AS status FROM regions)
{S.summary_select('k, radius')}"""


POINT_SQL["k_sweep"] = _sweep_sql(SWEEP_KS, SWEEP_L, SWEEP_M)
POINT_SQL["k_sweep_k130"] = _sweep_sql(REF_SWEEP_KS, REF_L, REF_M)


def _pin_md5(fn: Query) -> Query:
    """Registered queries build their draws with md5 so the SQL oracle can
    reproduce them (the library default is the cheaper xxhash64)."""
    def run(spark, sf):
        with pinned("md5"):
            return fn(spark, sf)
    return run


ALL_QUERIES: dict[str, Query] = {}
ALL_QUERIES.update(POINT_QUERIES)
ALL_SQL: dict[str, str] = {}
ALL_SQL.update(POINT_SQL)


# ------------------------------------------------------------------ items


PHI, EPS, DELTA = 0.05, 0.01, 0.1
STICKY_SEED, RES_SEED = 42, 43
RES_M = reservoir_size(PHI)          # 20
RES_N = 5000
CUT_N, CUT_BATCH = 361, 360


def _i(spark, sf):
    return stream_items(spark, sf)


# report-style queries list items in increasing order, as the reference prints them
ITEM_QUERIES: dict[str, Query] = {
    "item_histogram": lambda s, d: itemops.item_histogram(_i(s, d)),
    "stream_stats": lambda s, d: itemops.stream_stats(_i(s, d)),
    "frequent_exact": lambda s, d: itemops.frequent_exact(_i(s, d), PHI).orderBy("item"),
    "stream_cutoff": lambda s, d: itemops.stream_cutoff(_i(s, d), CUT_N, CUT_BATCH),
    "sticky_rate": lambda s, d: sampling.sticky_rate(_i(s, d), PHI, EPS, DELTA),
    "sticky_table": lambda s, d: sampling.sticky_table(_i(s, d), PHI, EPS, DELTA, seed=STICKY_SEED),
    "frequent_sticky": lambda s, d: sampling.frequent_sticky(_i(s, d), PHI, EPS, DELTA, seed=STICKY_SEED)
        .orderBy("item"),
    "sticky_vs_exact": lambda s, d: sampling.sticky_vs_exact(_i(s, d), PHI, EPS, DELTA, seed=STICKY_SEED)
        .orderBy("item"),
    "frequent_common": lambda s, d: sampling.frequent_common(_i(s, d), PHI, EPS, DELTA, seed=STICKY_SEED),
    "frequent_summary": lambda s, d: sampling.frequent_summary(_i(s, d), PHI, EPS, DELTA, seed=STICKY_SEED),
    "reservoir_sample": lambda s, d: sampling.reservoir_sample(_i(s, d), RES_M, RES_SEED),
    "reservoir_first_n": lambda s, d: sampling.reservoir_first_n(_i(s, d), RES_M, RES_N, RES_SEED),
    "reservoir_vs_exact": lambda s, d: sampling.reservoir_vs_exact(_i(s, d), PHI, seed=RES_SEED)
        .orderBy("item"),
    "reservoir_summary": lambda s, d: sampling.reservoir_summary(_i(s, d), PHI, seed=RES_SEED),
}

_R = sticky_r(PHI, EPS, DELTA)
_NSQL = "(SELECT count(*) FROM it)"
_T = f"CAST(floor(least(1.0, {S.dbl(_R)} / {_NSQL}) * {S.TWO60}) AS BIGINT)"
_WITH_IT = f"WITH it AS ({S.ITEMS})"
_STICKY = f"""{_WITH_IT},
hits AS (SELECT item, min(pos) AS fp FROM it WHERE {S.draw(STICKY_SEED, 'pos')} <= {_T} GROUP BY item),
st AS (SELECT it.item, hits.fp, CAST(count(*) AS BIGINT) AS est FROM it JOIN hits USING (item)
       WHERE it.pos >= hits.fp GROUP BY it.item, hits.fp),
hist AS (SELECT item, CAST(count(*) AS BIGINT) AS cnt FROM it GROUP BY item),
truth AS (SELECT item, cnt FROM hist WHERE cnt > {S.dbl(PHI)} * {_NSQL}),
est AS (SELECT item, est FROM st WHERE est >= {S.dbl(PHI - EPS)} * {_NSQL})"""


def _reservoir_sql(m: int, where: str = "") -> str:
    slot = f"CASE WHEN pos < {m} THEN pos ELSE {S.draw(RES_SEED, 'pos')} % (pos + 1) END"
    return f"""SELECT slot, arg_max(item, pos) AS item, max(pos) AS pos
FROM (SELECT pos, item, {slot} AS slot FROM it {where}) WHERE slot < {m} GROUP BY slot"""


ITEM_SQL: dict[str, str] = {
    "item_histogram": f"{_WITH_IT} SELECT item, CAST(count(*) AS BIGINT) AS cnt FROM it GROUP BY item",
    "stream_stats": f"""{_WITH_IT} SELECT CAST(count(*) AS BIGINT) AS n_items,
        CAST(count(DISTINCT item) AS BIGINT) AS n_distinct, max(item) AS max_item FROM it""",
    "frequent_exact": f"""{_WITH_IT} SELECT item, CAST(count(*) AS BIGINT) AS cnt FROM it GROUP BY item
        HAVING count(*) > {S.dbl(PHI)} * {_NSQL}""",
    "stream_cutoff": f"""{_WITH_IT} SELECT pos, item, pos // {CUT_BATCH} AS batch FROM it
        WHERE pos // {CUT_BATCH} <= {(CUT_N - 1) // CUT_BATCH}""",
    "sticky_rate": f"""{_WITH_IT} SELECT {S.dbl(_R)} AS r, CAST(count(*) AS BIGINT) AS n,
        least(1.0, {S.dbl(_R)} / count(*)) AS rate, {_T} AS threshold FROM it""",
    "sticky_table": f"{_STICKY} SELECT item, fp, est FROM st",
    "frequent_sticky": f"{_STICKY} SELECT item, est FROM est",
    "sticky_vs_exact": f"""{_STICKY} SELECT e.item, e.est,
        CASE WHEN t.item IS NOT NULL THEN '+' ELSE '-' END AS mark FROM est e LEFT JOIN truth t USING (item)""",
    "frequent_common": f"{_STICKY} SELECT item FROM est INTERSECT SELECT item FROM truth",
    "frequent_summary": f"""{_STICKY} SELECT CAST(count(*) AS BIGINT) AS hist_size,
        CAST(count(CASE WHEN h.cnt > {S.dbl(PHI)} * {_NSQL} THEN 1 END) AS BIGINT) AS n_true,
        CAST(count(s.est) AS BIGINT) AS table_size,
        CAST(count(CASE WHEN s.est >= {S.dbl(PHI - EPS)} * {_NSQL} THEN 1 END) AS BIGINT) AS n_estimated,
        CAST(count(CASE WHEN h.cnt > {S.dbl(PHI)} * {_NSQL}
                         AND s.est >= {S.dbl(PHI - EPS)} * {_NSQL} THEN 1 END) AS BIGINT) AS n_common
        FROM hist h LEFT JOIN st s USING (item)""",
    "reservoir_sample": f"{_WITH_IT} {_reservoir_sql(RES_M)}",
    "reservoir_first_n": f"{_WITH_IT} {_reservoir_sql(RES_M, f'WHERE pos < {RES_N}')}",
    "reservoir_summary": f"""{_STICKY}, res AS ({_reservoir_sql(RES_M)}),
        rest AS (SELECT item, count(*) AS copies FROM res GROUP BY item)
        SELECT CAST(coalesce(sum(e.copies), 0) AS BIGINT) AS sample_size,
               CAST(count(e.copies) AS BIGINT) AS n_estimated,
               CAST(count(t.item) AS BIGINT) AS n_true,
               CAST(count(CASE WHEN e.copies IS NOT NULL AND t.item IS NOT NULL THEN 1 END) AS BIGINT) AS n_common
        FROM rest e FULL JOIN truth t USING (item)""",
    "reservoir_vs_exact": f"""{_STICKY}, res AS ({_reservoir_sql(RES_M)})
        SELECT DISTINCT r.item, CASE WHEN t.item IS NOT NULL THEN '+' ELSE '-' END AS mark
        FROM res r LEFT JOIN truth t USING (item)""",
}

ALL_QUERIES.update({k: _pin_md5(v) for k, v in ITEM_QUERIES.items()})
ALL_SQL.update(ITEM_SQL)


# -------------------------------------------------------------- streaming


STREAM_BATCH = 360
#: Where a consumption that stops at item n is what a query shows.
CONSUMED_N = 5000
#: Trigger of the live query, the reference's interval.
LIVE = "10 milliseconds"


def _stream(spark, sf, **kw) -> ItemStream:
    """The table's items as a stream of all its files."""
    return ItemStream(item_stream(spark, sf, STREAM_BATCH), **kw)


def _sticky_of(stream: ItemStream, spark, sf, result: str) -> DataFrame:
    n = max(1, _i(spark, sf).count())  # the rate r/n needs the stream's length beforehand
    return getattr(stream, result)(PHI, EPS, DELTA, n, STICKY_SEED)


STREAM_QUERIES: dict[str, Query] = {
    "stream_histogram": lambda s, d: _stream(s, d).histogram(),
    "stream_histogram_live": lambda s, d: _stream(s, d, processing_time=LIVE).histogram(),
    "stream_distinct": lambda s, d: _stream(s, d).stats(),
    "stream_frequent_exact": lambda s, d: _stream(s, d).frequent_exact(PHI),
    "stream_reservoir": lambda s, d: _stream(s, d).reservoir(RES_M, RES_SEED),
    "stream_sticky": lambda s, d: _sticky_of(_stream(s, d, processing_time=LIVE), s, d, "sticky"),
    "stream_frequent_sticky": lambda s, d: _sticky_of(_stream(s, d), s, d, "frequent_sticky"),
    "stream_consumed": lambda s, d: _stream(s, d).consumed(CONSUMED_N),
    "stream_histogram_cut": lambda s, d: _stream(s, d).until(CONSUMED_N).histogram(),
    "stream_histogram_state": lambda s, d: _stream(s, d).histogram(),
    "stream_sticky_state": lambda s, d: _sticky_of(_stream(s, d), s, d, "sticky"),
}

_CUT = f"{_WITH_IT}, cut AS (SELECT * FROM it WHERE pos // {STREAM_BATCH} <= {(CONSUMED_N - 1) // STREAM_BATCH})"

STREAM_SQL: dict[str, str] = {
    "stream_histogram": ITEM_SQL["item_histogram"],
    "stream_histogram_live": ITEM_SQL["item_histogram"],
    "stream_histogram_state": ITEM_SQL["item_histogram"],
    "stream_distinct": ITEM_SQL["stream_stats"],
    "stream_frequent_exact": ITEM_SQL["frequent_exact"],
    "stream_reservoir": ITEM_SQL["reservoir_sample"],
    "stream_sticky": ITEM_SQL["sticky_table"],
    "stream_sticky_state": ITEM_SQL["sticky_table"],
    "stream_frequent_sticky": ITEM_SQL["frequent_sticky"],
    "stream_consumed": f"""{_CUT} SELECT CAST(b AS BIGINT) AS batch_id, size,
        CAST(sum(size) OVER (ORDER BY b) AS BIGINT) AS cum
        FROM (SELECT pos // {STREAM_BATCH} AS b, CAST(count(*) AS BIGINT) AS size FROM cut GROUP BY 1)""",
    "stream_histogram_cut": f"{_CUT} SELECT item, CAST(count(*) AS BIGINT) AS cnt FROM cut GROUP BY item",
}

ALL_QUERIES.update({k: _pin_md5(v) for k, v in STREAM_QUERIES.items()})
ALL_SQL.update(STREAM_SQL)

# arrival-time batches (variable size), as the reference's 10 ms intervals:
# one-hour intervals of events.ts

TIME_BATCH_S = 3600


def _timed(spark, sf):
    return stream_items_timed(spark, sf, TIME_BATCH_S)


def _time_stream(spark, sf) -> ItemStream:
    return ItemStream(item_stream(spark, sf, interval_s=TIME_BATCH_S))


def _whole_time_stream(spark, sf) -> ItemStream:
    """Up to the batch that holds the last item: the cut's plan, over everything."""
    return _time_stream(spark, sf).until(max(1, _i(spark, sf).count()))


_TIMED = (f"SELECT event_id AS pos, CAST(floor(value / 10) AS INTEGER) AS item, "
          f"epoch_us(ts) // {TIME_BATCH_S * 1_000_000} AS batch FROM events")


def _time_cut_sql(n: int) -> str:
    return f"""WITH t AS ({_TIMED}),
it AS (SELECT * FROM t WHERE batch <= coalesce((SELECT max(batch) FROM t WHERE pos = {int(n) - 1}),
                                             (SELECT max(batch) FROM t)))"""


TIME_QUERIES: dict[str, Query] = {
    "stream_cutoff_time": lambda s, d: itemops.stream_cutoff(_timed(s, d), CUT_N),
    "stream_consumed_time": lambda s, d: _time_stream(s, d).consumed(CONSUMED_N),
    "stream_histogram_time": lambda s, d: _whole_time_stream(s, d).histogram(),
    "stream_sticky_time": lambda s, d: _sticky_of(_whole_time_stream(s, d), s, d, "sticky"),
}
TIME_SQL: dict[str, str] = {
    "stream_cutoff_time": f"{_time_cut_sql(CUT_N)} SELECT pos, item, batch FROM it",
    "stream_consumed_time": f"""{_time_cut_sql(CONSUMED_N)} SELECT batch AS batch_id, size,
        CAST(sum(size) OVER (ORDER BY batch) AS BIGINT) AS cum
        FROM (SELECT batch, CAST(count(*) AS BIGINT) AS size FROM it GROUP BY batch)""",
    "stream_histogram_time": ITEM_SQL["item_histogram"],
    "stream_sticky_time": ITEM_SQL["sticky_table"],
}
ALL_QUERIES.update({k: _pin_md5(v) for k, v in TIME_QUERIES.items()})
ALL_SQL.update(TIME_SQL)


# ------------------------------------------------------------ text sources


def _csv_point_scan(spark, sf):
    """Points written as the reference's header-less CSV and scanned back
    (FAILFAST parse) -> ``n_points, n_distinct, min_x, max_x, min_y, max_y``."""
    path = scratch_path(spark, "points-csv")
    points2d(spark, sf).select("x", "y").write.mode("overwrite").option("header", "false").csv(path)
    p = read_points_text(spark, path)
    per_xy = p.groupBy("x", "y").agg(F.count(F.lit(1)).alias("c"))
    return per_xy.agg(F.sum("c").cast("bigint").alias("n_points"),
                      F.count(F.lit(1)).cast("bigint").alias("n_distinct"),
                      F.min("x").alias("min_x"), F.max("x").alias("max_x"),
                      F.min("y").alias("min_y"), F.max("y").alias("max_y"))


def _text_item_histogram(spark, sf):
    """Items written one integer per line and scanned back -> histogram."""
    path = scratch_path(spark, "items-text")
    stream_items(spark, sf).select(F.col("item").cast("string")).write.mode("overwrite").text(path)
    return itemops.item_histogram(read_items_text(spark, path))


def _text_item_reservoir(spark, sf):
    """Items written as ordered text lines and scanned back; the reservoir
    depends on every line's exact position, so it checks the reader's
    file-order numbering end to end."""
    path = scratch_path(spark, "items-text-ordered")
    (stream_items(spark, sf).orderBy("pos").select(F.col("item").cast("string"))
     .write.mode("overwrite").text(path))
    return sampling.reservoir_sample(read_items_text(spark, path), RES_M, RES_SEED)


TEXT_QUERIES: dict[str, Query] = {
    "csv_point_scan": _csv_point_scan,
    "text_item_histogram": _text_item_histogram,
    "text_item_reservoir": _text_item_reservoir,
}
TEXT_SQL: dict[str, str] = {
    "csv_point_scan": f"""WITH p AS ({S.POINTS2D})
        SELECT CAST(count(*) AS BIGINT) AS n_points,
               (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT x, y FROM p)) AS n_distinct,
               min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y FROM p""",
    "text_item_histogram": ITEM_SQL["item_histogram"],
    "text_item_reservoir": ITEM_SQL["reservoir_sample"],
}
ALL_QUERIES.update({k: _pin_md5(v) for k, v in TEXT_QUERIES.items()})
ALL_SQL.update(TEXT_SQL)
