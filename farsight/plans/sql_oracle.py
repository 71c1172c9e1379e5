"""DuckDB SQL twins of the registered queries (the correctness oracle).

These strings restate each query declaratively -- range self-joins for the
grid blocks, recursive CTEs for the farthest-first traversal, md5 draws for
the samplers -- over the same Parquet tables.  Floating-point parameters are
pasted as ``CAST('<repr>' AS DOUBLE)`` so DuckDB does not read them as
DECIMAL.
"""

from __future__ import annotations

from farsight.functions.draws import bucket_sql, draw_sql, part_sql


def dbl(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


POINTS2D = "SELECT event_id AS id, CAST(user_id AS DOUBLE) AS x, value AS y FROM events"
POINTS_ND = "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"
ITEMS = "SELECT event_id AS pos, CAST(floor(value / 10) AS INTEGER) AS item FROM events"
TWO60 = "CAST(1152921504606846976 AS DOUBLE)"


def omega_sql(D_sql: str) -> str:
    return f"({D_sql} / (2.0 * sqrt(2.0)))"


def cells_cte(pts: str, omega: str, keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    return (f"SELECT {k}CAST(floor(x / {omega}) AS BIGINT) AS cx, "
            f"CAST(floor(y / {omega}) AS BIGINT) AS cy, count(*) AS n FROM {pts} GROUP BY ALL")


def regions_cte(cells: str, keys: tuple[str, ...] = ()) -> str:
    ksel = "".join(f"a.{k}, " for k in keys)
    kjoin = "".join(f" AND a.{k} = b.{k}" for k in keys)
    return f"""
    SELECT {ksel}a.cx, a.cy, a.n,
           CAST(sum(CASE WHEN abs(b.cx - a.cx) <= 1 AND abs(b.cy - a.cy) <= 1 THEN b.n END) AS BIGINT) AS n3,
           CAST(sum(b.n) AS BIGINT) AS n7
    FROM {cells} a JOIN {cells} b
      ON b.cx BETWEEN a.cx - 3 AND a.cx + 3 AND b.cy BETWEEN a.cy - 3 AND a.cy + 3{kjoin}
    GROUP BY ALL"""


def status_sql(M: int) -> str:
    return (f"CASE WHEN n7 <= {int(M)} THEN 'sure' WHEN n3 <= {int(M)} THEN 'uncertain' "
            "ELSE 'inlier' END")


def summary_select(keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    g = f" GROUP BY {keys}" if keys else ""
    return f"""
    SELECT {k}
      CAST(coalesce(sum(CASE WHEN status = 'sure' THEN n END), 0) AS BIGINT) AS sure_outliers,
      CAST(coalesce(sum(CASE WHEN status = 'uncertain' THEN n END), 0) AS BIGINT) AS uncertain_points,
      CAST(coalesce(sum(CASE WHEN status = 'inlier' THEN n END), 0) AS BIGINT) AS inlier_points,
      CAST(count(*) AS BIGINT) AS non_empty_cells,
      CAST(count(CASE WHEN status = 'sure' THEN 1 END) AS BIGINT) AS sure_cells,
      CAST(count(CASE WHEN status = 'uncertain' THEN 1 END) AS BIGINT) AS uncertain_cells
    FROM classified{g}"""


# ---------------------------------------------------------------- FFT (CTE)

def _d2(a: str, b: str) -> str:
    return f"sqrt(({a}x - {b}x) * ({a}x - {b}x) + ({a}y - {b}y) * ({a}y - {b}y))"


def fft_ctes(prefix: str, src: str, K: int, group: str = "0", nd: bool = False, seed=None) -> str:
    """CTEs ``{prefix}_centers(g, it, id, <coords>)``: farthest-first
    traversal of every group ``g`` of ``src`` (columns id, x, y or id, v),
    starting at the smallest id (with a seed: the smallest draw), ties to the
    smallest id."""
    by = "id" if seed is None else draw_sql(seed, "id")
    if nd:
        cols, fsel = "v", f"arg_min(v, {by}) AS fv"
        d0 = "list_distance(p.v, f.fv)"
        dn = "list_distance(v, nv)"
        nsel = "first_value(v) OVER w AS nv"
    else:
        cols, fsel = "x, y", f"arg_min(x, {by}) AS fx, arg_min(y, {by}) AS fy"
        d0 = _d2("p.", "f.f")
        dn = _d2("", "n")
        nsel = "first_value(x) OVER w AS nx, first_value(y) OVER w AS ny"
    pcols = ", ".join(f"p.{c.strip()}" for c in cols.split(","))
    return f"""
{prefix}_pts AS (SELECT {group} AS g, id, {cols} FROM {src}),
{prefix}_first AS (SELECT g, arg_min(id, {by}) AS fid, {fsel} FROM {prefix}_pts GROUP BY g),
{prefix}_rec(g, id, {cols}, d, it, is_c) AS (
  SELECT p.g, p.id, {pcols}, {d0}, 1, p.id = f.fid
  FROM {prefix}_pts p JOIN {prefix}_first f ON p.g = f.g
  UNION ALL
  SELECT g, id, {cols}, least(d, {dn}), it + 1, id = nid
  FROM (SELECT g, id, {cols}, d, it, {nsel}, first_value(id) OVER w AS nid
        FROM {prefix}_rec WHERE it < {int(K)}
        WINDOW w AS (PARTITION BY g ORDER BY d DESC, id ASC))
),
{prefix}_centers AS (SELECT g, it, id, {cols} FROM {prefix}_rec WHERE is_c)"""


def mr_centers_ctes(src: str, K: int, L: int, nd: bool = False, seed=None) -> str:
    """``r1_centers`` (coreset, g = bucket) and ``r2_centers`` (centers)."""
    cols = "v" if nd else "x, y"
    r1_src = f"(SELECT {bucket_sql('id', L)} AS pid, id, {cols} FROM {src})"
    return (fft_ctes("r1", r1_src, K, group="pid", nd=nd, seed=seed) + ",\n"
            + fft_ctes("r2", f"(SELECT id, {cols} FROM r1_centers)", K, nd=nd, seed=seed))


def chunked_centers_ctes(src: str, K: int, L: int, chunk_bits: int, fan_bits: int, levels: int) -> str:
    """``r2_centers`` with buckets cut into hashed parts, as many as the number
    of points asks for, and their coresets merged in ``levels`` levels (a
    level more changes nothing) and L within one fan."""
    parts = (f"(SELECT min(p) FROM (SELECT CAST(1 AS BIGINT) << i AS p FROM range(0, 40) t(i)) "
             f"WHERE 4 * (SELECT count(*) FROM {src}) <= {3 * L << chunk_bits} * p)")
    ctes = [fft_ctes("m0", f"(SELECT {part_sql('id', L, parts)} * {L} + {bucket_sql('id', L)} AS pid, id, x, y FROM {src})",
                     K, group="pid")]
    for i in range(levels):
        ctes.append(fft_ctes(f"m{i + 1}", f"(SELECT ((g // {L}) >> {fan_bits}) * {L} + g % {L} AS pid, id, x, y FROM m{i}_centers)",
                             K, group="pid"))
    return ",\n".join([*ctes, fft_ctes("r2", f"(SELECT id, x, y FROM m{levels}_centers)", K)])


def radius_sql(points: str, centers: str, nd: bool = False) -> str:
    d = "list_distance(p.v, c.v)" if nd else _d2("p.", "c.")
    return (f"(SELECT max(dmin) AS radius FROM (SELECT p.id, min({d}) AS dmin "
            f"FROM {points} p CROSS JOIN {centers} c GROUP BY p.id))")


def draw(seed, key: str) -> str:
    return draw_sql(seed, key)
