"""k-center clustering by farthest-first traversal (FFT).

Semantics (one definition for every mode):

* the traversal starts at the point with the smallest ``id``;
* each next center is the point farthest from the centers chosen so far;
  ties go to the smallest ``id``;
* it stops early when every remaining distance is 0 (fewer distinct points
  than K): it then returns fewer than K centers;
* duplicates stay in the data but are never chosen twice;
* ids are one per point, of any integer type or strings; a point with a null id,
  or a coordinate that is null, NaN or infinite, fails the job with its id.

Modes:

* ``fft_groups`` -- the sequential O(n*K) traversal of each group, numpy
  inside an Arrow-batched ``applyInArrow`` task (C1).
* MapReduce FFT (C2-C4): round 1 either hashes ids into L buckets (one
  shuffle; arithmetic hash, so no id pattern piles rows into one bucket) or,
  with ``L=None``, runs on the input splits with no shuffle.  The row count
  says into how many hashed parts a bucket is cut, so that a task holds at most
  about ``2**CHUNK_BITS`` rows however many points there are and whatever their
  ids; the coresets of a bucket's parts are merged by FFT again, level by
  level, until each bucket has one.  Round 2 merges the buckets' coresets by
  the same rule.  Round 3 bounds each cell's farthest distance from its box
  and measures points only in cells that can hold the maximum: no cross join,
  no shuffle of the points.
* ``kcenter_global``: the exact traversal over the whole distributed set; a
  round reads only the cells that the newest center can have changed and that
  can still hold the farthest point.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farsight.functions.draws import bucket_and_part, bucket_of, draw
from farsight.operators.joins import broadcast_if_small

# A group of round 1 holds about so many points at most (2-D: 24 MB),
# whatever the number of points; so does a merged group.
CHUNK_BITS = 20

# The group function runs in Python workers: ship this module's code by
# value so executors need no installed copy of the package.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass


def checked_points(points: DataFrame, coords=("x", "y"), *more: str) -> DataFrame:
    """``<more>, id, <coords>`` of ``points``, coordinates as doubles.  A null
    id, or a coordinate that is null, NaN or infinite, fails the job."""
    def bad(v: Column) -> Column:
        return v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))

    def failed(kind: str) -> Column:
        return F.raise_error(F.concat(F.lit("not a point: "), F.coalesce(F.col("id").cast("string"), F.lit("no id")))).cast(kind)

    if isinstance(coords, str):
        v = F.col(coords).cast("array<double>")
        cols = [F.when(F.col("id").isNull() | v.isNull() | F.exists(v, bad), failed("array<double>")).otherwise(v).alias(coords)]
    else:
        cols = [F.when(F.col("id").isNull() | bad(F.col(c).cast("double")), failed("double")).otherwise(F.col(c).cast("double")).alias(c)
                for c in coords]
    return points.select(*more, "id", *cols)


# --------------------------------------------------------------------------
# sequential traversal (runs inside tasks)
# --------------------------------------------------------------------------

def _columns(X: np.ndarray) -> list[np.ndarray]:
    """Contiguous per-dimension columns (row-major columns are strided)."""
    return [np.ascontiguousarray(X[:, j], dtype=np.float64) for j in range(X.shape[1])]


def _sq_into(cols: list[np.ndarray], c: np.ndarray, out: np.ndarray, tmp: np.ndarray) -> None:
    """out := sum over dimensions (left to right) of (col - c)^2, in place."""
    np.subtract(cols[0], c[0], out=out)
    np.multiply(out, out, out=out)
    for j in range(1, len(cols)):
        np.subtract(cols[j], c[j], out=tmp)
        np.multiply(tmp, tmp, out=tmp)
        np.add(out, tmp, out=out)


def _dist_to(X: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances from every row of X to c, summing squared differences left
    to right (the order the SQL expressions use)."""
    out, tmp = np.empty(X.shape[0]), np.empty(X.shape[0])
    _sq_into(_columns(X), c, out, tmp)
    return np.sqrt(out, out=out)


def farthest_first(X: np.ndarray, K: int, start: int = 0) -> list[int]:
    """Indices of up to K centers; rows of X must be sorted by id so that
    ``argmax`` (first maximum) breaks ties by the smallest id.  O(n*K) with
    no per-iteration allocation."""
    n = X.shape[0]
    if n == 0 or K <= 0:
        return []
    cols = _columns(X)
    dd, s, tmp = np.empty(n), np.empty(n), np.empty(n)
    _sq_into(cols, X[start], dd, tmp)
    np.sqrt(dd, out=dd)
    chosen = [start]
    while len(chosen) < K:
        j = int(np.argmax(dd))
        if dd[j] == 0.0:
            break
        chosen.append(j)
        _sq_into(cols, X[j], s, tmp)
        np.sqrt(s, out=s)
        np.minimum(dd, s, out=dd)
    return chosen


def _matrix(t: pa.Table | pa.RecordBatch, coords) -> np.ndarray:
    """The coordinates of ``t``, a row per point."""
    if isinstance(coords, str):
        flat = pc.list_flatten(t.column(coords))
        return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(t.num_rows, -1) if t.num_rows else np.zeros((0, 0))
    return np.column_stack([t.column(c).to_numpy(zero_copy_only=False).astype(np.float64, copy=False) for c in coords])


def _traversed(t: pa.Table, K: int, coords, seeded: bool = False) -> pa.Table:
    """The centers of the points of ``t``, ``it`` first."""
    t = t.take(pc.sort_indices(t, sort_keys=[("id", "ascending")]))
    start = int(np.argmin(t.column("_u").to_numpy())) if seeded else 0
    idx = farthest_first(_matrix(t, coords), K, start)
    out = t.select(["id", *_coord_cols(coords)]).take(pa.array(idx, pa.int64()))
    return out.add_column(0, "it", pa.array(np.arange(1, len(idx) + 1, dtype=np.int32)))


def _fft_group_fn(K: int, coords, keys: tuple[str, ...], seeded: bool):
    def fn(key: tuple, t: pa.Table) -> pa.Table:
        out = _traversed(t, K, coords, seeded)
        for i, k in enumerate(keys):
            out = out.add_column(i, k, pa.array([key[i].as_py()] * out.num_rows, t.schema.field(k).type))
        return out
    return fn


def _coord_cols(coords) -> list[str]:
    return [coords] if isinstance(coords, str) else list(coords)


def _schema(src: DataFrame, *cols: str) -> str:
    return ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in cols)


def fft_groups(points: DataFrame, K: int, by: list[str], coords=("x", "y"), seed=None) -> DataFrame:
    """FFT of each group of ``by``: rows ``<by>, it, id, <coords>``.

    With a ``seed`` a group starts at the point whose draw of (seed, id) is
    the smallest, a random point that reruns agree on."""
    src = checked_points(points, coords, *by)
    schema = ", ".join([*([_schema(src, *by)] if by else []), "it int", _schema(src, "id", *_coord_cols(coords))])
    fn = _fft_group_fn(int(K), coords, tuple(by), seed is not None)
    if seed is not None:
        src = src.withColumn("_u", draw(seed, F.col("id"), "md5"))
    return src.groupBy(*by).applyInArrow(fn, schema=schema)


# --------------------------------------------------------------------------
# MapReduce FFT
# --------------------------------------------------------------------------

def id_key(points: DataFrame) -> Column:
    """The id as the integer that bucket hashes take: itself, or a 64-bit hash of another type."""
    return F.col("id").cast("bigint") if isinstance(points.schema["id"].dataType, T.IntegralType) else F.xxhash64("id")


def with_bucket(points: DataFrame, L: int) -> DataFrame:
    return points.withColumn("pid", bucket_of(id_key(points), int(L)))


def parts_of_bucket(n: int, L: int, chunk_bits: int = CHUNK_BITS) -> int:
    """Parts that a bucket of ``n`` points in ``L`` buckets is cut into: the
    smallest power of two that leaves at most three quarters of ``2**chunk_bits`` in a
    part (parts are hashed, so their sizes vary a little)."""
    parts = 1
    while 4 * n > 3 * int(L) * parts << chunk_bits:
        parts *= 2
    return parts


def _fft_split_fn(K: int, coords):
    def fn(batches):
        from pyspark import TaskContext
        parts = [b for b in batches if b.num_rows]
        if parts:
            out = _traversed(pa.Table.from_batches(parts), K, coords)
            pid = pa.array(np.full(out.num_rows, TaskContext.get().partitionId(), np.int32))
            yield from out.add_column(0, "pid", pid).combine_chunks().to_batches()
    return fn


def mr_fft_coreset_local(points: DataFrame, K: int, coords=("x", "y")) -> DataFrame:
    """Round 1 on the input splits themselves: no shuffle at all.

    Each scan split (bounded by ``spark.sql.files.maxPartitionBytes``, so no
    key or duplicate group can make one large) runs FFT in one
    ``mapInArrow`` task; MR-FFT's approximation guarantee holds for any
    partitioning.  Deterministic for a given input and split size, so task
    retries reproduce it.  Rows ``pid, it, id, <coords>``; pid is the split."""
    src = checked_points(points, coords)
    return src.mapInArrow(_fft_split_fn(int(K), coords), "pid int, it int, " + _schema(src, *src.columns))


def _fan_bits(K: int, chunk_bits: int) -> int:
    """So many bits of a group number a merge drops: the merged group keeps
    within a chunk (two groups at least, if K itself is over half a chunk)."""
    return max(1, chunk_bits - (max(1, int(K)) - 1).bit_length())


def merge_coresets(coreset: DataFrame, K: int, groups: int, number: str, keys: list[str] = [], coords=("x", "y"),
                   chunk_bits: int = CHUNK_BITS, seed=None) -> DataFrame:
    """FFT over the coresets of neighbouring groups (``number`` 0 to
    ``groups`` - 1 within ``keys``), level by level, until one is left:
    rows ``<keys>, it, id, <coords>``."""
    bits, cc = _fan_bits(K, chunk_bits), _coord_cols(coords)
    while True:
        up = F.shiftright(number, bits).cast(coreset.schema[number].dataType)
        coreset = fft_groups(coreset.select(*keys, up.alias(number), "id", *cc), K, [*keys, number], coords, seed)
        groups = ((groups - 1) >> bits) + 1
        if groups <= 1:
            return coreset.drop(number)


def mr_fft_coreset(points: DataFrame, K: int, L: int | None, coords=("x", "y"),
                   chunk_bits: int = CHUNK_BITS, seed=None) -> DataFrame:
    """Round 1: ``pid, it, id, <coords>`` -- up to K centers per group.

    ``L`` given: points are hashed into L buckets (one shuffle; the
    partitioning is a function of the ids and the number of points,
    reproducible anywhere), each cut into ``parts_of_bucket`` hashed parts; the points are
    counted first (for Parquet, from the files' footers).
    ``L=None``: FFT runs on the input splits, with no shuffle."""
    if L is None:
        return mr_fft_coreset_local(points, K, coords)
    parts = parts_of_bucket(points.count(), L, chunk_bits)
    if parts == 1:
        core = fft_groups(with_bucket(points, L), K, ["pid"], coords, seed)
    else:
        pid, part = bucket_and_part(id_key(points), int(L), parts)
        core = fft_groups(points.select("*", pid.alias("pid"), part.alias("part")), K, ["pid", "part"], coords, seed)
        core = merge_coresets(core, K, parts, "part", ["pid"], coords, chunk_bits, seed)
    return core.select("pid", "it", "id", *_coord_cols(coords))


def mr_fft_centers_from_coreset(coreset: DataFrame, K: int, L: int | None, coords=("x", "y"),
                                chunk_bits: int = CHUNK_BITS, seed=None) -> DataFrame:
    """Round 2: ``it, id, <coords>``.  The coreset holds at most L*K rows."""
    if L is None:
        # split-local round 1: the number of splits is measured, not known
        from farsight.session import materialize
        coreset = materialize(coreset)
        L = (coreset.agg(F.max("pid")).first()[0] or 0) + 1
    return merge_coresets(coreset, K, int(L), "pid", [], coords, chunk_bits, seed)


def mr_fft_centers(points: DataFrame, K: int, L: int | None, coords=("x", "y"),
                   chunk_bits: int = CHUNK_BITS, seed=None) -> DataFrame:
    """Rounds 1 and 2.  ``seed`` (with L given): a random first center, see ``fft_groups``."""
    if L is None and seed is not None:
        raise ValueError("a seeded start needs L: splits depend on the file layout")
    return mr_fft_centers_from_coreset(mr_fft_coreset(points, K, L, coords, chunk_bits, seed), K, L, coords, chunk_bits, seed)


def collect_centers(centers: DataFrame, coords=("x", "y")) -> list:
    """The centers as driver rows ordered by ``it``.  FFT returns at most K
    rows, so this is a parameter-sized transfer."""
    rows = centers.select("it", *_coord_cols(coords)).collect()
    return sorted(rows, key=lambda r: r["it"])


# --------------------------------------------------------------------------
# closest centers
# --------------------------------------------------------------------------

def _center_matrix(rows, coords) -> np.ndarray:
    if isinstance(coords, str):
        return np.stack([np.asarray(r[coords], dtype=np.float64) for r in rows])
    return np.asarray([[float(r[c]) for c in coords] for r in rows], dtype=np.float64)


class ClosestCenter:
    """Closest of K centers, for whole batches in numpy: squared distance and
    index, ties to the earlier center.  Distances are summed left to right, as
    everywhere else, so that the same double comes out whatever was skipped.

    2-D: a grid over the centers' box; each cell knows the centers that can
    be closest to a point in it (by the triangle inequality on boxes), a few
    whatever K is; points outside the box are compared with all.  Other
    dimensions: a matrix product gives distances up to a rounding bound, and
    only centers within it are measured."""

    def __init__(self, C: np.ndarray):
        self.C = C
        self.flat = C.shape[1] == 2 and len(C) > 8
        if self.flat:
            self._grid()

    def _grid(self) -> None:
        C, K = self.C, len(self.C)
        side = max(1, min(128, int(4 * np.sqrt(K)), int(np.sqrt(2e7 / K))))
        self.low, self.high = C.min(axis=0), C.max(axis=0)
        self.width = np.where(self.high > self.low, (self.high - self.low) / side, 1.0)
        # a point that rounding puts into the next cell still lies in that cell's wider box
        wide = 1e-9 * (np.abs(self.low) + np.abs(self.high) + self.width)
        at = np.stack(np.meshgrid(np.arange(side), np.arange(side), indexing="ij"), axis=-1).reshape(-1, 2)
        low, high = self.low + at * self.width - wide, self.low + (at + 1) * self.width + wide
        lists = []
        for i in range(0, len(at), 1024):
            near, far = _box_distances(low[i:i + 1024], high[i:i + 1024], C)
            may = near <= far.min(axis=1)[:, None] * (1 + 1e-12)
            lists += [np.flatnonzero(m) for m in may]
        self.side, self.many = side, np.array([len(x) for x in lists])
        self.list = np.zeros((len(lists), self.many.max()), np.int32)
        for i, x in enumerate(lists):
            self.list[i, :len(x)] = x

    def of(self, X: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(X):
            return np.zeros(0), np.zeros(0, np.int32)
        if X.shape[1] != self.C.shape[1]:
            raise ValueError(f"points of {X.shape[1]} and centers of {self.C.shape[1]} dimensions")
        if not self.flat:
            return self._all(X) if len(self.C) <= 8 or X.shape[1] < 3 else self._screened(X)
        best, which = np.empty(len(X)), np.empty(len(X), np.int32)
        inside = ((X >= self.low) & (X <= self.high)).all(axis=1)
        if not inside.all():
            out = np.flatnonzero(~inside)
            best[out], which[out] = self._all(X[out])
        at = np.flatnonzero(inside)
        cell = np.minimum(((X[at] - self.low) / self.width).astype(np.int64), self.side - 1)
        cell = cell[:, 0] * self.side + cell[:, 1]
        many = self.many[cell]
        order = np.argsort(-many, kind="stable")
        at, cell, many = at[order], cell[order], many[order]
        x, y = np.ascontiguousarray(X[at, 0]), np.ascontiguousarray(X[at, 1])
        b, w = np.full(len(at), np.inf), np.zeros(len(at), np.int32)
        cx, cy = np.ascontiguousarray(self.C[:, 0]), np.ascontiguousarray(self.C[:, 1])
        for j in range(int(many[0]) if len(many) else 0):
            n = int(np.searchsorted(-many, -j, "left"))  # those with more than j
            k = self.list[cell[:n], j]
            dx, dy = x[:n] - cx[k], y[:n] - cy[k]
            d = dx * dx + dy * dy
            less = d < b[:n]
            np.copyto(b[:n], d, where=less)
            np.copyto(w[:n], k, where=less)
        best[at], which[at] = b, w
        return best, which

    def _all(self, X: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, cols = len(X), _columns(X)
        best, which = np.full(n, np.inf), np.zeros(n, np.int32)
        d, tmp, less = np.empty(n), np.empty(n), np.empty(n, bool)
        for k in range(len(self.C)):
            _sq_into(cols, self.C[k], d, tmp)
            np.less(d, best, out=less)
            np.copyto(best, d, where=less)
            np.copyto(which, k, where=less)
        return best, which

    def _screened(self, X: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best, which = np.empty(len(X)), np.empty(len(X), np.int32)
        norms = np.square(self.C).sum(axis=1)
        step = max(1, 4_000_000 // len(self.C))
        for i in range(0, len(X), step):
            P = X[i:i + step]
            with np.errstate(over="ignore", invalid="ignore"):
                near = norms - 2 * (P @ self.C.T)
                slack = 1e-9 * (np.square(P).sum(axis=1) + norms.max()) + 1e-300
                # where sums overflow, all centers are measured
                row, k = np.nonzero(~(near > (near.min(axis=1) + slack)[:, None]))
            d = np.zeros(len(row))
            for j in range(P.shape[1]):
                t = P[row, j] - self.C[k, j]
                d += t * t
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            low = np.minimum.reduceat(d, first)
            hit = np.flatnonzero(d == np.repeat(low, np.diff(np.append(first, len(row)))))
            hit = hit[np.append(True, row[hit][1:] != row[hit][:-1])]
            best[i:i + step], which[i:i + step] = low, k[hit]
        return best, which


def _box_distances(low: np.ndarray, high: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance of each box to each center, rounded
    as the distances of points in the box are: never beyond theirs."""
    near = far = 0.0
    for j in range(C.shape[1]):
        below, above = low[:, j, None] - C[:, j], C[:, j] - high[:, j, None]
        t = np.maximum(0.0, np.maximum(below, above))
        near = near + t * t
        t = np.maximum(np.abs(below), np.abs(above))
        far = far + t * t
    return near, far


def kcenter_assign(points: DataFrame, centers: DataFrame, coords=("x", "y")) -> DataFrame:
    """Each point with its closest center: ``id, cid, d`` (``cid`` is the
    center's ``it``; ties go to the earlier center).

    The K centers (a set bounded by the parameter K) are collected once and
    travel inside an Arrow-batched numpy kernel."""
    rows = collect_centers(centers, coords)
    src = checked_points(points, coords)
    schema = _schema(src, "id") + ", cid int, d double"
    if not rows:
        return points.sparkSession.createDataFrame([], schema)
    near, cids = ClosestCenter(_center_matrix(rows, coords)), np.array([int(r["it"]) for r in rows], np.int32)

    def assign(batches):
        for b in batches:
            d, which = near.of(_matrix(b, coords))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cids[which]), pa.array(np.sqrt(d))], ["id", "cid", "d"])

    return src.mapInArrow(assign, schema)


#: Cells along a side of the grid whose boxes bound distances.
BOX_SIDE = 64


def _in_grid(src: DataFrame, coords, low, high, side: int = BOX_SIDE) -> Column:
    """Cell of a point on a grid over its first two coordinates; points
    outside go to the cells at the border."""
    first = [F.col(coords)[0], F.coalesce(F.get(F.col(coords), F.lit(1)), F.lit(0.0))] if isinstance(coords, str) else [F.col(c) for c in coords]

    def along(v: Column, a: float, b: float) -> Column:
        if not b > a:
            return F.lit(0)
        return F.least(F.lit(side - 1), F.greatest(F.lit(0), F.floor((v - F.lit(a)) * F.lit(side / (b - a))).cast("int")))

    return (along(first[0], low[0], high[0]) * side + along(first[1], low[1], high[1])).cast("int")


def kcenter_radii(points: DataFrame, sets: list, coords=("x", "y")) -> list[float | None]:
    """For each list of centers the largest distance of a point to its
    closest center (None: no point or no center), all from the same scans.

    2-D: one aggregation gives each cell's tight box.  Boxes bound the
    cell's farthest distance from both sides, and only points of cells that
    may hold a maximum go on to the exact kernel.  At most BOX_SIDE**2 boxes come to the driver."""
    src, found = checked_points(points, coords), [None] * len(sets)
    used = [i for i, rows in enumerate(sets) if rows]
    if not used:
        return found
    near = [ClosestCenter(_center_matrix(sets[i], coords)) for i in used]
    # a table of one split gains nothing: its only task measures at once what it reads
    if not isinstance(coords, str) and len(coords) == 2 and src.rdd.getNumPartitions() > 1:
        C = np.concatenate([n.C for n in near])
        cell = _in_grid(src, coords, C.min(axis=0), C.max(axis=0))
        x, y = coords
        boxes = (src.groupBy(cell.alias("cell")).agg(F.min(x).alias("a"), F.min(y).alias("b"), F.max(x).alias("c"), F.max(y).alias("d"))
                 .toArrow())
        if not boxes.num_rows:
            return found
        low, high = (np.column_stack([boxes.column(c).to_numpy() for c in pair]) for pair in ("ab", "cd"))
        open_ = np.zeros(boxes.num_rows, bool)
        for n in near:
            least, most = _box_distances(low, high, n.C)
            open_ |= most.min(axis=1) >= least.min(axis=1).max()
        if not open_.all():
            src = src.where(cell.isin(boxes.column("cell").to_numpy()[open_].tolist()))

    def farthest(batches):
        most = np.full(len(near), -1.0)
        for b in batches:
            X = _matrix(b, coords)
            if len(X):
                most = np.maximum(most, [n.of(X)[0].max() for n in near])
        yield pa.RecordBatch.from_pydict({f"d{i}": pa.array([v]) for i, v in enumerate(most)})

    row = src.mapInArrow(farthest, ", ".join(f"d{i} double" for i in range(len(near)))).agg(
        *[F.max(f"d{i}") for i in range(len(near))]).first()
    for i, v in zip(used, row):
        found[i] = None if v is None or v < 0 else float(np.sqrt(v))
    return found


def kcenter_radius(points: DataFrame, centers: DataFrame, coords=("x", "y")) -> DataFrame:
    """Round 3: one row ``radius`` = max over points of the distance to the
    closest center, see ``kcenter_radii``."""
    found = kcenter_radii(points, [collect_centers(centers, coords)], coords)
    return points.sparkSession.createDataFrame([(found[0],)], "radius double")


def non_center_points(points: DataFrame, centers: DataFrame) -> DataFrame:
    """Points that are not centers (anti join on id; the centers' size is
    checked before they are broadcast)."""
    few, _ = broadcast_if_small(centers.select("id"))
    return points.join(few, "id", "left_anti")


# --------------------------------------------------------------------------
# distributed traversal (exact)
# --------------------------------------------------------------------------

#: Points of a file of the traversal's working table.
FILE_POINTS = 1 << 20


def kcenter_global(points: DataFrame, K: int, coords=("x", "y"), trace: list | None = None) -> DataFrame:
    """Exact FFT over the whole distributed set: ``it, id, <coords>``.

    The points are written once to the work folder, sorted by the cell of a
    grid over their first two coordinates.  The driver keeps, for each cell
    (BOX_SIDE**2 at most), its box and its farthest point by the centers that
    were known when the cell was read last.  A new center that is farther from the
    box than that point's distance changes nothing in the cell; otherwise the
    old distance, and the box's largest distance, stay upper bounds.  A round
    reads the changed cells whose bound reaches the best lower bound, and
    no other; Parquet skips what they don't cover.  Every round starts from the files, so a lost
    executor costs one round's tasks.  ``trace`` gets the number of points read in each round."""
    from farsight.session import saved
    cc = _coord_cols(coords)
    spark, src = points.sparkSession, checked_points(points, coords)
    first = [F.col(coords)[0], F.coalesce(F.get(F.col(coords), F.lit(1)), F.lit(0.0))] if isinstance(coords, str) else [F.col(c) for c in cc]
    n, start, *edge = src.agg(F.count(F.lit(1)), F.min(F.struct("id", *cc)), F.min(first[0]), F.min(first[1]),
                              F.max(first[0]), F.max(first[1])).first()
    schema = "it int, " + _schema(src, "id", *cc)
    if not n or int(K) <= 0:
        return spark.createDataFrame([], schema)
    cell = _in_grid(src, coords, edge[:2], edge[2:])
    # a crowded cell spreads over several files
    held = saved(src.select(cell.alias("cell"), "id", *cc)
                 .repartitionByRange(-(-n // FILE_POINTS), F.col("cell"), F.xxhash64("id"))
                 .sortWithinPartitions("cell"), "cells")
    boxes = held.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min(first[0]).alias("a"), F.min(first[1]).alias("b"),
                                     F.max(first[0]).alias("c"), F.max(first[1]).alias("d")).toArrow()
    cells, sizes = boxes.column("cell").to_numpy(), boxes.column("n").to_numpy()
    low, high = (np.column_stack([boxes.column(c).to_numpy() for c in pair]) for pair in ("ab", "cd"))
    whole_box = len(cc) == 2  # the boxes hold all coordinates, so they bound distances from above too
    most = np.full(len(cells), np.inf)       # squared distance of the cell's farthest point, or more
    exact = np.zeros(len(cells), bool)
    best: list = [None] * len(cells)         # (id, coordinates) of that point, if exact
    least = np.full(len(cells), np.inf)      # every point of the cell is as far at least
    chosen = [start]
    place = {int(c): i for i, c in enumerate(cells)}
    while len(chosen) < int(K):
        near, far = _box_distances(low, high, _center_matrix([chosen[-1]], coords)[:, :2] if whole_box or not isinstance(coords, str)
                                   else _first_two(chosen[-1][coords]))
        exact &= near[:, 0] >= most
        if whole_box:
            most = np.where(exact, most, np.minimum(most, far[:, 0]))
        least = np.minimum(least, near[:, 0])
        bound = max(least.max(), most[exact].max(initial=0.0))
        read = np.flatnonzero(~exact & (most >= bound))
        if trace is not None:
            trace.append(int(sizes[read].sum()))
        if len(read):
            some = held if len(read) == len(cells) else held.where(F.col("cell").isin(cells[read].tolist()))
            for r in _farthest_of_cells(some, chosen, coords, cc):
                i = place[r["cell"]]
                most[i], best[i], exact[i] = -r["p"]["nd"], r["p"], True
        top = most[exact].max()
        if top == 0.0:
            break
        chosen.append(min((best[i] for i in np.flatnonzero(exact & (most == top))), key=lambda p: p["id"]))
    rows = [(i + 1, r["id"], *[r[c] for c in cc]) for i, r in enumerate(chosen)]
    return spark.createDataFrame(rows, schema)


def _first_two(v) -> np.ndarray:
    return np.array([[float(v[0]), float(v[1]) if len(v) > 1 else 0.0]])


def _farthest_of_cells(held: DataFrame, chosen: list, coords, cc: list[str]) -> list:
    """(cell, p) with p = (nd, id, <coords>) the cell's point farthest from
    the chosen centers, nd its squared distance, negative."""
    near = ClosestCenter(_center_matrix(chosen, coords))

    def farthest(batches):
        for b in batches:
            d = near.of(_matrix(b, coords))[0]
            cell = b.column("cell").to_numpy()
            ids = pc.rank(b.column("id"), tiebreaker="first").to_numpy()
            order = np.lexsort((ids, -d, cell))
            top = order[np.flatnonzero(np.append(True, cell[order][1:] != cell[order][:-1]))]
            out = b.take(pa.array(top))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(-d[top])], [*out.schema.names, "nd"])

    return (held.mapInArrow(farthest, _schema(held, *held.columns) + ", nd double")
            .groupBy("cell").agg(F.min(F.struct("nd", "id", *cc)).alias("p")).collect())
