"""Operator 11 -- exact top-k search by Fagin's threshold algorithm.

Vectors are integer. The rows of a block (BLOCK rows of a task) are sorted
into one list per dimension. For a query, every list is read from its better
end, the rows met are scored whole, and the sum of the list heads times the
query bounds what is still unread: reading stops when that bound is below the
query's kth best score so far (at equality it goes on, a tie may have the
smaller id). Bounds are taken at depths that double, for all queries of a
chunk at once; once the lists would give most of a block anyway, its rest is
read to the end in one step.

Queries come in chunks of bounded size, each sent to every task; candidates
stay where they are.  A task keeps its k best of each query from block to
block, so later blocks start from a high kth score and many end at depth 0;
one window over what the tasks report gives the final ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farsight.llm.util import table, trimmed
from farsight.session import saved

SCALE, EVERY, TOP = 256, 50, 5
BLOCK = 8192
#: Bytes of query vectors that are sent at a time.
CHUNK_BYTES = 8 << 20
_LOW = np.iinfo(np.int64).min
#: Sums of products below this are exact in doubles.
_EXACT = float(1 << 53)


class Best:
    """The k best (score, vec_id, uid) of each query so far; ties to the smaller vec_id (null: largest), then uid."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), _LOW)
        self.id = np.zeros((queries, k), np.int64)
        self.null = np.ones((queries, k), bool)
        self.uid = np.full((queries, k), np.iinfo(np.int64).max)

    @property
    def kth(self) -> np.ndarray:
        return self.score[:, -1]

    def offer(self, query: np.ndarray, score: np.ndarray, id_: np.ndarray, null: np.ndarray, uid: np.ndarray) -> None:
        """Rows found, in any order; a row is offered once."""
        if not len(query):
            return
        some = np.unique(query)
        held = np.repeat(some, self.k)
        parts = [np.concatenate([new, old[some].reshape(-1)]) for new, old in
                 ((score, self.score), (id_, self.id), (null, self.null), (uid, self.uid))]
        q = np.concatenate([query, held])
        order = np.lexsort((parts[3], parts[1], parts[2], ~parts[0], q))
        q = q[order]
        begins = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
        keep = order[np.arange(len(q)) - np.repeat(begins, np.diff(np.append(begins, len(q)))) < self.k]
        for new, old in zip(parts, (self.score, self.id, self.null, self.uid)):
            old[some] = new[keep].reshape(len(some), self.k)


class Lists:
    """One sorted list per dimension of the rows of a block."""

    def __init__(self, rows: np.ndarray, exact: bool):
        self.rows = rows.astype(np.float64) if exact else rows
        self.order = np.argsort(rows, axis=0, kind="stable")  # best last
        self.sorted = np.take_along_axis(self.rows, self.order, axis=0)

    def bound(self, up: np.ndarray, down: np.ndarray, depth: int) -> np.ndarray:
        """What a row that no list shows before ``depth`` can score at most;
        ``up`` and ``down`` are the queries' positive and negative parts."""
        return up @ self.sorted[len(self.rows) - 1 - depth] + down @ self.sorted[depth]

    def met(self, q: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Rows at depths ``start`` to ``stop`` of the lists as ``q`` reads them."""
        n = len(self.rows)
        return np.concatenate([self.order[n - stop:n - start][:, q > 0].reshape(-1), self.order[start:stop][:, q < 0].reshape(-1)])


def threshold_search(best: Best, queries: np.ndarray, own: np.ndarray, rows: np.ndarray, uid: np.ndarray, id_: np.ndarray,
                     null: np.ndarray) -> int:
    """Offers a block's rows to ``best`` until no unread row can matter.
    ``own`` are the queries' uids, which are not offered.  Returns the number of rows scored."""
    n, dims = rows.shape
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, dims)
    exact = top < _EXACT
    lists = Lists(rows, exact)
    q = queries.astype(np.float64) if exact else queries
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    active = np.arange(len(q))
    seen: dict[int, np.ndarray] = {}
    scored = depth = 0
    step = 1
    while len(active) and n:
        active = active[lists.bound(up[active], down[active], depth) >= best.kth[active]]
        if not len(active):
            break
        if (depth + step) * dims * 2 >= n:
            # the rest of the block, for the queries that still need it
            for at in range(0, len(active), 512):
                part = active[at:at + 512]
                s = (q[part] @ lists.rows.T).astype(np.int64)
                for i, k in enumerate(part.tolist()):
                    if k in seen:
                        s[i, seen[k]] = _LOW
                s[own[part][:, None] == uid[None, :]] = _LOW
                # of the block's rows only its k best can matter, and what ties with the kth
                least = np.maximum(best.kth[part], np.partition(s, n - best.k, axis=1)[:, n - best.k] if n > best.k else _LOW)
                i, r = np.nonzero((s >= least[:, None]) & (s > _LOW))
                i, r = _few(i, r, s[i, r], id_, null, uid, best.k)
                best.offer(part[i], s[i, r], id_[r], null[r], uid[r])
                scored += s.size
            break
        found_q, found_r, found_s = [], [], []
        for k in active.tolist():
            r = np.unique(lists.met(q[k], depth, depth + step))
            if k in seen:
                r = np.setdiff1d(r, seen[k], assume_unique=True)
            seen[k] = np.concatenate([seen[k], r]) if k in seen else r
            s = (lists.rows[r] @ q[k]).astype(np.int64)
            scored += len(r)
            keep = (s >= best.kth[k]) & (uid[r] != own[k])
            found_q.append(np.full(int(keep.sum()), k))
            found_r.append(r[keep])
            found_s.append(s[keep])
        r = np.concatenate(found_r)
        best.offer(np.concatenate(found_q), np.concatenate(found_s), id_[r], null[r], uid[r])
        depth += step
        step = depth
    return scored


def _few(i: np.ndarray, r: np.ndarray, s: np.ndarray, id_: np.ndarray, null: np.ndarray, uid: np.ndarray, k: int):
    """The first k of each i, so that ties stay few."""
    order = np.lexsort((uid[r], id_[r], null[r], ~s, i))
    i, r = i[order], r[order]
    begins = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else i
    keep = np.arange(len(i)) - np.repeat(begins, np.diff(np.append(begins, len(i)))) < k
    return i[keep], r[keep]


def integer_vectors(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and x, the components times ``scale`` rounded down, of the rows
    whose vector is not null and holds neither nulls nor non-finite numbers."""
    c = F.col(column)
    fit = c.isNotNull() & ~F.exists(c, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.where(fit).select(F.col("vec_id").cast("long").alias("vec_id"),
                                     F.transform(c, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column, short ones filled up with 0."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if (sizes == dims).all():
        return flat.reshape(len(column), dims)
    out = np.zeros((len(column), dims), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def nearest(rows: DataFrame, every: int = EVERY, k: int = TOP, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The ``k`` rows of ``rows`` (vec_id, x) with the highest inner product
    with each row whose vec_id is divisible by ``every``: query_id, rank,
    vec_id, score; equal scores by ascending vec_id, null ids last.

    A row is not its own candidate, other rows of the same vec_id are; each
    row of a repeated query id is answered (under the same query_id).  A null
    vec_id is no query.  Vectors of different length count as filled up with
    0.  Fewer than k other rows are all given; an empty table gives no rows.
    Scores have to fit into 64 bits.  The number of queries sent at a time is
    bounded by ``chunk_bytes``; all are answered.
    """
    spark = rows.sparkSession
    held = saved(rows.select("vec_id", "x").withColumn("uid", F.monotonically_increasing_id()), "vectors")
    asked = held.where(F.col("vec_id") % every == 0)
    n, dims = held.agg(F.count(F.when(F.col("vec_id") % every == 0, 1)), F.max(F.size("x"))).first()
    empty = spark.createDataFrame([], "query long, vec_id long, uid long, score long")
    found = []
    chunks = -(-n // max(1, chunk_bytes // (8 * max(1, dims or 1) + 8))) if n else 0
    # a chunk is a hash class of uids, so it is found again without numbering the queries
    part = F.pmod(F.xxhash64("uid"), F.lit(max(1, chunks)))
    for c in range(chunks):
        got = asked.where(part == c).select("uid", "x").toArrow().combine_chunks()
        if not got.num_rows:
            continue
        sent = spark.sparkContext.broadcast((got.column("uid").to_numpy(), _matrix(got.column("x").combine_chunks(), dims)))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own, queries = sent.value
            best = Best(len(own), k)
            for b in batches:
                for at in range(0, b.num_rows, BLOCK):
                    block = b.slice(at, BLOCK)
                    ids = block.column(0)
                    threshold_search(best, queries, own, _matrix(block.column(1), queries.shape[1]), block.column(2).to_numpy(),
                                     ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
            q, j = np.nonzero(best.score > _LOW)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[q], pa.int64()), pa.array(best.id[q, j], pa.int64(), mask=best.null[q, j]),
                 pa.array(best.uid[q, j], pa.int64()), pa.array(best.score[q, j], pa.int64())], ["query", "vec_id", "uid", "score"])

        found.append(saved(held.mapInArrow(trimmed(search), empty.schema), "found"))
        sent.unpersist()
    every_found = empty
    for f in found:
        every_found = every_found.unionByName(f)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    ranked = every_found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return (ranked.join(asked.select(F.col("uid").alias("query"), F.col("vec_id").alias("query_id")), "query")
            .select("query_id", "rank", "vec_id", "score"))


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(integer_vectors(table(spark, sf_dir, "embeddings")))


OP11_SQL = """
WITH v AS (SELECT row_number() OVER () AS u, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.u AS qu, q.vec_id AS query_id, c.u, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))) AS BIGINT) AS score
      FROM v q JOIN v c ON c.u <> q.u WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY qu ORDER BY score DESC, vec_id ASC NULLS LAST, u) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
