"""Helpers that the operators of this subpackage share: words, checked
broadcasts, fixed-size bitmaps and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.session import saved

#: Largest side, in bytes, that a join sends to every executor.
BROADCAST_BYTES = 8 << 20

#: A word is a maximal run of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of ``text`` (null: no words)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def checked_broadcast(side: DataFrame, row_bytes: Column | int = 64,
                      limit: int = BROADCAST_BYTES) -> DataFrame:
    """Save ``side``, measure it, and hint a broadcast only if it takes at
    most ``limit`` bytes; beyond that the join stays a shuffle join.
    ``row_bytes`` is the size of a row (a column if rows differ)."""
    side = saved(side, "side")
    cost = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    size = side.agg(F.sum(cost.cast("long"))).first()[0] or 0
    return F.broadcast(side) if size <= limit else side


def keyed(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` as a struct ``row``, with ``id``, its doc_id, and
    ``md5``, its text's; whatever the columns of ``docs`` are called, they stay in ``row`` as they are."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"),
                       F.md5(F.coalesce("text", F.lit(""))).alias("md5"))


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` of keyed() without those that ``gone`` (doc_id, text_md5) names."""
    side = checked_broadcast(gone.select(F.col("doc_id").alias("gone_id"), F.col("text_md5").alias("gone_md5")).distinct(), 64)
    return rows.join(side, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("md5") == F.col("gone_md5")), "left_anti")


def one_of_each(rows: DataFrame, keys: list[str], repeated: DataFrame) -> DataFrame:
    """``rows`` with one row of each key in ``repeated`` (columns keys); the
    other rows are not moved."""
    side = checked_broadcast(repeated.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)]), 96)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_r{i}"))
    return rows.join(side, same, "left_anti").unionByName(rows.join(side, same, "left_semi").dropDuplicates(keys))


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of ``2**bits`` bits with those set that the long column ``key``
    names (its low bits).  Its size is fixed, whatever the number of keys, so
    it may be sent to every task; it only saves work: a clear bit proves a key
    absent, a set bit proves nothing."""
    low = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    got = (keys.groupBy(F.shiftright(low, 6).cast("int").alias("cell"))
           .agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("word")).toArrow())
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[got["cell"].to_numpy()] = got["word"].to_numpy()
    return out.view(np.uint64)


def in_bitmap(found: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which uint64 ``keys`` have their bit set."""
    low = keys & np.uint64(found.size * 64 - 1)
    return (found[low >> np.uint64(6)] >> (low & np.uint64(63)) & np.uint64(1)).astype(bool)


def dense_sums(rows: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None], length: int,
               chunk: int = 4096) -> np.ndarray:
    """Sum of the integer arrays of ``length`` (a multiple of ``chunk``) that
    ``count`` makes of each task's batches of ``rows``.  Arrays travel in
    chunks, sums hold one copy of the array at most, and the result has a fixed size."""
    def short(v: np.ndarray) -> np.ndarray:
        return v.astype(np.uint32) if v.max(initial=0) < 1 << 32 else v

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = count(batches)
        if got is not None:
            parts = short(got).reshape(-1, chunk)
            used = np.flatnonzero(parts.any(axis=1))
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(used, pa.int32()), "sums": [parts[i].tobytes() for i in used]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums[i] = sums.get(i, 0) + np.frombuffer(raw, np.uint32 if len(raw) == 4 * chunk else np.int64).astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(sums), pa.int32()), "sums": [short(v).tobytes() for v in sums.values()]})

    # a chunk at a time, so that the driver holds the result and little else
    kind = "chunk int, sums binary"
    out = np.zeros(length, np.int64)
    got = rows.mapInArrow(trimmed(made), kind).repartition("chunk").mapInArrow(trimmed(add), kind).toArrow()
    for i, sums in zip(got["chunk"].to_pylist(), got["sums"]):
        out[i * chunk:(i + 1) * chunk] = np.frombuffer(raw := sums.as_buffer(), np.uint32 if raw.size == 4 * chunk else np.int64)
    del got
    pa.default_memory_pool().release_unused()
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``rows``, so that a few texts at a time become Python objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def trimmed(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``fn``, with what its task held given back to the system at its end:
    a Python worker lives on for other tasks and would keep its peak."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back()
    return task


def give_back() -> None:
    import ctypes
    import gc
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it has no such call
        pass


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of the undirected graph with edges (a, b): one row
    (node, label) per node that has an edge to another node, label the
    smallest node of the component.

    Hooking and pointer jumping: in each round a tree's root hooks onto the
    smallest label next to the tree, then labels jump twice.  Messages are minima, summed up before
    each shuffle, so a hub costs one row per task; rounds grow with the
    logarithm of the longest path.  Each round is written to the shared
    folder; only the number of changed rows comes to the driver.
    """
    both = saved(edges.where("a <> b").select("a", "b")
                 .unionByName(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b"), "edges")
    labels = saved(both.groupBy(F.col("a").alias("node"))
                   .agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        at = labels.select(F.col("node").alias("b"), F.col("label").alias("next"))
        offer = (both.join(at, "b").groupBy(F.col("a").alias("node")).agg(F.min("next").alias("low"))
                 .join(labels, "node"))
        # what a node hears goes to its root as well
        root = offer.groupBy(F.col("label").alias("node")).agg(F.min("low").alias("hook"))
        step = (offer.select("node", "label", F.least("label", "low").alias("low"))
                .join(root, "node", "left")
                .select("node", F.col("label").alias("was"), F.least("low", "hook").alias("label")))
        step = saved(step, "step")
        for _ in range(2):
            up = step.select(F.col("node").alias("label"), F.col("label").alias("top"))
            step = (step.join(up, "label", "left")
                    .select("node", "was", F.least("label", "top").alias("label")))
        step = saved(step, "labels")
        changed = step.where("was <> label").count()
        labels = step.select("node", "label")
        if not changed:
            return labels
