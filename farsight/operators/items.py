"""Exact item statistics over an item table ``pos BIGINT, item INT``.

``pos`` is the 0-based arrival position; it stands in for stream order.
All aggregations are partial + final HashAggregates: a hot item (even a third
of all rows) is one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farsight.functions.params import check_items_params


def length_col(items: DataFrame, n: int | None) -> Column:
    """The stream length n: a literal when given, else the table's row
    count as a scalar subquery."""
    if n is not None:
        if int(n) <= 0:
            raise ValueError(f"n must be > 0, got {n!r}")
        return F.lit(int(n)).cast("bigint")
    return items.agg(F.count(F.lit(1)).cast("bigint")).scalar()


def item_histogram(items: DataFrame) -> DataFrame:
    """``item, cnt``."""
    return items.groupBy("item").agg(F.count(F.lit(1)).cast("bigint").alias("cnt"))


def stream_stats(items: DataFrame) -> DataFrame:
    """``n_items, n_distinct, max_item`` (exact).  The distinct count is a
    two-level aggregation keyed by item, so no set is gathered in one task."""
    per_item = items.groupBy("item").agg(F.count(F.lit(1)).alias("c"))
    return per_item.agg(F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("n_items"),
                        F.count(F.lit(1)).cast("bigint").alias("n_distinct"),
                        F.max("item").alias("max_item"))


def frequent_exact(items: DataFrame, phi: float, n: int | None = None) -> DataFrame:
    """True frequent items: ``item, cnt`` with cnt > phi*n (strict)."""
    check_items_params(phi)
    thr = F.lit(float(phi)) * length_col(items, n)
    return item_histogram(items).where(F.col("cnt") > thr)


def stream_cutoff(items: DataFrame, n: int, batch_size: int | None = None) -> DataFrame:
    """Items consumed by a micro-batched reader that stops after the batch
    holding the n-th item: all whole batches up to and including it.

    Batches are the ``batch`` column when present (e.g. arrival-time
    intervals, variable in size) else ``pos div batch_size``.  Batches are
    contiguous in ``pos``, so the cut-off batch is simply the batch of the
    item at ``pos = n-1`` (a one-row scalar subquery); a stream shorter than
    n is consumed whole.  Returns ``pos, item, batch``."""
    if int(n) <= 0:
        raise ValueError("n must be > 0")
    if "batch" not in items.columns:
        if batch_size is None or int(batch_size) <= 0:
            raise ValueError("batch_size must be > 0 when items have no batch column")
        b = F.floor(F.col("pos") / F.lit(int(batch_size))).cast("bigint")
        items = items.select("pos", "item", b.alias("batch"))
    else:
        items = items.select("pos", "item", F.col("batch").cast("bigint").alias("batch"))
        at_n = items.where(F.col("pos") == int(n) - 1).agg(F.max("batch")).scalar()
        return items.where(at_n.isNull() | (F.col("batch") <= at_n))
    # floor(pos / bs) <= last  <=>  pos < (last + 1) * bs for pos >= 0: a plain
    # range on pos, which Parquet pushdown uses to skip row groups
    end = ((int(n) - 1) // int(batch_size) + 1) * int(batch_size)
    return items.where(F.col("pos") < F.lit(end))
