"""Dense 0-based row index without a single-partition sort.

``monotonically_increasing_id`` is ``partition << 33 | row-in-partition``.
Rows are grouped by their input split (partition, and for file scans the
file path and block start from Spark's ``_metadata`` column); the small
split table (one row per split) gets each split's offset from a window in
split order, and a row's index is its split's offset plus its position
within the split.  The split table is counted and broadcast only if it is
small, so the work stays distributed.

Split order is (file path, block start) for file scans -- the files' name
and byte order, not Spark's packing order, which puts large files first --
and the partition order otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farsight.operators.joins import broadcast_if_small

_LOW33 = (1 << 33) - 1


def dense_index(df: DataFrame, name: str = "pos", file_order: bool = False) -> DataFrame:
    """Add ``name``: 0..n-1.  ``file_order`` requires ``df`` to be a file
    scan (it reads ``_metadata``)."""
    cols = df.columns
    tagged = df.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_part", F.shiftright("_mid", 33)) \
                   .withColumn("_low", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    keys = ["_part"]
    order = ["_part"]
    if file_order:
        tagged = tagged.withColumn("_file", F.col("_metadata.file_path")) \
                       .withColumn("_block", F.col("_metadata.file_block_start"))
        keys = ["_part", "_file", "_block"]
        order = ["_file", "_block", "_part"]
    splits = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_low").alias("_first"))
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(*keys, "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    # a row per split: broadcast only if they are few
    few, _ = broadcast_if_small(offsets)
    out = tagged.join(few, keys)
    out = out.withColumn(name, F.col("_off") + F.col("_low") - F.col("_first"))
    return out.select(*cols, name)
