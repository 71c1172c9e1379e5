"""Item streams.

A stream is a streaming DataFrame with ``pos BIGINT, item INT`` (``pos`` is
the arrival position) and, where whole batches matter, ``batch BIGINT``.  It
is read with ``readStream`` straight from the folder (or file) that holds the
table.  Streams of plain lines, which have no positions, are numbered as they
arrive (``farsight.streaming.items.arrivals``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.sources.tables import read_table, items_of, timed_items_of


def table_stream(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """The table as a stream of its files, oldest first, ``files_per_trigger``
    of them in a micro-batch (None: all there are)."""
    table = read_table(spark, sf_dir, name)
    reader = spark.readStream.schema(table.schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", int(files_per_trigger))
    root = sf_dir.rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}.parquet")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return reader.parquet(f"{root}/{name}.parquet")
    # a file source watches a folder; of this one it takes the table's only file
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(root)


def item_stream(spark: SparkSession, sf_dir: str, batch_size: int | None = None, interval_s: int | None = None,
                files_per_trigger: int | None = None) -> DataFrame:
    """``stream_items`` as a stream: ``pos, item``, and ``batch`` if batches
    have ``batch_size`` items or ``interval_s`` seconds of arrival time."""
    events = table_stream(spark, sf_dir, "events", files_per_trigger)
    if interval_s is not None:
        return timed_items_of(events, interval_s)
    items = items_of(events)
    return items if batch_size is None else items.withColumn("batch", F.floor(F.col("pos") / F.lit(int(batch_size))).cast("bigint"))


def item_text_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A line-per-integer stream (the reference's input format) from text
    files, oldest first: one ``value`` column."""
    return (spark.readStream.option("maxFilesPerTrigger", int(files_per_trigger))
            .text(path))
