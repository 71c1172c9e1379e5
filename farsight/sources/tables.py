"""Readers.

The reference reads header-less text files of comma-separated floats (points)
and a line-per-item integer stream.  Both readers are here
(``read_points_text``, ``read_items_text``) with a fixed schema and FAILFAST
parsing, so a bad token fails the scan as the reference's ``float()`` does.

The driver's test data are Parquet tables; the three views below map them onto
the reference's data model (see FIXTURES.md):

* ``points2d``     id BIGINT, x DOUBLE, y DOUBLE       (from ``events``)
* ``points_nd``    id BIGINT, v ARRAY<DOUBLE>          (from ``embeddings``)
* ``stream_items`` pos BIGINT, item INT                (from ``events``)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def points2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("double").alias("x"),
        F.col("value").alias("y"),
    )


def points_nd(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("v"),
    )


def items_of(events: DataFrame) -> DataFrame:
    """``pos, item`` of an events table or stream."""
    return events.select(F.col("event_id").alias("pos"), F.floor(F.col("value") / 10).cast("int").alias("item"))


def timed_items_of(events: DataFrame, interval_s: int) -> DataFrame:
    """``items_of`` plus ``batch``: the arrival-time interval of each item
    (``ts`` cut into ``interval_s``-second intervals, time-zone free)."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return events.select(F.col("event_id").alias("pos"), F.floor(F.col("value") / 10).cast("int").alias("item"),
                         F.floor(micros / F.lit(int(interval_s) * 1_000_000)).cast("bigint").alias("batch"))


def stream_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(read_table(spark, sf_dir, "events"))


def stream_items_timed(spark: SparkSession, sf_dir: str, interval_s: int) -> DataFrame:
    """``stream_items`` plus ``batch``: the arrival-time micro-batch of each
    item.  Batches are variable in size and contiguous in ``pos``."""
    return timed_items_of(read_table(spark, sf_dir, "events"), interval_s)


def number(text: Column, kind: str) -> Column:
    """``text`` without surrounding white space as a ``kind``; anything else,
    an empty text too, fails the job whatever the session's ANSI mode."""
    return F.coalesce(F.trim(text).try_cast(kind), F.raise_error(F.concat(
        F.lit(f"not a {kind}: "), text)).cast(kind))


def read_points_text(spark: SparkSession, path: str, dims: int = 2) -> DataFrame:
    """Header-less CSV of ``dims`` floats per line -> ``id, x, y`` (dims=2)
    or ``id, v`` (dims>2).  A malformed or empty field, a blank line, or
    another number of fields fails the job.

    ``id`` is the line's dense place in file-name and line order; it does not
    depend on how files are split.
    """
    from farsight.functions.index import dense_index
    lines = dense_index(spark.read.text(path), "id", file_order=True)
    parts = lines.select("id", "value", F.split("value", ",", -1).alias("p"))
    sized = F.when(F.size("p") == dims, F.col("p")).otherwise(
        F.raise_error(F.concat(F.lit(f"not {dims} fields: "), F.col("value"))).cast("array<string>"))
    fields = [number(F.col("p")[i], "double") for i in range(dims)]
    rows = parts.select("id", sized.alias("p"))
    if dims == 2:
        return rows.select("id", fields[0].alias("x"), fields[1].alias("y"))
    return rows.select("id", F.array(*fields).alias("v"))


def read_items_text(spark: SparkSession, path: str) -> DataFrame:
    """One integer per line, blanks around it allowed -> ``pos, item``; any
    other line fails.  ``pos`` follows file-name order, then line order."""
    from farsight.functions.index import dense_index
    lines = dense_index(spark.read.text(path), "pos", file_order=True)
    return lines.select("pos", number(F.col("value"), "int").alias("item"))
