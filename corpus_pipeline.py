"""A corpus pipeline over the table documents: each stage writes Parquet that
the next one reads.

1. quality   documents that the classifier rejects go
2. lines     later copies of repeated passages are cut out of the texts
3. near      one document of each group of near copies stays
4. leaks     documents that hold a benchmark item go
5. mix       sources are mixed to their target weights
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.llm.decontam import drop_leaks
from farsight.llm.linededup import dedup_lines
from farsight.llm.mixing import mixed_documents
from farsight.llm.neardup import drop_near_duplicates
from farsight.llm.quality import drop_low_quality
from farsight.llm.util import table
from farsight.session import saved


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup_lines(docs)
    if "n_chars" in docs.columns:  # it says how long the text is
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents taken, with source_size, target and taken (words, repeats counted)."""
    return mixed_documents(docs)


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("leaks", leaks), ("mix", mix)]

#: A fitted classifier and weighted sampling are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
