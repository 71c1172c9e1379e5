"""Operator 10 -- SimHash fingerprints and the search for near ones.

A text's terms are its runs of five words, weighted by how often they occur.
Each term's 64-bit hash votes on every bit, for or against, with the term's weight; the
fingerprint keeps the sign of each sum.  Two fingerprints that differ in at
most RADIUS bits agree on at least two of five blocks, so ten permuted tables,
each keyed by two blocks, find every pair within the radius by equi-joins.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farsight.llm.util import SPACE, checked_broadcast, table
from farsight.session import saved

BITS, TERM_WORDS = 64, 5
RADIUS = 3
#: Widths of the blocks of a fingerprint; RADIUS + 2 of them.
BLOCKS = (13, 13, 13, 13, 12)
#: Rows are put in order within ranges of 2**RANGE_BITS ids, these within groups of 2**GROUP_BITS ranges.
RANGE_BITS, GROUP_BITS = 8, 12
_LAST = 9223372036854775807
_BLANK = " \\t\\n\\u000B\\f\\r"


def votes(texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys and fp (long), one row per key; ``texts`` has the columns keys and
    text, one row per key.

    White space is what separates words; case is ignored.  A text of fewer
    than five words is one term; one without words is the term of no word.
    Counters of two bits share a long, 32 bits each.
    """
    term = F.xxhash64("word", *[F.expr(f"get(words, i + {j})") for j in range(1, TERM_WORDS)])
    terms = (texts.withColumn("words", F.split(F.expr(f"btrim(lower(text), '{_BLANK}')"), SPACE)).drop("text")
             .select(*keys, "words", F.posexplode("words").alias("i", "word"))
             .where(f"i = 0 or i + {TERM_WORDS - 1} < size(words)")
             .select(*keys, term.alias("h")))
    half = BITS // 2
    sums = [F.sum(F.shiftright("h", b).bitwiseAND(F.lit(1 << half | 1))).alias(f"v{b}") for b in range(half)]
    counted = terms.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums)
    low = [f"if(2 * (v{b} & 4294967295L) > n, {1 << b}L, 0L)" for b in range(half)]
    high = [f"if(2 * shiftright(v{b}, 32) > n, {1 << b}L, 0L)" for b in range(half)]
    return counted.select(*keys, F.expr(f"shiftleft({' | '.join(high)}, 32) | ({' | '.join(low)})").alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _following(starts: DataFrame) -> DataFrame:
    """(range, next): for each range the first key of the next one that has
    rows, and after the last the first of all.  ``starts`` has (range, first)."""
    grouped = starts.withColumn("grp", F.shiftright("range", GROUP_BITS))
    groups = grouped.groupBy("grp").agg(F.min("first").alias("head"))
    order = Window.orderBy("grp")  # one row for 2**(RANGE_BITS + GROUP_BITS) ids
    groups = groups.select("grp", F.coalesce(F.lead("head").over(order), F.first("head").over(order)).alias("after"))
    inside = Window.partitionBy("grp").orderBy("range")
    return (grouped.withColumn("next", F.lead("first").over(inside)).join(groups, "grp")
            .select("range", F.coalesce("next", "after").alias("next")))


def permuted_keys(fp: Column) -> Column:
    """One key for each pair of blocks: the table's number and both blocks."""
    at, parts = 0, []
    for width in BLOCKS:
        parts.append((at, width))
        at += width
    keys = []
    for t, (a, b) in enumerate(combinations(parts, 2)):
        block = lambda p: F.shiftrightunsigned(fp, p[0]).bitwiseAND(F.lit((1 << p[1]) - 1))
        keys.append(F.shiftleft(F.lit(t).cast("long"), 32).bitwiseOR(F.shiftleft(block(a), 16)).bitwiseOR(block(b)))
    return F.array(*keys)


def search(queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (query, fp) with at most ``radius`` different bits, itself
    included; both inputs have a column fp, values distinct.  Exact for a
    radius up to RADIUS.  Null fingerprints find nothing."""
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"the permuted tables are exact up to a radius of {RADIUS}")
    right = fingerprints.select("fp", F.explode(permuted_keys(F.col("fp"))).alias("key"))
    left = queries.select(F.col("fp").alias("query"), F.explode(permuted_keys(F.col("fp"))).alias("key"))
    return (left.join(right, "key").where(F.bit_count(F.col("query").bitwiseXOR(F.col("fp"))) <= radius)
            .select("query", "fp").distinct())


def fingerprints(docs: DataFrame, every: int = 20) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    near_docs.

    The edited text has the last quarter of its code points replaced by as
    many from the start of the next row's text (all, if that has fewer), in
    ascending order of doc_id, nulls last, rows that repeat a doc_id by their
    text; the first follows the last.  near_docs counts the rows, itself
    excepted, with a fingerprint within RADIUS bits, for the rows whose
    doc_id is divisible by ``every``; else it is null.  A null text counts as empty; other columns are not read;
    an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
               .withColumn("k", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))) \
               .withColumn("range", F.shiftright("k", RANGE_BITS))
    after = saved(_following(rows.groupBy("range").agg(F.min("k").alias("first"))), "ranges")
    # the first row of the next range stands behind each range's last
    guests = (rows.select("doc_id", "text", "k")
              .join(checked_broadcast(after.select("range", F.col("next").alias("k")), 16), "k")
              .withColumn("guest", F.lit(True)))
    order = Window.partitionBy("range").orderBy("guest", "k", "text")
    n = F.length("text")
    edited = F.expr("concat(left(text, n_chars - n_chars div 4), left(coalesce(next_text, ''), cast(n_chars div 4 as int)))")
    lined = (rows.withColumn("guest", F.lit(False)).unionByName(guests)
             .withColumn("seq", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))
             .where(~F.col("guest")).withColumn("n_chars", n).withColumn("edited", edited)
             .withColumn("edited_sha256", F.sha2("edited", 256)))
    keys = ["range", "seq", "doc_id", "n_chars", "edited_sha256"]
    both = lined.select(*keys, F.posexplode(F.array("text", "edited")).alias("kind", "text"))
    voted = votes(both, [*keys, "kind"])
    got = saved(voted.groupBy(*keys).agg(F.max(F.expr("if(kind = 0, fp, null)")).alias("fp"),
                                         F.max(F.expr("if(kind = 1, fp, null)")).alias("edited_fp")), "fingerprints")
    in_range = Window.partitionBy("range").orderBy("seq")
    heads = got.where("seq = 1").select(F.col("range").alias("next_range"), F.col("fp").alias("head_fp"))
    heads = (after.withColumn("next_range", F.shiftright("next", RANGE_BITS)).join(heads, "next_range")
             .select("range", "head_fp"))
    counts = got.groupBy("fp").agg(F.count(F.lit(1)).alias("copies"),
                                   F.max((F.col("doc_id") % every == 0).cast("int")).alias("asked"))
    counts = saved(counts, "counts")
    near = (search(counts.where("asked = 1"), counts).join(counts.select("fp", "copies"), "fp")
            .groupBy(F.col("query").alias("fp")).agg((F.sum("copies") - 1).alias("near_docs")))
    return (got.withColumn("next_fp", F.lead("fp").over(in_range)).join(heads, "range")
            .join(near, "fp", "left")
            .select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
                    hex_of(F.col("fp")).alias("fingerprint"), hex_of(F.col("edited_fp")).alias("edited_fingerprint"),
                    likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                    likeness(F.col("fp"), F.coalesce("next_fp", "head_fp")).alias("near_next"),
                    F.when(F.col("doc_id") % every == 0, F.col("near_docs")).alias("near_docs")))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
