"""Operator 3 -- repeated passages found by winnowing over line hashes.

A gram is a line with as many of the next lines as it takes to hold GRAM_WORDS
words.  Of the grams that start within a window of RUN_WORDS - GRAM_WORDS
words, the one of smallest hash is a fingerprint, so every run of lines of
RUN_WORDS words or more that stands in two places has a fingerprint in
common.  Each fingerprint is joined with the first text that holds it, and with
the first that holds it together with the line before, or after, its gram;
within a text, with its position before.  Along such an alignment the match
is extended both ways, line by line, and the later run is deleted.

Windows are RANGE frames over the words before a line; texts are not shuffled
if the list of deleted lines is small enough to be sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farsight.llm.util import checked_broadcast, table, words
from farsight.session import saved

GRAM_WORDS, RUN_WORDS = 30, 50
_LAST = 9223372036854775807
_ID = ["id", "body"]


def hash60(text: Column) -> Column:
    """60 bits of the text's MD5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _named(docs: DataFrame) -> DataFrame:
    """id and body, a number of the text, name a document."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"), hash60(text).alias("body"), text.alias("text"))


def line_table(docs: DataFrame) -> DataFrame:
    """id, body, pos (of the line in the text), idx (among the lines that
    have words), h, words, before (words of the lines before), total."""
    lines = (_named(docs).select(*_ID, F.posexplode(F.split("text", "\n")).alias("pos", "line"))
             .select(*_ID, "pos", hash60(F.col("line")).alias("h"), F.size(words(F.col("line"))).cast("long").alias("words"))
             .where("words > 0").repartition(*_ID).dropDuplicates([*_ID, "pos"]))
    order = Window.partitionBy(*_ID).orderBy("pos")
    return (lines.withColumn("idx", F.row_number().over(order))
            .withColumn("before", F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("total", F.sum("words").over(Window.partitionBy(*_ID))))


def fingerprints(lines: DataFrame, gram: int = GRAM_WORDS, run: int = RUN_WORDS) -> DataFrame:
    """id, body, idx and hash g of each selected gram's first line, and span, its lines."""
    at = Window.partitionBy(*_ID).orderBy("before")
    grams = lines.withColumn("g", F.when(F.col("total") - F.col("before") >= gram, hash60(F.array_join(
        F.collect_list(F.col("h").cast("string")).over(at.rangeBetween(0, gram - 1)), ",")))) \
        .withColumn("span", F.count(F.lit(1)).over(at.rangeBetween(0, gram - 1)).cast("int"))
    chosen = F.min(F.when(F.col("g").isNotNull(), F.struct("g", "before", "idx", "span"))).over(at.rangeBetween(0, run - gram))
    return (grams.withColumn("chosen", chosen).where(F.col("total") - F.col("before") >= run)
            .select(*_ID, "chosen.g", "chosen.idx", "chosen.span").distinct())


def _keys(found: DataFrame, lines: DataFrame) -> DataFrame:
    """Each fingerprint as up to three keys: alone, with the line before its
    gram, and with the line after it, so that it meets the first holder of
    either continuation too."""
    sides = F.array(F.struct(F.lit(1).alias("k"), (F.col("idx") - 1).alias("at")), F.struct(F.lit(2).alias("k"), (F.col("idx") + F.col("span")).alias("at")))
    longer = (found.select(*_ID, "idx", "g", F.explode(sides).alias("x")).select(*_ID, "idx", "g", "x.k", "x.at")
              .join(lines.select(*_ID, F.col("idx").alias("at"), "h"), [*_ID, "at"]))
    return (longer.select(*_ID, "idx", F.struct("g", "k", "h").alias("key"))
            .unionByName(found.select(*_ID, "idx", F.struct("g", F.lit(0).alias("k"), F.lit(0).cast("long").alias("h")).alias("key"))))


def repeated_lines(docs: DataFrame, gram: int = GRAM_WORDS, run: int = RUN_WORDS) -> DataFrame:
    """id, body, pos of the lines that later copies of a run hold."""
    lines = saved(line_table(docs), "lines")
    found = saved(fingerprints(lines, gram, run), "fingerprints")
    keys = saved(_keys(found, lines).groupBy("key", *_ID).agg(F.min("idx").alias("idx")), "keys")
    place = F.struct("id", "body", "idx")
    first = keys.groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    across = (keys.join(first, "key").where(place > F.col("first"))
              .select(*_ID, F.col("first.id").alias("id0"), F.col("first.body").alias("body0"), (F.col("first.idx") - F.col("idx")).alias("shift")))
    # a text's own repeats: each against the one before, so that a period gives one shift
    own = Window.partitionBy("g", *_ID).orderBy("idx")
    within = (found.withColumn("shift", F.lag("idx").over(own) - F.col("idx")).where("shift IS NOT NULL")
              .select(*_ID, F.col("id").alias("id0"), F.col("body").alias("body0"), "shift"))
    aligned = across.unionByName(within).distinct()
    arrays = lines.groupBy(*_ID).agg(F.sort_array(F.collect_list(F.struct("idx", "pos", "h", "words"))).alias("rows"))
    sides = (aligned.join(arrays, _ID)
             .join(arrays.select(F.col("id").alias("id0"), F.col("body").alias("body0"), F.col("rows.h").alias("h0")), ["id0", "body0"]))
    same = (sides.select(*_ID, "id0", "body0", "shift", F.explode(F.expr(
        "filter(rows, x -> x.h <=> get(h0, x.idx - 1 + shift))")).alias("x"))
        .select(*_ID, "id0", "body0", "shift", "x.idx", "x.pos", "x.words"))
    path = [*_ID, "id0", "body0", "shift"]
    island = same.withColumn("island", F.col("idx") - F.row_number().over(Window.partitionBy(*path).orderBy("idx")))
    return (island.withColumn("length", F.sum("words").over(Window.partitionBy(*path, "island")))
            .where(F.col("length") >= gram).select(*_ID, "pos").distinct())


def dedup_lines(docs: DataFrame, gram: int = GRAM_WORDS, run: int = RUN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, any others) with the later copies of repeated
    runs of lines cut out of text; every row and column stays.

    The first copy in order of doc_id (nulls last), then of the text's hash,
    then of position, stays.  A run of ``run`` words or more is found at the
    first text that holds its fingerprint, or the fingerprint and the line
    next to its gram; where no such text holds the whole run, the part that one holds goes.
    Shorter runs, down to ``gram`` words, go where their grams are selected.
    Lines are compared as they are; lines without words are passed over and stay.  A text may
    become empty.  Rows that repeat doc_id and text are one document and all change alike; a null text stays
    null.  An empty table gives no rows.
    """
    gone = repeated_lines(docs, gram, run).groupBy("id", "body").agg(F.sort_array(F.collect_list("pos")).alias("gone"))
    gone = checked_broadcast(gone, F.size("gone") * 8 + 48)
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"), hash60(F.coalesce("text", F.lit(""))).alias("body"))
    kept = F.expr("if(gone is null, row.text, array_join(filter(split(row.text, '\\n'), (line, i) -> not array_contains(gone, i)), '\\n'))")
    return (marked.join(gone, _ID, "left")
            .select(*[kept.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (positions, joined by commas) and
    the MD5 of the text that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    was = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")
    gone = repeated_lines(docs).groupBy("id", "body").agg(F.sort_array(F.collect_list("pos")).alias("gone"))
    gone = checked_broadcast(gone, F.size("gone") * 8 + 48)
    kept = F.expr("if(gone is null, text, array_join(filter(split(text, '\\n'), (line, i) -> not array_contains(gone, i)), '\\n'))")
    named = (docs.withColumn("text", F.coalesce("text", F.lit("")))
             .withColumn("id", F.coalesce("doc_id", F.lit(_LAST))).withColumn("body", hash60(F.col("text"))))
    return (named.join(gone, _ID, "left")
            .select("doc_id", was.alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce(F.array_join(F.col("gone").cast("array<string>"), ","), F.lit("")).alias("removed"),
                    F.md5(kept).alias("kept_md5")))


OP3_SQL = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(doc_id, {_LAST}) AS id,
    CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS body FROM documents),
split_ AS (SELECT DISTINCT id, body, string_split(text, chr(10)) AS parts FROM docs),
raw AS (SELECT id, body, unnest(range(len(parts))) AS pos, unnest(parts) AS line FROM split_),
counted AS (
  SELECT id, body, pos, CAST('0x' || substr(md5(line), 1, 15) AS BIGINT) AS h,
    len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words
  FROM raw),
lines AS (
  SELECT *, row_number() OVER o AS idx, coalesce(sum(words) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(words) OVER (PARTITION BY id, body) AS total
  FROM counted WHERE words > 0 WINDOW o AS (PARTITION BY id, body ORDER BY pos)),
grams AS (
  SELECT *, count(*) OVER (PARTITION BY id, body ORDER BY before RANGE BETWEEN CURRENT ROW AND {GRAM_WORDS - 1} FOLLOWING) AS span,
    CASE WHEN total - before >= {GRAM_WORDS} THEN CAST('0x' || substr(md5(string_agg(CAST(h AS VARCHAR), ',') OVER (
      PARTITION BY id, body ORDER BY before RANGE BETWEEN CURRENT ROW AND {GRAM_WORDS - 1} FOLLOWING)), 1, 15) AS BIGINT) END AS g
  FROM lines),
chosen AS (
  SELECT id, body, total, before, min(CASE WHEN g IS NOT NULL THEN {{'g': g, 'before': before, 'idx': idx, 'span': span}} END) OVER (
      PARTITION BY id, body ORDER BY before RANGE BETWEEN CURRENT ROW AND {RUN_WORDS - GRAM_WORDS} FOLLOWING) AS c
  FROM grams),
found AS (SELECT DISTINCT id, body, c.g AS g, c.idx AS idx, c.span AS span FROM chosen WHERE total - before >= {RUN_WORDS}),
every_key AS (
  SELECT id, body, idx, g, 0 AS k, 0 AS h FROM found
  UNION ALL SELECT f.id, f.body, f.idx, g, 1, l.h FROM found f JOIN lines l ON l.id = f.id AND l.body = f.body AND l.idx = f.idx - 1
  UNION ALL SELECT f.id, f.body, f.idx, g, 2, l.h FROM found f JOIN lines l ON l.id = f.id AND l.body = f.body AND l.idx = f.idx + f.span),
keys AS (SELECT g, k, h, id, body, min(idx) AS idx FROM every_key GROUP BY g, k, h, id, body),
first_ AS (SELECT g, k, h, min({{'id': id, 'body': body, 'idx': idx}}) AS f FROM keys GROUP BY g, k, h HAVING count(*) > 1),
aligned AS (
  SELECT DISTINCT id, body, f.id AS id0, f.body AS body0, f.idx - idx AS shift
  FROM keys JOIN first_ USING (g, k, h) WHERE {{'id': id, 'body': body, 'idx': idx}} > f
  UNION SELECT id, body, id, body, shift FROM (
    SELECT id, body, lag(idx) OVER (PARTITION BY g, id, body ORDER BY idx) - idx AS shift FROM found) WHERE shift IS NOT NULL),
same AS (
  SELECT a.*, x.idx, x.pos, x.words, x.idx - row_number() OVER (PARTITION BY a.id, a.body, id0, body0, shift ORDER BY x.idx) AS island
  FROM aligned a JOIN lines x ON a.id = x.id AND a.body = x.body
  JOIN lines y ON y.id = id0 AND y.body = body0 AND y.idx = x.idx + shift AND y.h = x.h),
sized AS (SELECT *, sum(words) OVER (PARTITION BY id, body, id0, body0, shift, island) AS length FROM same),
gone AS (SELECT id, body, list_sort(list(DISTINCT pos)) AS gone FROM sized WHERE length >= {GRAM_WORDS} GROUP BY id, body)
SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  coalesce(array_to_string(gone, ','), '') AS removed,
  md5(CASE WHEN gone IS NULL THEN text ELSE coalesce(array_to_string(
    list_filter(string_split(text, chr(10)), lambda l, i: NOT list_contains(gone, i - 1)), chr(10)), '') END) AS kept_md5
FROM docs LEFT JOIN gone USING (id, body)
"""
