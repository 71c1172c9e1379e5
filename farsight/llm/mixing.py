"""Operator 1 -- mixing sources to target weights by a low-discrepancy schedule.

Every source is laid out as a stream of words in a shuffled order of its
documents and cut into equal blocks.  A schedule of slots draws the next
source: slot s stands at the golden-ratio point of s, and the source whose
interval of the cumulated weights holds that point gets the slot.  The r-th
slot of a source takes its block r, modulo its number of blocks.  Any run of
slots, not the whole schedule alone, is near the target weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farsight.llm.util import checked_broadcast, keyed, one_of_each, table, words
from farsight.session import saved

#: Words of a block at most.
BLOCK = 64
#: Points have 31 bits; GOLDEN is the odd number next to 2**31 over the golden ratio.
GRID, GOLDEN = 1 << 31, 1327217885
#: The interval of the points is cut into so many cells to find the source of a point by an equi-join.
CELL_BITS = 12
#: Documents of a source are first dealt into so many groups of their shuffled order, so that no window holds a whole source.
GROUPS = 1024
#: Slots of a run within which they are ranked.
RUN = 4096


def source_plan(sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Targets by water-filling, one row per row of ``sizes`` (source,
    source_size), which has one row per source: a catalogue entry, not data.

    Weights 5, 2, 1 repeat over the sources by code point, null last.  The
    level that fills all words is found in closed form: with sources by rising
    cap per unit of weight, the first ones are full.
    """
    n = F.col("source_size")
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weighed = sizes.withColumn("weight", F.element_at(
        F.array(F.lit(5), F.lit(2), F.lit(1)), ((F.row_number().over(by_name) - 1) % 3 + 1).cast("int")).cast("long"))
    cap = 3 * n
    filling = Window.orderBy((cap / F.col("weight")), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    step = (weighed.withColumn("total", F.sum("source_size").over(everything))
            .withColumn("full", F.coalesce(F.sum(cap).over(before), F.lit(0)))
            .withColumn("left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
            .withColumn("level", (F.col("total") - F.col("full")).cast("double") / F.col("left").cast("double")))
    # the level rises while sources fill up and falls from the first one that stays open
    open_level = F.max("level").over(everything)
    planned = (step.withColumn("level", open_level)
               .withColumn("target", F.when(n == 0, F.lit(0.0)).otherwise(
                   F.least(cap.cast("double"), F.col("weight") * F.col("level")))))
    blocks = F.expr(f"(source_size + {block} - 1) div {block}")
    planned = (planned.withColumn("blocks", blocks)
               .withColumn("block_words", F.expr("if(source_size = 0, 0, (source_size + blocks - 1) div blocks)"))
               .withColumn("blocks", F.expr("if(source_size = 0, 0, (source_size + block_words - 1) div block_words)"))
               # slots wanted, that the words of the blocks come to the target
               .withColumn("slots", F.expr("if(source_size = 0, 0D, target * blocks / source_size)")))
    upto = by_name.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (planned.withColumn("high", F.sum("slots").over(upto))
            .withColumn("all_slots", F.sum("slots").over(everything))
            .withColumn("rank", F.row_number().over(by_name))
            .withColumn("high", F.expr(f"if(all_slots = 0, 0, cast(round(high / all_slots * {GRID}) as bigint))"))
            .withColumn("low", F.lag("high", 1, 0).over(by_name))
            .withColumn("all_slots", F.expr("cast(round(all_slots) as bigint)"))
            .select("source", "source_size", "target", "blocks", "block_words", "low", "high", "all_slots"))


def shuffled(key: Column) -> Column:
    """60 bits that order documents at random, the same in every run."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 15), 16, 10).cast("long")


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, text_md5,
    size, source, source_size, target, taken.

    ``taken`` is the number of the row's words in the mix, repeats counted; no
    row exceeds 3 times its size.  A null text has no words, takes none; a
    null source is a source of its own, the last; rows that repeat a doc_id
    stay rows of their own, side by side in the shuffled order; other columns
    are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = saved(docs.select("doc_id", "source", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), F.size(words(F.col("text"))).cast("long").alias("size"))
                 .withColumn("place", shuffled(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), "sizes")
    plan = saved(source_plan(rows.groupBy("source").agg(F.sum("size").alias("source_size")), block), "plan")
    known = checked_broadcast(plan.withColumn("sid", F.xxhash64(F.col("source").isNull(), "source")), 128)

    # where each row starts in its source's stream: groups first, then rows within a group
    grouped = rows.withColumn("sid", F.xxhash64(F.col("source").isNull(), "source")) \
                  .withColumn("part", F.expr(f"place % {GROUPS}"))
    starts = (grouped.groupBy("sid", "part").agg(F.sum("size").alias("n"))
              .withColumn("part_start", F.coalesce(F.sum("n").over(
                  Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("n"))
    inside = Window.partitionBy("sid", "part").orderBy("place", F.col("doc_id").isNull(), "doc_id", "size", "text_md5") \
                   .rowsBetween(Window.unboundedPreceding, -1)
    placed = (grouped.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(starts, ["sid", "part"])
              .withColumn("start", F.col("start") + F.col("part_start"))
              .join(known.drop("source"), "sid")
              .select("sid", "doc_id", "text_md5", "source", "size", "start", "source_size", "target", "block_words"))

    # the schedule: slot -> point -> source -> rank within the source
    total = plan.agg(F.max("all_slots")).first()[0] or 0
    slots = spark.range(total).select(
        F.col("id").alias("slot"), F.expr(f"(id % {GRID}) * {GOLDEN} % {GRID}").alias("point"))
    shift = 31 - CELL_BITS
    cells = known.where("high > low").select(
        "sid", "low", "high", "blocks", F.explode(F.expr(f"sequence(low >> {shift}, (high - 1) >> {shift})")).alias("cell"))
    cells = checked_broadcast(cells, 48)
    drawn = (slots.withColumn("cell", F.expr(f"point >> {shift}")).join(cells, "cell")
             .where("point >= low and point < high")
             .select("sid", "blocks", F.expr(f"slot div {RUN}").alias("run"), F.expr(f"slot % {RUN}").alias("at")))
    ahead = (drawn.groupBy("sid", "run").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("super", F.expr(f"run div {RUN}")))
    blocks_before = (ahead.groupBy("sid", "super").agg(F.sum("n").alias("n"))
                     .withColumn("far", F.coalesce(F.sum("n").over(
                         Window.partitionBy("sid").orderBy("super").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                     .drop("n"))
    ahead = (ahead.withColumn("near", F.coalesce(F.sum("n").over(
        Window.partitionBy("sid", "super").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .join(blocks_before, ["sid", "super"])
        .select("sid", "run", (F.col("near") + F.col("far")).alias("ahead")))
    ranked = (drawn.withColumn("own", F.row_number().over(Window.partitionBy("sid", "run").orderBy("at")) - 1)
              .join(ahead, ["sid", "run"])
              .withColumn("rank", F.col("own") + F.col("ahead")))
    uses = (ranked.where("rank < 3 * blocks")  # rounding may draw a full source once too often
            .groupBy("sid", F.expr("rank % blocks").alias("block")).agg(F.count(F.lit(1)).alias("uses")))

    # blocks of equal length, joined with the slots that use them
    pieces = (placed.where("size > 0")
              .withColumn("block", F.explode(F.expr("sequence(start div block_words, (start + size - 1) div block_words)")))
              .withColumn("words", F.expr(
                  "least(start + size, (block + 1) * block_words) - greatest(start, block * block_words)")))
    key = ["sid", "start", "doc_id", "text_md5", "source", "size", "source_size", "target"]
    taken = (pieces.join(uses, ["sid", "block"], "left")
             .groupBy(*key).agg(F.sum(F.expr("words * coalesce(uses, 0L)")).alias("taken")))
    out = ["doc_id", "text_md5", "size", "source", "source_size", "target", "taken"]
    return taken.select(*out).unionByName(placed.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(*out))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with source_size, target and
    taken; a taken of k sizes stands for k passes over the row.  Rows that repeat doc_id, text and source
    are one row of the result, their taken words together.  All other columns stay as they
    are, whatever their names; earlier source_size, target and taken are replaced.
    Null and empty texts have no words, so the mix takes none of them; no rows give none."""
    found = (mix(docs).groupBy(F.col("doc_id").alias("of_id"), F.col("text_md5").alias("of_md5"), F.col("source").alias("of_from"))
             .agg(F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.sum("taken").alias("taken"),
                  F.count(F.lit(1)).alias("n")).where("taken > 0"))
    found = saved(found, "mix")
    marked = keyed(docs).withColumn("from", F.col("row.source"))
    twice = found.where("n > 1").select(F.col("of_id").alias("id"), F.col("of_md5").alias("md5"), F.col("of_from").alias("from"))
    once = one_of_each(marked, ["id", "md5", "from"], twice)
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("md5") == F.col("of_md5")) & F.col("from").eqNullSafe(F.col("of_from"))
    side = checked_broadcast(found.drop("n"), 112)
    made = ("source_size", "target", "taken")
    return once.join(side, same).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in made], *made)


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("text_md5")


OP1_SQL = rf"""
WITH rows_ AS (
  SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS BIGINT) AS size,
         CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) AS place
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM rows_ GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS w FROM sizes),
levels AS (
  SELECT *, CAST(sum(n) OVER () - coalesce(sum(3 * n) OVER f, 0) AS DOUBLE)
            / CAST(sum(w) OVER () - coalesce(sum(w) OVER f, 0) AS DOUBLE) AS level
  FROM weighed
  WINDOW f AS (ORDER BY CAST(3 * n AS DOUBLE) / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, n, CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE least(CAST(3 * n AS DOUBLE),
           w * max(level) OVER ()) END AS target,
         (n + {BLOCK - 1}) // {BLOCK} AS b0
  FROM levels),
blocked AS (SELECT *, CASE WHEN n = 0 THEN 0 ELSE (n + b0 - 1) // b0 END AS bw FROM targets),
slotted AS (
  SELECT *, CASE WHEN n = 0 THEN 0 ELSE (n + bw - 1) // bw END AS blocks,
         CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE target * ((n + bw - 1) // bw) / n END AS slots
  FROM blocked),
summed AS (
  SELECT *, sum(slots) OVER (ORDER BY source IS NULL, source ROWS UNBOUNDED PRECEDING) AS upto, sum(slots) OVER () AS total
  FROM slotted),
highs AS (SELECT *, CASE WHEN total = 0 THEN 0 ELSE CAST(round(upto / total * {GRID}) AS BIGINT) END AS high FROM summed),
plan AS (SELECT *, lag(high, 1, 0) OVER (ORDER BY source IS NULL, source) AS low FROM highs),
slots_ AS (
  SELECT s.range AS slot, (s.range % {GRID}) * {GOLDEN} % {GRID} AS point
  FROM range((SELECT CAST(round(max(total)) AS BIGINT) FROM plan)) s),
drawn AS (SELECT p.source, p.blocks, slot FROM slots_ JOIN plan p ON point >= low AND point < high),
ranked AS (SELECT source, blocks, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS r FROM drawn),
uses AS (SELECT source, r % blocks AS block, count(*) AS uses FROM ranked WHERE r < 3 * blocks GROUP BY ALL),
placed AS (
  SELECT r.*, p.n, p.target, p.bw,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY place % {GROUPS}, place, doc_id IS NULL, doc_id, r.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM rows_ r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source),
pieces AS (
  SELECT *, unnest(range(CAST(start // bw AS BIGINT), CAST((start + size - 1) // bw + 1 AS BIGINT))) AS block FROM placed WHERE size > 0),
taken AS (
  SELECT p.doc_id, p.size, p.source, p.n, p.target, p.start,
         sum((least(start + size, (p.block + 1) * bw) - greatest(start, p.block * bw)) * coalesce(uses, 0)) AS taken
  FROM pieces p LEFT JOIN uses u ON p.source IS NOT DISTINCT FROM u.source AND p.block = u.block
  GROUP BY ALL)
SELECT doc_id, size, source, n AS source_size, target, CAST(taken AS BIGINT) AS taken FROM taken
UNION ALL SELECT doc_id, size, source, n, target, 0 FROM placed WHERE size = 0
"""
