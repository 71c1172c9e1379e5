"""Operator 8 -- benchmark decontamination by containment search.

Size-partitioned MinHash.  Items are partitioned by their number of distinct
shingles (powers of two), documents, for each such class, by how many of the
class's shingles they hold.  If a document of a partition holds a share t of
an item, then their sets, both taken within the class's shingles, have a
Jaccard similarity of at least t q / (u + q - t q), with q the least size of
the item class and u the largest of the document partition.  That bound says
how many bands of one minimum each make two such sets meet with a probability
of 1 - MISS at least; documents and items that share a band are candidates,
verified by exact containment of the item's shingles in the whole document.
A document's sets cover the whole document, so an item is found wherever its pieces stand.

What tasks know of the benchmark is one bitmap of fixed size per item class;
they only save rows, signatures and verification decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.llm.shingles import SHINGLE, mixed, shingles, word_hashes
from farsight.llm.util import bitmap, checked_broadcast, in_bitmap, keyed, slices, table, trimmed, without
from farsight.session import saved

THRESHOLD = 0.8
#: Chance that the bands miss a pair that is just at the threshold.
MISS = 1e-6
#: Bitmaps: bits of each item class's, and of the one of all shingles.
CLASS_BITS, MAP_BITS = 22, 25


def _item_shingles(items: DataFrame) -> DataFrame:
    """item_no, words of a shingle, distinct shingles."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for no, w in zip(b.column(0).to_pylist(), word_hashes(b.column(1).to_pylist(), plain=True)):
                if len(w):
                    rows.append({"item_no": no, "span": min(SHINGLE, len(w)), "shingles": np.unique(shingles(w)).view(np.int64).tolist()})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("item_no", pa.int64()), ("span", pa.int32()), ("shingles", pa.list_(pa.int64()))])
    return items.select("item_no", "text").mapInArrow(trimmed(cut), "item_no long, span int, shingles array<long>")


def size_class(n: np.ndarray | int) -> np.ndarray | int:
    """0 for one shingle, else p for more than 2**(p - 1) and up to 2**p."""
    return np.ceil(np.log2(np.maximum(1, n))).astype(int)


def bands(u: int, q: int, threshold: float) -> int:
    """Bands of one minimum that a set of up to ``u`` shingles and an item of ``q`` or more need."""
    least = min(1.0, threshold * q / (u + q - threshold * q))
    return 1 if least >= 1 else int(np.ceil(np.log(MISS) / np.log1p(-least)))


def minima(s: np.ndarray, many: int) -> np.ndarray:
    """The least of ``many`` hash functions over the distinct shingles ``s``."""
    g = np.random.default_rng(8)
    out, step = np.empty(many, np.uint64), max(1, 1_000_000 // len(s))
    seeds = g.integers(0, 1 << 63, many, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, many, step):
            out[at:at + step] = mixed(mixed(s[None, :] + seeds[at:at + step, None])).min(axis=1)
    return out


def _least_size(c: int) -> int:
    return 1 if c == 0 else (1 << (c - 1)) + 1


def _signed(sets: DataFrame, kind: str) -> DataFrame:
    """``<kind>, span, class, band, low`` of ``sets`` (<kind>, span, class, many, s): ``many`` bands of the shingles s."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [minima(np.array(s, np.int64).view(np.uint64), many).view(np.int64) for s, many in
                     zip(b.column(4).to_pylist(), b.column(3).to_pylist())]
            sizes = [len(f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(np.repeat(b.column(i).to_numpy(), sizes)) for i in range(3)],
                 pa.array(np.concatenate([np.arange(n) for n in sizes]).astype(np.int32)), pa.array(np.concatenate(found))],
                [kind, "span", "class", "band", "low"])

    return sets.select(kind, "span", "class", "many", "s").mapInArrow(trimmed(sign), f"{kind} long, span int, class int, band int, low long")


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (doc_id, text_md5, item_id, containment) of ``docs`` (doc_id,
    text) and ``benchmark`` (item_id, text): the largest share of the item's
    distinct shingles that the document holds, if ``threshold``
    or more.

    Case and punctuation are ignored.  An item of one to four words is one
    shingle of that many words; a null text, or one without words, has no
    shingles and is in no pair.  Rows that repeat a doc_id and a text give a
    pair once, as do items that repeat an item_id and a text; null ids are
    kept.  Other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    named = saved(benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
                  .withColumn("item_no", F.monotonically_increasing_id()), "items")
    items = saved(_item_shingles(named), "signed_items")
    in_class = F.ceil(F.log2(F.size("shingles"))).cast("int")
    items = items.withColumn("class", in_class)
    groups = sorted((r[0], r[1]) for r in items.select("span", "class").distinct().collect())  # one per span and power of two
    keys = items.select("span", "class", F.explode("shingles").alias("key"))
    of_class = {g: bitmap(keys.where((F.col("span") == g[0]) & (F.col("class") == g[1])), CLASS_BITS) for g in groups}
    found = spark.sparkContext.broadcast((of_class, bitmap(keys, MAP_BITS)))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_class, every = found.value
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part_rows = b.slice(at, 512)
                docs_, spans_, sets, held = [], [], [], []
                for i, w in enumerate(word_hashes(part_rows.column(1).to_pylist(), plain=True)):
                    for span in {g[0] for g in of_class}:
                        if len(w) < span:
                            continue
                        s = shingles(w, span)
                        s = np.unique(s[in_bitmap(every, s)])
                        some = []
                        for g, map_ in of_class.items():
                            if g[0] == span:
                                own = s[in_bitmap(map_, s)]
                                # fewer than the least item of the class asks for: no item of it is held
                                if len(own) >= threshold * _least_size(g[1]) - 1e-9:
                                    u = 1 << int(size_class(len(own)))
                                    some.append({"class": g[1], "many": bands(u, _least_size(g[1]), threshold), "s": own.view(np.int64)})
                        if some:
                            docs_.append(i)
                            spans_.append(span)
                            sets.append(some)
                            held.append(s.view(np.int64))
                if docs_:
                    yield pa.RecordBatch.from_arrays(
                        [part_rows.column(0).take(pa.array(docs_)), pa.array(spans_, pa.int32()),
                         pa.array(sets, pa.list_(pa.struct([("class", pa.int32()), ("many", pa.int32()), ("s", pa.list_(pa.int64()))]))),
                         pa.array(held, pa.list_(pa.int64()))], ["row", "span", "sets", "held"])

    rows = docs.select(F.struct("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5")).alias("row"),
                       F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = saved(rows.mapInArrow(trimmed(probe), f"row struct<doc_id: {kind}, text_md5: string>, span int, "
                                 "sets array<struct<class: int, many: int, s: array<long>>>, held array<long>")
                 .withColumn("row_no", F.monotonically_increasing_id()), "seen")
    found.destroy()
    sets = seen.select("row_no", "span", F.explode("sets").alias("x")).select("row_no", "span", "x.class", "x.many", "x.s")
    # items sign as many bands as the largest partition of documents asks for
    most = sets.groupBy("span", "class").agg(F.max("many").alias("many"))
    signed_items = _signed(items.join(most, ["span", "class"]).withColumnRenamed("shingles", "s"), "item_no")
    on = ["span", "class", "band", "low"]
    candidates = (_signed(sets, "row_no").join(checked_broadcast(signed_items, 32), on).select("row_no", "item_no").distinct())
    shared = F.size(F.array_intersect("shingles", "held")) / F.size("shingles")
    verified = (candidates.join(seen.select("row_no", "row", "held"), "row_no")
                .join(checked_broadcast(items.select("item_no", "shingles"), F.size("shingles") * 8 + 32), "item_no")
                .select("row.doc_id", "row.text_md5", "item_no", shared.alias("containment"))
                .where(F.col("containment") >= threshold))
    return (verified.groupBy("doc_id", "text_md5", "item_no").agg(F.max("containment").alias("containment"))
            .join(checked_broadcast(named.select("item_no", "item_id"), 24), "item_no")
            .groupBy("doc_id", "text_md5", "item_id").agg(F.max("containment").alias("containment")))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay
    as they are, whatever their names.  Rows with a null text, or a null doc_id
    and no item, stay; an empty benchmark keeps all rows, and no rows give none."""
    return without(keyed(docs), leaks(docs, benchmark)).select("row.*")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP8_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
plain AS (SELECT doc_id, md5(text) AS text_md5, list_filter(regexp_split_to_array(translate(lower(text),
                 '!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~', repeat(' ', 32)), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
b AS (SELECT row_number() OVER () AS no, item_id, text FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark)),
bw AS (SELECT no, item_id, list_filter(regexp_split_to_array(translate(lower(text),
              '!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~', repeat(' ', 32)), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM b),
bs AS (SELECT no, item_id, least(5, len(w)) AS span, list_distinct(list_transform(range(1, len(w) - least(5, len(w)) + 2),
              lambda i: array_to_string(w[i:i + least(5, len(w)) - 1], ' '))) AS s FROM bw WHERE len(w) > 0),
grams AS (SELECT no, item_id, span, len(s) AS size, unnest(s) AS g FROM bs),
held AS (SELECT doc_id, text_md5, span, unnest(list_distinct(list_transform(range(1, len(w) - span + 2),
                lambda i: array_to_string(w[i:i + span - 1], ' ')))) AS g
         FROM plain, (SELECT DISTINCT span FROM bs) WHERE len(w) >= span),
pairs AS (SELECT doc_id, text_md5, no, item_id, count(*) / CAST(any_value(size) AS DOUBLE) AS containment
          FROM held JOIN grams USING (span, g) GROUP BY doc_id, text_md5, no, item_id)
SELECT doc_id, text_md5, item_id, max(containment) AS containment FROM pairs WHERE containment >= 0.8 GROUP BY ALL
"""
