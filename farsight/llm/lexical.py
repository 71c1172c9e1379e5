"""Operator 13 -- ranked lexical search by pipelined term partitioning.

The documents are cut into shards, and each shard's postings lists are built
where its texts are read, without a shuffle of texts.  Terms belong to owners,
one per band of document frequency, rarest first.  Bundles of items visit the
owners one after another: at each stage a bundle meets, by a cogroup over
(bundle, shard), the postings lists that the owner holds of that shard, and
adds their integer contributions to its sparse document accumulators.  Since
the rarest terms come first, few accumulators travel; those that the frequent
terms touch are met last and leave only the best of each item.

A group holds one bundle and one shard, both of bounded size, however many
documents share a term; a term of all documents has one short list per shard.
Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from farsight.llm.shingles import hashed_texts
from farsight.llm.util import bitmap, checked_broadcast, in_bitmap, table, trimmed
from farsight.session import saved

TOP = 20
#: A shard ends with so many documents, or once it holds so many postings.
SHARD_DOCS, SHARD_POSTINGS = 4096, 1 << 20
BUNDLE_ITEMS = 256
#: Owners hold the terms up to this share of the documents, the last one the rest.
OWNERS = (1 / 256, 1 / 16)
VOCABULARY_BITS = 23

#: Anything but digits, letters and what is not ASCII separates terms; only A-Z are lower-cased.
_TERM = bytes(c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: Contributions are added as doubles below this sum, which is exact, else as integers.
_EXACT = 1 << 53
_PIECE = 1 << 19


def term_hashes(texts: list) -> list[np.ndarray]:
    """For each text the hashes of its terms in order (null: none)."""
    raws = [(t or "").encode("utf-8", "surrogatepass").translate(_TERM) for t in texts]
    return [f[0].view(np.int64) for f in hashed_texts(raws)] if raws else []


def _shards(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Postings lists of ``docs`` (doc_id, text): shard, doc_ids, ns, and the
    terms whose bit is set in ``wanted``: term, ends, places, tfs.  A shard's documents are in order of doc_id, nulls last."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def made(no: int, ids: list, ns: list, docs_of: list, terms: list, tfs: list) -> pa.RecordBatch:
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
        rank = np.empty(len(ids), np.int32)
        rank[order] = np.arange(len(ids))
        term, tf = np.concatenate(terms), np.concatenate(tfs)
        place = rank[np.repeat(np.arange(len(ids)), docs_of)]
        by = np.lexsort((place, term))
        term, tf, place = term[by], tf[by], place[by]
        new = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
        one = lambda v, kind: pa.array([v], pa.list_(kind))
        return pa.RecordBatch.from_arrays(
            [pa.array([no], pa.int64()), one([ids[i] for i in order], pa.int64()), one(np.array(ns, np.int64)[order], pa.int64()),
             one(term[new], pa.int64()), one(np.append(new[1:], len(term)).astype(np.int32) if len(new) else new, pa.int32()),
             one(place, pa.int32()), one(tf, pa.int32())], ["shard", "doc_ids", "ns", "terms", "ends", "places", "tfs"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        no, held, size = TaskContext.get().partitionId() << 32, ([], [], [], [], []), 0
        found = sent.value
        for b in batches:
            for at in range(0, b.num_rows, 128):
                part = b.slice(at, 128)
                for doc_id, h in zip(part.column(0).to_pylist(), term_hashes(part.column(1).to_pylist())):
                    u, n = np.unique(h[in_bitmap(found, h.view(np.uint64))], return_counts=True)
                    for to, x in zip(held, (doc_id, len(h), len(u), u, n.astype(np.int32))):
                        to.append(x)
                    size += len(u)
                    if len(held[0]) >= SHARD_DOCS or size >= SHARD_POSTINGS:
                        yield made(no, *held)
                        no, held, size = no + 1, ([], [], [], [], []), 0
        if held[0]:
            yield made(no, *held)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        trimmed(index), "shard long, doc_ids array<long>, ns array<long>, terms array<long>, ends array<int>, places array<int>, tfs array<int>")


def _add(scores: np.ndarray, bound: int, item: np.ndarray, weight: np.ndarray, first: np.ndarray, many: np.ndarray,
         place: np.ndarray, gain: np.ndarray) -> None:
    """Adds weight * gain of each posting (its document ``place``) and each of the ``many`` items from ``first`` on."""
    width = scores.shape[1]
    flat = scores.reshape(-1)
    ends = np.cumsum(many)
    at = 0
    while at < len(many):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PIECE, "right")))
        k = many[at:stop]
        entry = np.repeat(first[at:stop] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
        spot = item[entry] * width + np.repeat(place[at:stop], k)
        value = weight[entry] * np.repeat(gain[at:stop], k)
        if bound < _EXACT:
            flat += np.bincount(spot, value, len(flat)).astype(np.int64)
        else:
            np.add.at(flat, spot, value)
        at = stop


def _visit(terms_of: np.ndarray, item_of: np.ndarray, weight_of: np.ndarray, m: np.ndarray, scores: np.ndarray, lists) -> None:
    """One owner's postings lists (term, places, tfs) added to ``scores`` (items x documents)."""
    bound = int(weight_of.sum()) * 1_000_000
    terms, sizes, places, tfs = lists
    low, high = np.searchsorted(terms_of, terms, "left"), np.searchsorted(terms_of, terms, "right")
    first, many = np.repeat(low, sizes), np.repeat(high - low, sizes)
    gain = (1_000_000_000 * tfs) // (1000 * tfs + 12 * m[places])
    _add(scores, bound, item_of, weight_of, first, many, places, gain)


def _lists(t: pa.Table) -> tuple:
    places = t.column("places").combine_chunks()
    sizes = np.diff(places.offsets.to_numpy())
    flat = lambda c: c.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return t.column("term").to_numpy(), sizes, flat(places), flat(t.column("tfs").combine_chunks())


#: A bundle on its way: its items' terms, the m of its shard's documents, and its accumulators.
_BUNDLE = ("bundle long, shard long, terms array<long>, items array<int>, weights array<long>, ms array<long>, "
           "spots array<int>, scores array<long>")


def _stage(key: tuple, bundle: pa.Table, postings: pa.Table) -> pa.Table:
    if not postings.num_rows or not bundle.num_rows:
        return bundle
    row = {c: bundle.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
           for c in ("terms", "items", "weights", "ms", "spots", "scores")}
    acc = np.zeros((BUNDLE_ITEMS, len(row["ms"])), np.int64)
    acc.reshape(-1)[row["spots"]] = row["scores"]
    _visit(row["terms"], row["items"].astype(np.int64), row["weights"], row["ms"], acc, _lists(postings))
    spots = np.flatnonzero(acc)
    out = bundle.set_column(6, "spots", pa.array([spots.astype(np.int32)], pa.list_(pa.int32())))
    return out.set_column(7, "scores", pa.array([acc.reshape(-1)[spots]], pa.list_(pa.int64())))


def _best(top: int):
    def fn(key: tuple, bundle: pa.Table, postings: pa.Table) -> pa.Table:
        t = _stage(key, bundle, postings)
        out = [np.zeros(0, np.int64)] * 4
        if t.num_rows:
            width = len(t.column("ms").combine_chunks().flatten())
            spots, scores = (t.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("spots", "scores"))
            item, place = spots // max(1, width), spots % max(1, width)
            by = np.lexsort((place, -scores, item))
            item, place, scores = item[by], place[by], scores[by]
            begins = np.flatnonzero(np.append(True, item[1:] != item[:-1])) if len(item) else item
            rank = np.arange(len(item)) - np.repeat(begins, np.diff(np.append(begins, len(item))))
            keep = (rank < top) & (scores > 0)
            n = int(keep.sum())
            out = [np.full(n, t.column("bundle")[0].as_py()) * BUNDLE_ITEMS + item[keep], np.full(n, t.column("shard")[0].as_py()), place[keep], scores[keep]]
        return pa.table({k: pa.array(v, pa.int64()) for k, v in zip(("no", "shard", "place", "score"), out)})
    return fn


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` rows of ``docs`` (doc_id, text) for each row of ``items``
    (item_id, text): item_id, rank, doc_id, score; highest score first, equal
    scores by ascending doc_id, null doc_ids last.

    Only scores above 0 are given, so an item without terms, or none of whose
    terms any document holds, has no row; a null text has no terms and an
    empty table gives no rows.  Rows that repeat count each: a repeated
    document takes a rank of its own, a repeated item is answered each time
    (under the same item_id).  Texts are read whole, however long; other
    columns are not read.
    """
    numbered = saved(_numbered(items.select(F.col("item_id").cast("long").alias("item_id"), "text")), "items")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(h, return_counts=True) for h in term_hashes(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(b.column(0).to_numpy(), [len(u) for u, _ in found]), pa.int64()),
                 pa.array(np.concatenate([u for u, _ in found]) if found else [], pa.int64()),
                 pa.array(np.concatenate([n for _, n in found]) if found else [], pa.int64())], ["no", "term", "times"])

    asked = saved(numbered.select("no", "text").mapInArrow(trimmed(split), "no long, term long, times long"), "asked")
    shards = saved(_shards(docs, bitmap(asked.select(F.col("term").alias("key")), VOCABULARY_BITS)), "shards")
    n_docs, words = shards.agg(
        F.sum(F.expr("cast(size(filter(ns, x -> x > 0)) as long)")), F.sum(F.expr("aggregate(ns, 0L, (s, x) -> s + x)"))).first()
    if not n_docs:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    size = F.expr("e - if(i = 0, 0, ends[i - 1])")
    lists = (shards.select("shard", "terms", "places", "tfs", "ends", F.posexplode("ends").alias("i", "e"))
             .select("shard", F.expr("terms[i]").alias("term"), size.alias("df"),
                     F.slice("places", F.col("e") - size + 1, size).alias("places"), F.slice("tfs", F.col("e") - size + 1, size).alias("tfs")))
    df = shards.select(F.posexplode("ends").alias("i", "e"), "ends", "terms").select(F.expr("terms[i]").alias("term"), size.cast("long").alias("df")) \
               .groupBy("term").agg(F.sum("df").alias("df"))
    owner = F.lit(0)
    for share in OWNERS:
        owner = owner + (F.col("df") > share * n_docs).cast("int")
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * F.lit(n_docs) + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    entries = saved(asked.join(df, "term").select(
        "term", owner.alias("owner"), F.floor(F.col("no") / BUNDLE_ITEMS).cast("long").alias("bundle"),
        F.pmod("no", F.lit(BUNDLE_ITEMS)).cast("int").alias("item"), (weight * F.col("times")).alias("weight")), "entries")

    held = entries.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("term", "item", "weight"))).alias("l"))
    m = F.expr(f"transform(ns, x -> 75L + (25L * x * {n_docs}L) div {words}L)")
    # one row per bundle and shard: a bundle starts without accumulators
    last = (numbered.count() - 1) // BUNDLE_ITEMS
    starts = shards.select("shard", m.alias("ms"), F.explode(F.expr(f"sequence(0L, {last}L)")).alias("bundle"))
    bundles = (starts.join(checked_broadcast(held, F.size("l") * 24 + 16), "bundle")
               .select("bundle", "shard", F.col("l.term").alias("terms"), F.col("l.item").alias("items"), F.col("l.weight").alias("weights"),
                       "ms", F.expr("cast(array() as array<int>)").alias("spots"), F.expr("cast(array() as array<long>)").alias("scores")))
    lists = saved(lists.drop("df"), "lists")
    for k in range(len(OWNERS) + 1):
        owned = lists.join(checked_broadcast(entries.where(F.col("owner") == k).select("term", "bundle").distinct(), 16), "term")
        visit = bundles.groupBy("bundle", "shard").cogroup(owned.select("bundle", "shard", "term", "places", "tfs").groupBy("bundle", "shard"))
        if k < len(OWNERS):
            bundles = visit.applyInArrow(_stage, _BUNDLE)
        else:
            best = visit.applyInArrow(_best(int(top)), "no long, shard long, place long, score long")
    ids = shards.select("shard", F.posexplode("doc_ids").alias("place", "doc_id"))
    best = saved(best, "best").join(ids.withColumn("place", F.col("place").cast("long")), ["shard", "place"]).join(
        numbered.select("no", "item_id"), "no")
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "shard", "place")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= int(top))
            .select("item_id", "rank", "doc_id", "score"))


def _numbered(items: DataFrame) -> DataFrame:
    """``items`` with a dense number, so that bundles are full."""
    from farsight.functions.index import dense_index
    return dense_index(items, "no").select("no", "text", "item_id")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS l FROM documents),
q AS (SELECT row_number() OVER () AS v, item_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS l FROM benchmark),
asked AS (SELECT v, item_id, t, count(*) AS times FROM (SELECT v, item_id, unnest(l) AS t FROM q) GROUP BY ALL),
post AS (SELECT u, doc_id, n, t, count(*) AS tf FROM (SELECT u, doc_id, len(l) AS n, unnest(l) AS t FROM d) GROUP BY ALL),
tot AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(l)) AS BIGINT) AS big_l FROM d WHERE len(l) > 0),
df AS (SELECT t, count(*) AS df FROM post GROUP BY t),
w AS (SELECT t, CAST(floor(1000.0::DOUBLE * ln((2.0::DOUBLE * big_n + 2.0::DOUBLE) / (2.0::DOUBLE * df + 1.0::DOUBLE))) AS BIGINT) AS w FROM df, tot),
s AS (SELECT v, item_id, u, doc_id,
             CAST(sum(times * w.w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * big_n) // big_l))))) AS BIGINT) AS score
      FROM asked JOIN post USING (t) JOIN w USING (t), tot GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY v ORDER BY score DESC, doc_id ASC NULLS LAST, u) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
"""
