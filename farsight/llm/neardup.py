"""Operator 6 -- near duplicates by improved consistent weighted sampling.

Texts are sets of five-word shingles weighted by TF-IDF.  Consistent weighted
sampling draws, for each of HASHES hash functions, one (shingle, level) such that two
texts draw the same with the probability of their weighted Jaccard similarity.
BANDS keys of ROWS draws each put texts into buckets; the pairs that buckets
propose are verified by the exact weighted similarity; verified pairs are
edges whose components are the classes.  Large buckets propose stars; where a
star leaves several components, an exact prefix filter proposes every pair of
them that may still be alike, likeliest first, so no bucket is too large to be searched whole.

Document frequencies come from a count sketch of fixed size (CELLS counters,
the mean load taken off), so the weights take one pass, no shuffle of
shingles, and a broadcast of 4 MB whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.llm.shingles import mixed, shingles, word_hashes
from farsight.llm.util import bitmap, checked_broadcast, connected_components, dense_sums, in_bitmap, keyed, one_of_each, slices, table, trimmed, without
from farsight.session import saved

THRESHOLD = 0.8
BANDS, ROWS = 12, 3
HASHES = BANDS * ROWS
CELL_BITS = 20
CELLS = 1 << CELL_BITS
#: How far IDF moves a weight: a shingle of a text with many copies must not lose the weight that makes the copies alike.
IDF_SHARE = 0.1
#: Buckets of up to so many texts propose all their pairs; larger ones a star, then what the prefix filter lets through.
ALL_PAIRS = 8
_TABLE = 1 << 16
#: Sums of weights in different orders differ by less.
_SLACK = 1e-6


def _cells(s: np.ndarray) -> np.ndarray:
    """Counter of each shingle: the low bits of its 32-bit form."""
    return (s >> np.uint64(32)).astype(np.int64) & (CELLS - 1)


def _document_counts(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Counters of distinct shingles by cell, and the number of texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total, held, size = np.zeros(CELLS + 4096, np.int64), [], 0
        for b in slices(batches):
            for w in word_hashes(b.column(0).to_pylist()):
                total[CELLS] += 1
                held.append(_cells(np.unique(shingles(w))))
                size += len(held[-1])
                if size > 2_000_000:
                    total[:CELLS] += np.bincount(np.concatenate(held), minlength=CELLS)
                    held, size = [], 0
        if held:
            total[:CELLS] += np.bincount(np.concatenate(held), minlength=CELLS)
        return total

    total = dense_sums(texts, count, CELLS + 4096)
    return total[:CELLS], int(total[CELLS])


def cell_weights(counts: np.ndarray, n: int) -> np.ndarray:
    """IDF by cell, between 1 - IDF_SHARE and 1."""
    df = np.maximum(1.0, counts - counts.mean())
    idf = np.clip(np.log((n + 1) / (df + 1)) / np.log(n + 2), 0, 1)
    return (1 - IDF_SHARE + IDF_SHARE * idf).astype(np.float32)


class Sampler:
    """Improved consistent weighted sampling: gamma(2, 1) variables r and c
    and uniform beta of each (hash, shingle) come from a table."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        g = np.random.default_rng(6)
        r, c = (-np.log(g.random((2, _TABLE)) * g.random((2, _TABLE)))).astype(np.float64)
        self.r, self.beta, self.log_c = r.astype(np.float32), g.random(_TABLE).astype(np.float32), np.log(c).astype(np.float32)
        self.odd = (g.integers(0, 1 << 63, HASHES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.band = g.integers(0, 1 << 63, (BANDS, ROWS + 1), dtype=np.uint64) | np.uint64(1)

    def keys(self, s: np.ndarray) -> np.ndarray:
        """The BANDS keys of a text with the shingles ``s``, at least one."""
        u, tf = np.unique(s, return_counts=True)
        log_w = np.log(tf * self.weights[_cells(u)]).astype(np.float32)
        drawn = np.empty(HASHES, np.uint64)
        step = max(1, min(HASHES, 60_000 // len(u)))
        with np.errstate(over="ignore"):
            for at in range(0, HASHES, step):
                i = (u[None, :] * self.odd[at:at + step, None] >> np.uint64(48)).astype(np.intp)
                r, beta = self.r[i], self.beta[i]
                t = np.floor(log_w / r + beta)
                log_a = self.log_c[i] - r * (t - beta) - r
                best = log_a.argmin(axis=1)  # a tie goes to the smaller shingle
                level = t[np.arange(len(best)), best].astype(np.int64).astype(np.uint64)
                drawn[at:at + step] = mixed(u[best] + mixed(level + np.uint64(1 << 40)))
            d = drawn.reshape(BANDS, ROWS)
            return mixed((d * self.band[:, :ROWS]).sum(axis=1, dtype=np.uint64) + self.band[:, ROWS]).view(np.int64)


    def rarity(self, s: np.ndarray) -> float:
        """Mean weight of the shingles: least for the text of a group that differs least from the others."""
        return float(self.weights[_cells(s)].mean(dtype=np.float64))


def packed(s: np.ndarray) -> bytes:
    """A text's shingles, 32 bits each, sorted, repeats kept."""
    return np.sort((s >> np.uint64(32)).astype(np.uint32)).tobytes()


def weighted_jaccard(a: bytes, b: bytes, weights: np.ndarray) -> float:
    ua, na = np.unique(np.frombuffer(a, np.uint32), return_counts=True)
    ub, nb = np.unique(np.frombuffer(b, np.uint32), return_counts=True)
    wa, wb = na * weights[ua & (CELLS - 1)].astype(float), nb * weights[ub & (CELLS - 1)].astype(float)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    both = np.minimum(wa[ia], wb[ib]).sum()
    return float(both / max(1e-9, wa.sum() + wb.sum() - both))


def prefix(blob: bytes, weights: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(shingles, weight from each of them on, whole weight): the rarest
    shingles of a text, down to where ``threshold`` of its weight is left.

    The order is the same for all texts.  If two texts are alike, the weight
    they share lies, in both, from their first common shingle on."""
    u, n = np.unique(np.frombuffer(blob, np.uint32), return_counts=True)
    cell = weights[u & (CELLS - 1)]
    order = np.lexsort((mixed(u.astype(np.uint64)), -cell))
    w = (n * cell.astype(float))[order]
    rest = np.cumsum(w[::-1])[::-1]
    whole = float(w.sum())
    keep = rest >= threshold * whole * (1 - _SLACK)
    return u[order][keep], rest[keep], whole


def _propose(buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, members of large buckets) of ``buckets`` (key, node, rarity);
    a large bucket's centre is its least rare text."""
    stat = (buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rarity", "node")).alias("centre"))
            .where("n > 1").select("key", "n", F.col("centre.node").alias("centre")))
    members = saved(buckets.join(stat, "key"), "members")
    some = (members.where(F.col("n") <= ALL_PAIRS).groupBy("key").agg(F.collect_list("node").alias("l"))
            .select(F.explode(F.expr("flatten(transform(l, (x, i) -> transform(slice(l, i + 2, size(l)), "
                                     "y -> struct(least(x, y) as a, greatest(x, y) as b))))")).alias("p")).select("p.a", "p.b"))
    large = members.where((F.col("n") > ALL_PAIRS))
    star = large.where("node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
    return some.unionByName(star).distinct(), large.select("key", "node", "rarity")


def _parts(cuts: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """``cuts`` with part, the component of its text by ``labels``, where the
    texts of a shingle are of several components."""
    at = members.join(labels, "node", "left").select("no", F.coalesce("label", "node").alias("label"))
    at = at.join(at.groupBy("label").agg(F.min("no").alias("part")), "label").select("no", "part")
    cuts = cuts.join(at, "no")
    main = (cuts.groupBy("s", "part").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("s").agg(F.max_by("part", "n").alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select("s", "main"))
    return saved(cuts.join(main, "s").withColumn("minor", F.col("part") != F.col("main")).drop("main"), "shared")


def _may(t: float, threshold: float):
    """Whether two texts with a common shingle in their prefixes may be alike;
    x_ names the lighter one's columns.

    Of two texts that are alike, the lighter shares at least 2t / (1 + t) of
    its weight and the heavier t of its own, so the first shingle they have in common stands in the
    prefix of either."""
    return ((F.col("x_part") != F.col("part")) & (F.struct("x_whole", "x_no") < F.struct("whole", "no"))
            & (F.col("x_whole") >= F.col("whole") * t)
            & (F.least("x_rest", "rest") * (1 + threshold) >= (F.col("x_whole") + F.col("whole")) * t))


_CUT = ("no", "part", "rest", "whole")


def _all_across(shared: DataFrame, threshold: float) -> DataFrame:
    """Every pair (x_no, no) of different components that may be alike.  A shingle's largest component is not joined with itself."""
    t = threshold * (1 - _SLACK)
    light = (shared.where(F.col("x_need") <= F.col("rest") * (1 + threshold))
             .select("s", *[F.col(c).alias(f"x_{c}") for c in (*_CUT, "minor")]))
    heavy = shared.drop("x_need")
    return (light.where("x_minor").join(heavy, "s").where(_may(t, threshold)).select("x_no", "no")
            .unionByName(light.where("not x_minor").join(heavy.where("minor"), "s").where(_may(t, threshold)).select("x_no", "no"))
            .distinct())


def _searched(large: DataFrame, labels: DataFrame, edges: DataFrame, blobs: DataFrame, sent: Broadcast, threshold: float,
              verified) -> DataFrame:
    """``labels`` after the members of buckets of ``large`` (key, node) that
    hold several components are compared with all others that may be alike.

    An exact prefix filter proposes every pair of different components that
    may still be alike.  First each text is compared with the least rare of
    those proposed to it; pairs whose components have merged by then are not compared."""
    at = large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = at.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    members = saved(at.join(several, "key").select("node", "rarity").distinct().withColumn("no", F.monotonically_increasing_id()), "open")
    if members.isEmpty():
        return labels

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for b in slices(batches):
            found = [prefix(x.as_py(), w, threshold) for x in b.column(1)]
            sizes = [len(f[0]) for f in found]
            if sum(sizes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([f[0] for f in found]).astype(np.int64)), pa.array(np.repeat(b.column(0).to_numpy(), sizes)),
                     pa.array(np.concatenate([f[1] for f in found])), pa.array(np.repeat([f[2] for f in found], sizes))], ["s", "no", "rest", "whole"])

    cuts = saved(members.join(blobs, "node").select("no", "blob").mapInArrow(trimmed(cut), "s long, no long, rest double, whole double"), "prefixes")
    names = members.select("no", "node")

    def found(pairs: DataFrame) -> DataFrame:
        named = (pairs.join(names.withColumnRenamed("node", "heavy"), "no").drop("no")
                 .join(names.select(F.col("no").alias("x_no"), "node"), "x_no")
                 .select(F.least("node", "heavy").alias("a"), F.greatest("node", "heavy").alias("b")))
        return saved(verified(named), "fresh")

    def linked(pairs: DataFrame, edges: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        fresh = found(pairs)
        if fresh.isEmpty():
            return edges, labels
        edges = edges.unionByName(fresh)
        return edges, connected_components(edges)

    shared = _parts(cuts, members, labels).withColumn("x_need", F.col("whole") * (2 * threshold * (1 - _SLACK)))
    proposed = saved(_all_across(shared, threshold), "proposed")
    rare = members.select("no", "rarity")
    rated = proposed.join(rare, "no").join(rare.select(F.col("no").alias("x_no"), F.col("rarity").alias("x_rarity")), "x_no")
    first = saved(rated.groupBy("x_no").agg(F.min_by("no", F.struct("rarity", "no")).alias("no"))
                  .unionByName(rated.groupBy("no").agg(F.min_by("x_no", F.struct("x_rarity", "x_no")).alias("x_no"))).distinct(), "first")
    edges, labels = linked(first, edges, labels)
    at = members.join(labels, "node", "left").select("no", F.coalesce("label", "node").alias("label"))
    apart = (proposed.join(first, ["x_no", "no"], "left_anti").join(at, "no")
             .join(at.select(F.col("no").alias("x_no"), F.col("label").alias("x_label")), "x_no").where("label <> x_label"))
    return linked(apart.select("x_no", "no"), edges, labels)[1]


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_md5, class_id,
    class_size, keep.

    class_id is the smallest doc_id of the class, class_size its number of
    rows; keep marks the rows with that doc_id whose text is that of the
    first of them.  Equal texts share a class; a
    null text counts as empty; texts without words are alike only if equal; a
    text of one to four words is one shingle.  Null doc_ids sort last: a
    class of them alone has a null class_id, and its rows are kept.  Other columns are not read; an empty
    table gives no rows.

    Buckets of more than ALL_PAIRS texts compare every member with a centre,
    the least rare of them; the members of a bucket that then holds several
    components are compared with all of other components that may be alike.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts, n = _document_counts(rows.select("text"))
    weights = cell_weights(counts, n)
    sent = spark.sparkContext.broadcast(weights)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(sent.value)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                keys, rarity = [], []
                for w in word_hashes(part.column(1).to_pylist()):
                    s = shingles(w)
                    keys.append(sampler.keys(s).tolist() if len(s) else [])
                    rarity.append(sampler.rarity(s) if len(s) else 0.0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.list_(pa.int64())), pa.array(rarity)], ["row", "keys", "rarity"])

    row = F.struct("doc_id", F.md5("text").alias("node"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    signed = saved(rows.select(row.alias("row"), "text")
                   .mapInArrow(trimmed(sign), f"row struct<doc_id: {kind}, node: string>, keys array<long>, rarity double")
                   .select("row.doc_id", "row.node", "keys", "rarity"), "signed")
    buckets = (signed.groupBy("node", "keys").agg(F.min("rarity").alias("rarity"))
               .select(F.explode("keys").alias("key"), "node", "rarity"))
    pairs, large = _propose(buckets)
    pairs = saved(pairs, "pairs")

    number = F.conv(F.substring("node", 1, 15), 16, 10).cast("long")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).select(number.alias("key"))
    found = spark.sparkContext.broadcast(bitmap(wanted, 23))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        map_ = found.value
        for b in batches:
            hit = np.flatnonzero(in_bitmap(map_, b.column(1).to_numpy().view(np.uint64)))
            for at in range(0, len(hit), 512):
                part = b.take(pa.array(hit[at:at + 512]))
                blobs = [packed(shingles(w)) for w in word_hashes(part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(blobs, pa.binary())], ["node", "blob"])

    # of all texts in pairs, so of all members of large buckets too
    blobs = saved(rows.select(F.md5("text").alias("node"), "text").select("node", number.alias("key"), "text")
                  .mapInArrow(trimmed(pack), "node string, blob binary").dropDuplicates(["node"]), "blobs")
    found.destroy()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for b in batches:
            alike = [weighted_jaccard(x.as_py(), y.as_py(), w) >= threshold for x, y in zip(b.column(2), b.column(3))]
            yield b.select([0, 1]).filter(pa.array(alike, pa.bool_()))

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are alike."""
        return (pairs.join(blobs.select(F.col("node").alias("a"), F.col("blob").alias("blob_a")), "a")
                .join(blobs.select(F.col("node").alias("b"), F.col("blob").alias("blob_b")), "b")
                .select("a", "b", "blob_a", "blob_b").mapInArrow(trimmed(compare), "a string, b string"))

    edges = saved(verified(pairs), "edges")
    labels = _searched(large, connected_components(edges), edges, blobs, sent, threshold, verified)
    sent.destroy()
    known = (signed.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
             .join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    known = saved(known, "known")
    first = F.min(F.struct(F.col("least_id").isNull().alias("missing"), "least_id", "node"))
    classes = known.groupBy("label").agg(first.alias("first"), F.sum("copies").alias("class_size"))
    by_text = known.join(classes, "label").select("node", F.col("first.least_id").alias("class_id"), "class_size",
                                                 F.col("first.node").alias("kept_node"))
    return (signed.select("doc_id", "node").join(by_text, "node")
            .select("doc_id", F.col("node").alias("text_md5"), "class_id", "class_size",
                    F.when(F.col("class_id").isNull(), F.lit(True))
                    .otherwise(F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False))
                               & (F.col("node") == F.col("kept_node"))).alias("keep")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class; all columns stay as they are,
    whatever their names.  Rows that repeat both doc_id and text count as one
    and leave one; texts without words are alike only if equal, and null as
    empty; rows with a null doc_id go only if their class has another id.  No rows give none."""
    found = saved(near_classes(docs), "classes")
    twice = (found.where("keep").groupBy(F.col("doc_id").alias("id"), F.col("text_md5").alias("md5")).agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    kept = without(keyed(docs), found.where(~F.col("keep")))
    return one_of_each(kept, ["id", "md5"], twice).select("row.*")


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))
