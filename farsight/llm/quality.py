"""Operator 5 -- a quality classifier of naive Bayes support vectors.

Features are indicators of n-grams of three kinds, hashed to 2**DIM_BITS
dimensions: words, pairs of words, and runs of one to three word shapes, where
a word that repeats the one before has a shape of its own.  Each indicator is
scaled by the log-count ratio of its dimension between the classes, a text's
vector is brought to unit length, and a linear model with squared hinge loss
is fitted by dual coordinate descent.  Platt scaling turns margins into
scores.

The ratios count every labelled training row.  The linear fit takes a sample
of about FIT_ROWS rows, chosen by a hash of the id, in one task; its model has a fixed
size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.llm.shingles import hashed_texts, mixed
from farsight.llm.util import checked_broadcast, dense_sums, keyed, slices, table, trimmed, without
from farsight.session import saved

DIM_BITS = 20
DIMS = 1 << DIM_BITS
FIT_ROWS = 12_000
#: One fit row in so many is kept from the descent and calibrates the scores.
HOLD = 5
COST, EPOCHS, SMOOTH = 1.0, 12, 1.0
ACCEPT = 0.7
_SAME = np.uint64(1)
_STEP = np.uint64(0x5851F42D4C957F2D)


#: Bytes by kind: capitals, small letters (and what is not ASCII), digits; others stay.
_KIND = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c > 127 else 48 if 48 <= c <= 57 else c for c in range(256))


def _shapes(raw: bytes) -> bytes:
    """``raw`` with each byte's kind instead, runs of a kind as one."""
    kinds = np.frombuffer(raw.translate(_KIND), np.uint8)
    keep = np.ones(len(kinds), bool)
    keep[1:] = kinds[1:] != kinds[:-1]
    return kinds[keep].tobytes()


def feature_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """For each text the dimensions that are set, rising."""
    for at in range(0, len(texts), 128):
        raws = [t.encode("utf-8", "surrogatepass") for t in texts[at:at + 128]]
        for (w, _, _), (s, _, _) in zip(hashed_texts(raws), hashed_texts([_shapes(r) for r in raws])):
            s = s.copy()
            with np.errstate(over="ignore"):
                s[1:][w[1:] == w[:-1]] = _SAME
                s2 = s[:-1] * _STEP + s[1:]
                s3 = s2[:-1] * _STEP + s[2:]
                shapes = [np.unique(mixed(x + np.uint64(k))) for k, x in ((11, s), (13, s2), (17, s3))]
                grams = [mixed(w), mixed(w[:-1] * _STEP + w[1:] + np.uint64(7))]
            yield np.unique(np.concatenate([*shapes, *grams]) >> np.uint64(64 - DIM_BITS)).astype(np.int64)


def _class_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(counts of shape (2, DIMS), rows of each class) of ``labelled`` (text, label)."""
    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(2 * DIMS + 4096, np.int64)
        for b in slices(batches):
            for x, y in zip(feature_sets(b.column(0).to_pylist()), b.column(1).to_pylist()):
                total[2 * DIMS + y] += 1
                total[y * DIMS + x] += 1  # a text sets a dimension once
        return total

    total = dense_sums(labelled.select("text", "label"), count, 2 * DIMS + 4096)
    return total[:2 * DIMS].reshape(2, DIMS), total[2 * DIMS:2 * DIMS + 2]


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Log-count ratio of each dimension: how much likelier it is set in class 1."""
    p = counts + SMOOTH
    p = p / p.sum(axis=1, keepdims=True)
    return np.log(p[1] / p[0]).astype(np.float32)


def descend(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Weights (DIMS + 1, the last the bias) by dual coordinate descent for
    the L2-regularised squared hinge loss; ``y`` is 1 or -1."""
    w, alpha, g = np.zeros(DIMS + 1), np.zeros(len(rows)), np.random.default_rng(5)
    values = [r[i] / max(1e-9, float(np.sqrt(np.square(r[i], dtype=np.float64).sum()))) for i in rows]
    diagonal = 1 / (2 * COST)
    norm = np.array([float(np.square(v, dtype=np.float64).sum()) + 1 for v in values]) + diagonal
    for _ in range(EPOCHS):
        worst = 0.0
        for k in g.permutation(len(rows)):
            i, v = rows[k], values[k]
            slope = y[k] * (w[i] @ v + w[-1]) - 1 + diagonal * alpha[k]
            new = max(0.0, alpha[k] - slope / norm[k])
            move = (new - alpha[k]) * y[k]
            if move:
                w[i] += move * v
                w[-1] += move
                alpha[k] = new
                worst = max(worst, abs(slope))
        if worst < 1e-3:
            break
    return w


def margins(rows: list[np.ndarray], r: np.ndarray, w: np.ndarray) -> np.ndarray:
    scaled = (r * w[:-1]).astype(np.float32)
    return np.array([scaled[i].sum(dtype=np.float64) / max(1e-9, float(np.sqrt(np.square(r[i], dtype=np.float64).sum()))) + w[-1]
                     for i in rows])


def platt(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) such that 1 / (1 + exp(-(a m + b))) is the chance of class 1; targets are smoothed by class size."""
    n1 = (y > 0).sum()
    n0 = len(y) - n1
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, float(np.log((n1 + 1) / (n0 + 1)))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -40, 40)))
        q = np.maximum(p * (1 - p), 1e-9)
        grad = np.array([((p - t) * m).sum() + 1e-3 * a, (p - t).sum()])
        h = np.array([[(q * m * m).sum() + 1e-3, (q * m).sum()], [(q * m).sum(), q.sum() + 1e-3]])
        step = np.linalg.solve(h, grad)
        a, b = a - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -2, 2))
        if abs(step).max() < 1e-7:
            break
    return a, b


def fit(labelled: DataFrame) -> dict:
    """The model from ``labelled`` (id, text, label 0 or 1)."""
    counts, rows = _class_counts(labelled)
    n = int(rows.sum())
    if not rows.all():  # one class, or no row at all: nothing to tell apart
        return {"prior": (rows[1] + 1) / (n + 2)}
    r = log_ratios(counts)
    sent = labelled.sparkSession.sparkContext.broadcast(r)

    def descent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for b in batches:
            values, cuts = b.column(1).values.to_numpy(), b.column(1).offsets.to_numpy()
            got += [(h, y, values[i:j].copy()) for h, y, i, j in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), cuts, cuts[1:])]
        got.sort(key=lambda x: (x[0], x[1], len(x[2])))
        x = [g[2] for g in got]
        y = np.array([1.0 if g[1] else -1.0 for g in got])
        held = np.arange(len(x)) % HOLD == 0
        if len(x) < 2 * HOLD or len(set(y[~held])) < 2 or len(set(y[held])) < 2:
            held[:] = False
        w = descend([v for v, h in zip(x, held) if not h], y[~held], sent.value)
        use = held if held.any() else ~held
        a, b = platt(margins([v for v, h in zip(x, use) if h], sent.value, w), y[use])
        yield pa.RecordBatch.from_pydict({"model": [np.concatenate([w, [a, b]]).astype(np.float64).tobytes()]})

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                sets = list(feature_sets(part.column(1).to_pylist()))
                cuts = np.cumsum([0, *map(len, sets)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(sets), pa.int32())),
                     part.column(2)], ["h", "x", "label"])

    h = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
    some = labelled.select(h.alias("h"), "text", "label").where(F.col("h") < int(min(1, FIT_ROWS / n) * (1 << 30)))
    got = (some.mapInArrow(trimmed(featured), "h long, x array<int>, label int").repartition(1)
           .mapInArrow(trimmed(descent), "model binary").toArrow()["model"].to_pylist())
    sent.destroy()
    if not got:
        return {"prior": (rows[1] + 1) / (n + 2)}
    model = np.frombuffer(got[0], np.float64)
    return {"r": r, "scaled": (r * model[:DIMS]).astype(np.float32), "bias": model[DIMS], "a": model[DIMS + 1], "b": model[DIMS + 2]}


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_md5, held_out,
    score, predicted.

    Labels are learnt from rows with crc32(doc_id as text) mod 4 not 2, all
    of which ``labels`` (doc_id, quality) marks 0 or 1; other labels, and null ids, teach nothing.
    A doc_id labelled twice teaches each label.  Where one class or none is
    left, every score is the smoothed share of label 1.  A null text counts as empty; a text without words
    is scored by the bias.  Rows that repeat are scored alike; other columns are not read; an empty table gives no
    rows.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    taught = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()) \
                   .select("doc_id", F.col(label).cast("int").alias("label")).distinct()
    labelled = (rows.where(~held_out).join(checked_broadcast(taught, 16), "doc_id")
                .select(F.col("doc_id").alias("id"), "text", "label"))
    sent = spark.sparkContext.broadcast(fit(labelled))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                out = []
                if "prior" in model:
                    out = [float(model["prior"])] * part.num_rows
                for i in feature_sets(part.column(1).to_pylist()) if "r" in model else ():
                    length = float(np.sqrt(np.square(model["r"][i]).sum(dtype=np.float64)))
                    m = model["scaled"][i].sum(dtype=np.float64) / max(1e-9, length) + model["bias"]
                    out.append(1 / (1 + np.exp(-float(np.clip(model["a"] * m + model["b"], -40, 40)))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.float64())], ["row", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    row = F.struct("doc_id", held_out.alias("held_out"), F.md5("text").alias("text_md5"))
    return (rows.select(row.alias("row"), "text")
            .mapInArrow(trimmed(score), f"row struct<doc_id: {kind}, held_out: boolean, text_md5: string>, score double")
            .select("row.doc_id", "row.text_md5", "row.held_out", "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted")))


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; all columns stay
    as they are, whatever their names.  Null and empty texts are judged as
    texts without words.  Where the labels (none, or of one class) teach no
    difference, nothing can be judged and all rows stay."""
    scores = saved(quality_scores(docs, labels), "quality")
    if scores.agg(F.count_distinct("score")).first()[0] < 2:
        return docs
    return without(keyed(docs), scores.where("predicted = 0")).select("row.*")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_md5")
