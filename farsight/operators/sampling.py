"""Sampling-based frequent items: sticky sampling and reservoir sampling.

Randomness comes from ``draws.draw(seed, pos)``: a pure function of the
position, so tasks can be retried, micro-batches replayed and the answer
reproduced by the SQL oracle.

Sticky sampling (batch form).  Sequentially, an item enters the table S on
its first occurrence whose draw succeeds (probability r/n) and from then on
every occurrence is counted.  Hence for each item:

    fp  = min(pos) over its occurrences with a successful draw
    est = #occurrences with pos >= fp

``fp`` per item is a filter + tiny aggregate (the expected number of
successes is r = ln(1/(delta*phi))/epsilon whatever the data size); it is
materialized, counted and broadcast when below the bound, then one pass
counts the occurrences at or after ``fp``.  The big side is never shuffled
on the broadcast path, so a hot item costs nothing extra.

Reservoir sampling (Algorithm R) in slot form.  Item i (0-based) goes to
slot i when i < m, else to slot j = draw mod (i+1), kept only when j < m;
the last writer of each slot wins.  So the sample is
``where(slot < m).groupBy(slot).max_by(item, pos)``: a filter that keeps
about m*ln(n/m) rows and an m-row aggregate -- equal to the sequential
algorithm under the same draws, with no ordering pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farsight.functions.draws import TWO_POW_60, draw
from farsight.functions.params import check_items_params, reservoir_size, sticky_r
from farsight.operators.items import frequent_exact, item_histogram, length_col
from farsight.operators.joins import broadcast_if_small

STICKY_SEED = 42
RESERVOIR_SEED = 43


# ------------------------------------------------------------------ sticky

def sticky_threshold(r: float, n: Column) -> Column:
    """T = floor(min(1, r/n) * 2^60): a draw u succeeds iff u <= T."""
    rate = F.least(F.lit(1.0), F.lit(float(r)) / F.greatest(n, F.lit(1)))
    return F.floor(rate * F.lit(float(TWO_POW_60))).cast("bigint")


def sticky_rate(items: DataFrame, phi: float, epsilon: float, delta: float,
                n: int | None = None) -> DataFrame:
    """One row ``r, n, rate, threshold``."""
    r = sticky_r(phi, epsilon, delta)
    counted = items.agg(F.count(F.lit(1)).cast("bigint").alias("_cnt"))
    ncol = F.col("_cnt") if n is None else length_col(items, n)
    return counted.select(
        F.lit(float(r)).alias("r"), ncol.alias("n"),
        F.least(F.lit(1.0), F.lit(float(r)) / F.greatest(ncol, F.lit(1))).alias("rate"),
        sticky_threshold(r, ncol).alias("threshold"))


def sticky_hits(items: DataFrame, r: float, n: Column, seed=STICKY_SEED) -> DataFrame:
    """``item, fp``: first successful draw per item."""
    u = draw(seed, F.col("pos"))
    return (items.where(u <= sticky_threshold(r, n))
            .groupBy("item").agg(F.min("pos").alias("fp")))


def sticky_table(items: DataFrame, phi: float, epsilon: float, delta: float,
                 n: int | None = None, seed=STICKY_SEED,
                 max_broadcast_rows: int | None = None) -> DataFrame:
    """The sticky-sampling hash table S: ``item, fp, est``."""
    r = sticky_r(phi, epsilon, delta)
    hits = sticky_hits(items, r, length_col(items, n), seed)
    kw = {} if max_broadcast_rows is None else {"max_rows": max_broadcast_rows}
    hits, _ = broadcast_if_small(hits, **kw)
    return (items.select("item", "pos").join(hits, "item")
            .where(F.col("pos") >= F.col("fp"))
            .groupBy("item", "fp").agg(F.count(F.lit(1)).cast("bigint").alias("est")))


def frequent_sticky(items: DataFrame, phi: float, epsilon: float, delta: float,
                    n: int | None = None, seed=STICKY_SEED) -> DataFrame:
    """epsilon-approximate frequent items: ``item, est`` with
    est >= (phi - epsilon) * n (inclusive)."""
    thr = F.lit(float(phi) - float(epsilon)) * length_col(items, n)
    S = sticky_table(items, phi, epsilon, delta, n, seed)
    return S.where(F.col("est") >= thr).select("item", "est")


def _mark(df: DataFrame, truth: DataFrame) -> DataFrame:
    """Adds ``mark`` '+' when the item is truly frequent, else '-'.  The
    truth side has at most 1/phi rows when n is the stream length (but not
    for a smaller caller-given n), so its size is checked before it is
    broadcast."""
    t, _ = broadcast_if_small(truth.select("item", F.lit(True).alias("_t")))
    return df.join(t, "item", "left") \
             .withColumn("mark", F.when(F.col("_t"), F.lit("+")).otherwise(F.lit("-"))).drop("_t")


def sticky_vs_exact(items: DataFrame, phi: float, epsilon: float, delta: float,
                    n: int | None = None, seed=STICKY_SEED) -> DataFrame:
    """``item, est, mark``."""
    return _mark(frequent_sticky(items, phi, epsilon, delta, n, seed),
                 frequent_exact(items, phi, n))


def frequent_common(items: DataFrame, phi: float, epsilon: float, delta: float,
                    n: int | None = None, seed=STICKY_SEED) -> DataFrame:
    """True frequent items also reported by sticky sampling: ``item``."""
    return (frequent_sticky(items, phi, epsilon, delta, n, seed).select("item")
            .intersect(frequent_exact(items, phi, n).select("item")))


def frequent_summary(items: DataFrame, phi: float, epsilon: float, delta: float,
                     n: int | None = None, seed=STICKY_SEED) -> DataFrame:
    """One row: ``hist_size, n_true, table_size, n_estimated, n_common``."""
    ncol = length_col(items, n)
    hist = item_histogram(items)
    S = sticky_table(items, phi, epsilon, delta, n, seed).select("item", "est")
    j = hist.join(S, "item", "left")
    is_true = F.col("cnt") > F.lit(float(phi)) * ncol
    is_est = F.col("est") >= F.lit(float(phi) - float(epsilon)) * ncol
    return j.agg(
        F.count(F.lit(1)).cast("bigint").alias("hist_size"),
        F.count(F.when(is_true, 1)).cast("bigint").alias("n_true"),
        F.count("est").cast("bigint").alias("table_size"),
        F.count(F.when(is_est, 1)).cast("bigint").alias("n_estimated"),
        F.count(F.when(is_true & is_est, 1)).cast("bigint").alias("n_common"))


# --------------------------------------------------------------- reservoir

def reservoir_slot(m: int, seed=RESERVOIR_SEED, method: str | None = None) -> Column:
    u = draw(seed, F.col("pos"), method)
    return F.when(F.col("pos") < int(m), F.col("pos")).otherwise(F.pmod(u, F.col("pos") + 1))


def reservoir_sample(items: DataFrame, m: int, seed=RESERVOIR_SEED) -> DataFrame:
    """``slot, item, pos``: an m-sample without replacement (fewer rows
    when the stream is shorter than m)."""
    if int(m) <= 0:
        raise ValueError(f"m must be > 0, got {m!r}")
    return (items.select("pos", "item", reservoir_slot(m, seed).alias("slot"))
            .where(F.col("slot") < int(m))
            .groupBy("slot").agg(F.max_by("item", "pos").alias("item"), F.max("pos").alias("pos")))


def reservoir_first_n(items: DataFrame, m: int, n: int, seed=RESERVOIR_SEED) -> DataFrame:
    """Reservoir over the first n items only."""
    return reservoir_sample(items.where(F.col("pos") < int(n)), m, seed)


def reservoir_vs_exact(items: DataFrame, phi: float, n: int | None = None,
                       seed=RESERVOIR_SEED) -> DataFrame:
    """Distinct sampled items of the ceil(1/phi)-reservoir as frequent-item
    estimates: ``item, mark``."""
    m = reservoir_size(phi)
    check_items_params(phi)
    est = reservoir_sample(items, m, seed).select("item").distinct()
    return _mark(est, frequent_exact(items, phi, n))


def reservoir_summary(items: DataFrame, phi: float, n: int | None = None,
                      seed=RESERVOIR_SEED) -> DataFrame:
    """One row: ``sample_size, n_estimated, n_true, n_common`` -- the
    ceil(1/phi)-reservoir, its distinct items (the estimates), the truly
    frequent items and how many of those the reservoir found."""
    m = reservoir_size(phi)
    sample = reservoir_sample(items, m, seed)
    est = sample.groupBy("item").agg(F.count(F.lit(1)).alias("copies"))
    truth = frequent_exact(items, phi, n).select("item", F.lit(1).alias("_t"))
    truth, _ = broadcast_if_small(truth)
    j = est.join(truth, "item", "full")
    return j.agg(F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("sample_size"),
                 F.count("copies").cast("bigint").alias("n_estimated"),
                 F.count("_t").cast("bigint").alias("n_true"),
                 F.count(F.when(F.col("copies").isNotNull() & F.col("_t").isNotNull(), 1))
                 .cast("bigint").alias("n_common"))
