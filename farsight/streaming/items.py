"""Queries over an item stream, each a native Structured Streaming query.

What a query remembers lives in Spark's state store (RocksDB) and its
checkpoint, so a failed run resumes where it stopped:

* **histogram** (ST3): a streaming aggregation by item, one state row per
  distinct item.
* **distinct / max / length** (ST4): ``dropDuplicates`` on the item feeds a
  global count and maximum; a second global count gives the length.
* **reservoir** (ST6): the slot form of Algorithm R is a filter, then
  ``max_by`` per slot: m state rows.
* **sticky sampling** (ST5): each micro-batch is first brought to one row per
  item (first hit, count from it on, whole count) by a join and an
  aggregation; ``transformWithState`` keeps (first hit, count) per sampled
  item.  A hot item costs one row a micro-batch.  Micro-batches must arrive in ``pos`` order,
  rows inside one in any order.
* **cut-off** (ST2): a streaming aggregation counts each batch; a window
  over the counts finds the batch that holds item n, and the other queries'
  plans keep ``batch <= that batch``.

Queries run in update mode.  Their sink writes what a micro-batch changed
under the micro-batch's id (overwriting on a replay), and a result is the
latest row of each key.
"""

from __future__ import annotations

import sys
import threading
import time
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from farsight.functions.draws import current_method, draw, threshold_for
from farsight.functions.index import dense_index
from farsight.functions.params import check_items_params, sticky_r
from farsight.operators.joins import broadcast_if_small
from farsight.operators.sampling import RESERVOIR_SEED, STICKY_SEED, reservoir_slot
from farsight.session import scratch_path
from farsight.sources.tables import number

# The state function runs in Python workers: ship this module's code by
# value so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ARRIVED = "pos long, item int, batch long"
FIRST = "item int, fp long, since long, whole long, mb long"


class ItemStreamFailed(RuntimeError):
    """The streaming query failed; ``base`` resumes it from its checkpoint."""

    def __init__(self, message: str, base: str):
        super().__init__(message)
        self.base = base


@contextmanager
def _rocksdb(spark: SparkSession):
    """A query started inside keeps its state in RocksDB, unless the session
    chose a provider; the session's setting is as before afterwards."""
    if spark.conf.get(STATE_PROVIDER_CONF, None) not in (None, "", _DEFAULT_PROVIDER):
        yield
        return
    before = spark.conf.get(STATE_PROVIDER_CONF, None)
    spark.conf.set(STATE_PROVIDER_CONF, ROCKSDB_PROVIDER)
    try:
        yield
    finally:
        spark.conf.unset(STATE_PROVIDER_CONF) if before is None else spark.conf.set(STATE_PROVIDER_CONF, before)


_DEFAULT_PROVIDER = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def _run(df: DataFrame, mode: str, sink, base: str, name: str, processing_time: str | None, timeout_s: float | None,
         enough=None) -> None:
    """Run a query to the end of its source.  With ``processing_time`` it runs
    live and is stopped when the source has no more, or ``enough()`` says so.
    A query that fails, or is not done within ``timeout_s`` (None: no limit),
    raises: what it has written so far is not an answer."""
    writer = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{base}/checkpoint-{name}")
    with _rocksdb(df.sparkSession):
        q = (writer.trigger(availableNow=True) if processing_time is None else writer.trigger(processingTime=processing_time)).start()
    try:
        if processing_time is None:
            done = q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
        else:
            done = _live(q, timeout_s, enough)
    except Exception as e:  # noqa: BLE001 - StreamingQueryException
        raise ItemStreamFailed(f"item stream failed: {e}", base) from e
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise ItemStreamFailed(f"item stream failed: {q.exception()}", base)
    if done is False:
        raise ItemStreamFailed(f"item stream not finished after {timeout_s} s", base)


def _live(q, timeout_s: float | None, enough) -> bool:
    if enough is None:
        late = threading.Event()
        timer = None if timeout_s is None else threading.Timer(timeout_s, lambda: (late.set(), q.stop()))
        if timer:
            timer.start()
        try:
            q.processAllAvailable()
        finally:
            if timer:
                timer.cancel()
        return not late.is_set()
    limit = None if timeout_s is None else time.monotonic() + timeout_s
    while q.isActive and not enough():
        if limit is not None and time.monotonic() > limit:
            return False
        time.sleep(0.05)
    return True


def running_total(sizes: DataFrame, order: str = "batch", value: str = "size", span: int = 4096) -> DataFrame:
    """``sizes`` with ``cum``, the sum of ``value`` up to each row by
    ``order`` (integers, one row each): within spans of ``span`` numbers, and over
    the spans' totals, so no task holds more than a span or a row per span."""
    g = F.floor(F.col(order) / F.lit(span)).cast("bigint")
    spans = sizes.groupBy(g.alias("_span")).agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("_span", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_span").orderBy(order)
    return (sizes.withColumn("_span", g).join(spans, "_span")
            .withColumn("cum", (F.col("_before") + F.sum(value).over(inside)).cast("bigint")).drop("_span", "_before"))


class FirstHits(StatefulProcessor):
    """Sticky sampling of one item: its first hit and the count from it on."""

    def init(self, handle) -> None:
        self.held = handle.getValueState("held", "fp long, est long")

    def handleInputRows(self, key, rows, timer_values):
        state = self.held.get() if self.held.exists() else None
        fp, est = (None, 0) if state is None else (state[0], state[1])
        for r in sorted(rows, key=lambda r: r.mb):  # one row per micro-batch
            if fp is not None:
                est += r.whole
            elif r.fp is not None:
                fp, est = r.fp, r.since
        if fp is not None:  # items never sampled keep no state
            self.held.update((fp, est))
            yield Row(item=key[0], fp=fp, est=est)

    def close(self) -> None:
        pass


class ItemStream:
    """Queries over ``items``, a streaming DataFrame ``pos, item`` and, for
    cut-offs, ``batch``.

    ``base`` is the work folder of their checkpoints and results (None: a
    new one); given the base of a failed run, queries resume.  A finished
    query of a base is not run again.  ``processing_time`` runs queries live
    with that trigger.  ``fail_at`` makes the sink of a micro-batch fail after
    it has written (tests)."""

    def __init__(self, items: DataFrame, base: str | None = None, processing_time: str | None = None,
                 timeout_s: float | None = None, fail_at: int | None = None):
        self.spark, self.items = items.sparkSession, items
        self.base = base or scratch_path(self.spark, "item-stream")
        self.processing_time, self.timeout_s, self.fail_at = processing_time, timeout_s, fail_at
        self._done: set[str] = set()

    # ---------------------------------------------------------------- running
    def _ran(self, name: str, df: DataFrame, mode: str = "update", of=None) -> DataFrame:
        """The rows that query ``name`` wrote, with ``mb``, the micro-batch that did.
        ``of`` makes a micro-batch's rows from its input."""
        path = f"{self.base}/{name}"

        def sink(batch: DataFrame, mb: int) -> None:
            (of(batch, mb) if of else batch).write.mode("overwrite").parquet(f"{path}/mb={mb}")
            if self.fail_at is not None and mb == self.fail_at:
                raise RuntimeError(f"injected failure in micro-batch {mb}")

        schema = FIRST if of else df.schema.add("mb", "long")
        if name not in self._done:
            empty = self.spark.createDataFrame([], schema).drop("mb")
            empty.write.mode("overwrite").parquet(f"{path}/mb=-1")  # a stream without rows has results too
            _run(df, mode, sink, self.base, name, self.processing_time, self.timeout_s)
            self._done.add(name)
        return self.spark.read.schema(schema).parquet(path)

    def _latest(self, name: str, df: DataFrame, keys: list[str]) -> DataFrame:
        """Query ``df`` run to the end: the latest row of each key."""
        rest = [c for c in df.columns if c not in keys]
        found = self._ran(name, df).groupBy(*keys).agg(F.max_by(F.struct(*rest), "mb").alias("r"))
        return found.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])

    # ---------------------------------------------------------------- results
    def histogram(self) -> DataFrame:
        """``item, cnt``."""
        return self._latest("histogram", self.items.groupBy("item").agg(F.count(F.lit(1)).cast("bigint").alias("cnt")), ["item"])

    def length(self) -> DataFrame:
        """``n_items``: how many items came."""
        return self._latest("length", self.items.groupBy().agg(F.count(F.lit(1)).cast("bigint").alias("n_items")), []) \
            .select(F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"))

    def stats(self) -> DataFrame:
        """``n_items, n_distinct, max_item``."""
        kinds = self.items.select("item").dropDuplicates(["item"]).groupBy().agg(
            F.count(F.lit(1)).cast("bigint").alias("n_distinct"), F.max("item").alias("max_item"))
        seen = self._latest("distinct", kinds, [])
        both = seen.select(F.lit(0).cast("bigint").alias("n_items"), "n_distinct", "max_item").unionByName(
            self.length().select("n_items", F.lit(0).cast("bigint").alias("n_distinct"), F.lit(None).cast("int").alias("max_item")))
        return both.agg(F.sum("n_items").alias("n_items"), F.coalesce(F.sum("n_distinct"), F.lit(0)).alias("n_distinct"),
                        F.max("max_item").alias("max_item"))

    def frequent_exact(self, phi: float, n: int | None = None) -> DataFrame:
        """``item, cnt`` with cnt > phi * n (n: None for the stream's length)."""
        check_items_params(phi)
        hist = self.histogram()
        length = F.lit(int(n)) if n is not None else hist.agg(F.sum("cnt")).scalar()
        return hist.where(F.col("cnt") > F.lit(float(phi)) * length)

    def reservoir(self, m: int, seed=RESERVOIR_SEED, n: int | None = None) -> DataFrame:
        """``slot, item, pos`` of an m-sample of the items (n given: of the first n)."""
        rows = self.items if n is None else self.items.where(F.col("pos") < int(n))
        rows = rows.select("pos", "item", reservoir_slot(int(m), seed, current_method()).alias("slot")).where(F.col("slot") < int(m))
        return self._latest(f"reservoir-{int(m)}-{seed}-{n}", rows.groupBy("slot").agg(
            F.max_by("item", "pos").alias("item"), F.max("pos").alias("pos")), ["slot"])

    def sticky(self, phi: float, epsilon: float, delta: float, n: int, seed=STICKY_SEED) -> DataFrame:
        """Sticky sampling at rate r/n: ``item, fp, est`` of the sampled items."""
        hit = draw(seed, F.col("pos"), current_method()) <= F.lit(threshold_for(sticky_r(phi, epsilon, delta) / int(n)))
        name = f"sticky-{phi}-{epsilon}-{delta}-{n}-{seed}"

        def per_item(batch: DataFrame, mb: int) -> DataFrame:
            # at most as many rows as hits, about r in the whole stream
            hits, _ = broadcast_if_small(batch.where("hit").groupBy("item").agg(F.min("pos").alias("fp")))
            return (batch.join(hits, "item", "left").groupBy("item")
                    .agg(F.min("fp").alias("fp"), F.count(F.when(F.col("pos") >= F.col("fp"), 1)).alias("since"),
                         F.count(F.lit(1)).alias("whole")))

        self._ran(f"first-{name}", self.items.select("pos", "item", hit.alias("hit")), "append", per_item)
        first = self.spark.readStream.schema(FIRST).parquet(f"{self.base}/first-{name}")
        table = first.groupBy("item").transformWithState(FirstHits(), "item int, fp long, est long", "Update", "None")
        return self._latest(name, table, ["item"])

    def frequent_sticky(self, phi: float, epsilon: float, delta: float, n: int, seed=STICKY_SEED) -> DataFrame:
        """``item, est`` with est >= (phi - epsilon) * n."""
        return self.sticky(phi, epsilon, delta, n, seed).where(
            F.col("est") >= F.lit((float(phi) - float(epsilon)) * int(n))).select("item", "est")

    # ---------------------------------------------------------------- cut-off
    def sizes(self) -> DataFrame:
        """``batch, size`` of the batches that came."""
        return self._latest("sizes", self.items.groupBy("batch").agg(F.count(F.lit(1)).cast("bigint").alias("size")), ["batch"])

    def consumed(self, n: int) -> DataFrame:
        """``batch_id, size, cum`` of the whole batches up to the one that
        holds item n (all, if fewer items came)."""
        return (running_total(self.sizes()).where(F.col("cum") - F.col("size") < int(n))
                .select(F.col("batch").alias("batch_id"), "size", "cum"))

    def last_batch(self, n: int) -> Column:
        """The batch that holds item n, or the last one, as a scalar subquery."""
        return self.consumed(n).agg(F.max("batch_id")).scalar()

    def until(self, n: int) -> ItemStream:
        """The stream up to the end of the batch that holds item n: the cut is a filter of its plans."""
        return ItemStream(self.items.where(F.col("batch") <= self.last_batch(n)), f"{self.base}/until-{int(n)}",
                          self.processing_time, self.timeout_s, self.fail_at)


def arrivals(lines: DataFrame, n: int | None = None, base: str | None = None, processing_time: str | None = None,
             timeout_s: float | None = None) -> DataFrame:
    """A stream of plain lines (``value``, one integer each) as a stream
    ``pos, item, batch``.

    Each micro-batch is written to the work folder once, its lines numbered
    in arrival order after those before it; it is a batch of its own.  A line that is no integer fails
    the run, whatever the session's ANSI mode.  With ``n`` the
    batch that holds item n is the last one written, and a live run stops there."""
    spark = lines.sparkSession
    base = base or scratch_path(spark, "arrivals")
    path = f"{base}/arrived"
    spark.createDataFrame([], ARRIVED).drop("batch").write.mode("overwrite").parquet(f"{path}/batch=-1")
    came = threading.Event()

    def write(batch: DataFrame, mb: int) -> None:
        # counted from the files' footers, so a restarted run goes on numbering
        before = spark.read.schema(ARRIVED).parquet(path).where(F.col("batch") < mb).count()
        if n is None or before < int(n):
            numbered = dense_index(batch.select(number(F.col("value"), "int").alias("item")), "_i")
            numbered.select((F.col("_i") + F.lit(before)).alias("pos"), "item").write.mode("overwrite").parquet(f"{path}/batch={mb}")
            before = spark.read.schema(ARRIVED).parquet(path).where(F.col("batch") <= mb).count()
        if n is not None and before >= int(n):
            came.set()

    _run(lines, "append", write, base, "arrived", processing_time, timeout_s, came.is_set if n is not None else None)
    return spark.readStream.schema(ARRIVED).parquet(path)
