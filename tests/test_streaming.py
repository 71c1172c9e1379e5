"""Streams of several files: every result equals its batch twin, however the
items are dealt over micro-batches, live or not, and after a failure."""

import os

import pytest

from conftest import SF001, items_df
from farsight.operators import items as itemops, sampling
from farsight.sources import stream_items
from farsight.streaming import ItemStream, ItemStreamFailed, arrivals, item_stream, item_text_stream, table_stream
from farsight.streaming.items import STATE_PROVIDER_CONF, running_total

PHI, EPS, DELTA = 0.05, 0.01, 0.1


def _as_set(df):
    return {tuple(r) for r in df.collect()}


def _files(spark, folder, rows, cuts, schema="pos long, item int, batch long"):
    """``rows`` as Parquet files cut before the places ``cuts``, oldest first."""
    folder.mkdir()
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        spark.createDataFrame(rows[a:b], schema).coalesce(1).write.parquet(str(folder / "out"))
        part, = (folder / "out").glob("part-*.parquet")
        part.rename(folder / f"f{i:03d}.parquet")
        for rest in (folder / "out").iterdir():
            rest.unlink()
        (folder / "out").rmdir()
        os.utime(folder / f"f{i:03d}.parquet", (3_000_000 + i, 3_000_000 + i))
    return str(folder)


def _source(spark, folder, per_trigger=1, schema="pos long, item int, batch long"):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


@pytest.fixture(scope="module")
def thousand(spark, tmp_path_factory):
    """1,000 items in ten files, batches of 100, one item a third of them; the files' ends are not the batches'."""
    rows = [(r.pos, 7 if r.pos % 3 == 0 else r.item, r.pos // 100) for r in stream_items(spark, SF001).orderBy("pos").collect()]
    cuts = [60, 130, 260, 330, 450, 560, 700, 810, 930]
    return rows, _files(spark, tmp_path_factory.mktemp("stream") / "src", rows, cuts)


@pytest.mark.parametrize("per_trigger", [1, 4])
def test_whole_stream_equals_batch_twins(spark, thousand, per_trigger):
    rows, folder = thousand
    items = spark.createDataFrame([r[:2] for r in rows], "pos long, item int")
    run, n = ItemStream(_source(spark, folder, per_trigger)), len(rows)
    assert _as_set(run.histogram()) == _as_set(itemops.item_histogram(items))
    assert _as_set(run.stats()) == _as_set(itemops.stream_stats(items))
    assert _as_set(run.reservoir(20)) == _as_set(sampling.reservoir_sample(items, 20).select("slot", "item", "pos"))
    assert _as_set(run.reservoir(20, n=450)) == _as_set(sampling.reservoir_first_n(items, 20, 450).select("slot", "item", "pos"))
    assert _as_set(run.sticky(PHI, EPS, DELTA, n)) == _as_set(sampling.sticky_table(items, PHI, EPS, DELTA).select("item", "fp", "est"))
    assert _as_set(run.frequent_exact(PHI)) == _as_set(itemops.frequent_exact(items, PHI))
    assert _as_set(run.frequent_sticky(PHI, EPS, DELTA, n)) == _as_set(sampling.frequent_sticky(items, PHI, EPS, DELTA))
    assert spark.conf.get(STATE_PROVIDER_CONF).endswith("HDFSBackedStateStoreProvider")  # as before


def test_sticky_state_gets_a_row_per_item_and_micro_batch(spark, thousand):
    rows, folder = thousand
    run = ItemStream(_source(spark, folder))
    run.sticky(PHI, EPS, DELTA, len(rows))
    name, = [f for f in os.listdir(run.base) if f.startswith("first-")]
    first = spark.read.parquet(f"{run.base}/{name}")
    assert first.groupBy("mb", "item").count().where("count > 1").count() == 0
    assert first.where("item = 7").count() == 10 and first.agg({"whole": "sum"}).first()[0] == 1000


@pytest.mark.parametrize("processing_time", [None, "100 milliseconds"])
def test_cut_after_the_batch_of_item_n(spark, thousand, processing_time):
    rows, folder = thousand
    run = ItemStream(_source(spark, folder), processing_time=processing_time)
    cut = items_df(spark, [r[1] for r in rows[:500]])
    assert [tuple(r) for r in run.consumed(450).orderBy("batch_id").collect()] == [(b, 100, 100 * (b + 1)) for b in range(5)]
    short = run.until(450)
    assert _as_set(short.histogram()) == _as_set(itemops.item_histogram(cut))
    assert short.length().first()[0] == 500
    assert run.consumed(10 ** 9).count() == 10  # fewer items than n: all


def test_variable_batches(spark, tmp_path):
    batches = [0, 0, 0, 1, 2, 2, 2, 2, 3, 3, 5]
    rows = [(i, i % 3, b) for i, b in enumerate(batches)]
    run = ItemStream(_source(spark, _files(spark, tmp_path / "src", rows, [4, 6])))
    assert [tuple(r) for r in run.consumed(5).orderBy("batch_id").collect()] == [(0, 3, 3), (1, 1, 4), (2, 4, 8)]
    cut = itemops.stream_cutoff(spark.createDataFrame(rows, "pos long, item int, batch long"), 5).select("pos", "item")
    assert _as_set(run.until(5).histogram()) == _as_set(itemops.item_histogram(cut))


def test_running_total_over_many_spans(spark):
    df = spark.range(1000).selectExpr("id * 37 - 9000 AS batch", "id % 7 AS size")
    got = {r.batch: r.cum for r in running_total(df, span=64).collect()}
    total, want = 0, {}
    for i in range(1000):
        total += i % 7
        want[i * 37 - 9000] = total
    assert got == want


@pytest.mark.parametrize("result", ["stats", "sticky", "reservoir", "histogram"])
def test_failed_micro_batch_is_replayed_exactly_once(spark, thousand, result):
    rows, folder = thousand
    items = spark.createDataFrame([r[:2] for r in rows], "pos long, item int")
    args = {"sticky": (PHI, EPS, DELTA, len(rows)), "reservoir": (20,)}.get(result, ())
    with pytest.raises(ItemStreamFailed) as failed:
        getattr(ItemStream(_source(spark, folder), fail_at=2), result)(*args)
    # the sink had written when it died; a new run resumes from the checkpoint
    got = getattr(ItemStream(_source(spark, folder), base=failed.value.base), result)(*args)
    want = {"stats": lambda: itemops.stream_stats(items), "histogram": lambda: itemops.item_histogram(items),
            "sticky": lambda: sampling.sticky_table(items, PHI, EPS, DELTA).select("item", "fp", "est"),
            "reservoir": lambda: sampling.reservoir_sample(items, 20).select("slot", "item", "pos")}[result]()
    assert _as_set(got) == _as_set(want)


def test_empty_stream(spark, tmp_path):
    run = ItemStream(_source(spark, _files(spark, tmp_path / "src", [], [])))
    assert run.histogram().count() == run.reservoir(5).count() == run.sticky(PHI, EPS, DELTA, 10).count() == 0
    assert [tuple(r) for r in run.stats().collect()] == [(0, 0, None)]
    assert run.consumed(5).count() == 0 and run.until(5).histogram().count() == 0


def test_table_as_file_and_as_folder(spark, tmp_path):
    whole = table_stream(spark, SF001, "events")
    assert ItemStream(whole.selectExpr("event_id AS pos", "user_id AS item")).length().first()[0] == 1000
    spark.read.parquet(f"{SF001}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    folder = item_stream(spark, str(tmp_path), batch_size=100, files_per_trigger=1)
    assert _as_set(ItemStream(folder).histogram()) == _as_set(itemops.item_histogram(stream_items(spark, SF001)))


def _lines(folder, chunks):
    folder.mkdir()
    for i, chunk in enumerate(chunks):
        f = folder / f"chunk-{i}.txt"
        f.write_text("\n".join(str(v) for v in chunk) + "\n")
        os.utime(f, (1_000_000 + i, 1_000_000 + i))
    return str(folder)


@pytest.mark.parametrize("processing_time", [None, "100 milliseconds"])
def test_plain_lines_are_numbered_as_they_arrive(spark, tmp_path, processing_time):
    chunks = [[(7 * i + j) % 11 for j in range(40 + 10 * i)] for i in range(5)]
    lines = item_text_stream(spark, _lines(tmp_path / "lines", chunks))
    n = 100                      # reached inside the third file (40 + 50 + 60 items)
    run = ItemStream(arrivals(lines, n, processing_time=processing_time)).until(n)
    consumed = [v for chunk in chunks[:3] for v in chunk]
    cut = items_df(spark, consumed)
    assert run.length().first()[0] == 150
    assert _as_set(run.histogram()) == _as_set(itemops.item_histogram(cut))
    assert _as_set(run.sticky(0.2, 0.1, 0.1, n)) == _as_set(sampling.sticky_table(cut, 0.2, 0.1, 0.1, n=n).select("item", "fp", "est"))
    assert _as_set(run.reservoir(5, n=n)) == _as_set(sampling.reservoir_first_n(cut, 5, n).select("slot", "item", "pos"))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_line_fails_the_stream(spark, tmp_path, ansi):
    folder = _lines(tmp_path / "bad", [[1, 2, "abc"]])
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(ItemStreamFailed):
            arrivals(item_text_stream(spark, folder), 10)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("processing_time", [None, "10 seconds"])
def test_timeout_is_an_error(spark, thousand, processing_time):
    with pytest.raises(ItemStreamFailed):
        ItemStream(_source(spark, thousand[1]), processing_time=processing_time, timeout_s=0.01).histogram()
