"""Every registered query against its DuckDB twin at sf0.001, plus the
flagship entry."""

import math

import duckdb
import pytest

from farsight.plans import catalog
from conftest import SF001
from farsight.sources.tables import TABLES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.columns[0] == "radius"


def test_every_query_has_sql():
    assert set(catalog.ALL_SQL) == set(catalog.ALL_QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ALL_QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = catalog.ALL_QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(catalog.ALL_SQL[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, srows) == _rows(rel.columns, drows)
    types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    st = {f.name: types.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert st == dt


def test_registered_queries_pin_md5_draws(spark, con):
    spark.conf.set("farsight.draw.hash", "xxhash64")
    try:
        for name in ("sticky_table", "reservoir_sample"):
            df = catalog.ALL_QUERIES[name](spark, SF001)
            rel = con.sql(catalog.ALL_SQL[name])
            assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())
    finally:
        spark.conf.set("farsight.draw.hash", "md5")
