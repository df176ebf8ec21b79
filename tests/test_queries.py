"""Every query against its DuckDB counterpart, as the driver does it."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from webloom.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def norm(v):
    return ("nan" if math.isnan(v) else repr(round(v, 9))) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    assert got
    if name not in ORACLES:
        return
    cur = duck.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall())


def test_every_link_encoded(spark, tmp_path):
    html = "".join(f'<a href="{h}">x</a>' for h in ("/plain", "/für", "/a b", "/a%20b", "/漢?q=é#ü", "/<`>"))
    spark.createDataFrame([(7, "https://e.org/en/1", html)], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    want = [(7, i, f"https://e.org{p}") for i, p in enumerate(("/plain", "/f%C3%BCr", "/a%20b", "/a%20b", "/%E6%BC%A2?q=%C3%A9#%C3%BC", "/%3C%60%3E"))]
    assert sorted(map(tuple, QUERIES["links"](spark, str(tmp_path)).collect())) == want
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(c.execute(ORACLES["links"]).fetchall()) == want


def test_merge_sides_cover_the_whole_table(spark, duck):
    keys = {k for (k,) in duck.execute("SELECT o_orderkey FROM orders").fetchall()}
    got = {r.k for r in QUERIES["merge_upsert"](spark, SF).collect()}
    assert got == keys | {2 * k for k in keys}
    c = QUERIES["merge_counts"](spark, SF).first()
    assert min(c.rows_inserted, c.rows_updated, c.rows_deleted) > 0 and c.rows_updated + c.rows_deleted == len(keys)


def test_only_the_training_data_package_may_be_missing(monkeypatch):
    import importlib
    import sys

    for name in ("corpus_pipeline", "webloom.llm", "webloom.llm.queries"):
        monkeypatch.setitem(sys.modules, name, None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    bare = importlib.import_module("__spark_entry__")
    assert set(bare.queries()) == set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


def test_list_items_are_read_once(spark):
    plan = QUERIES["list_items"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1, plan
