import random
from datetime import datetime

import pytest

from webloom.operators.merge import Merge, fresh_keys, keyed_overwrite
from webloom.plans.statement import StatementError, parse_merge, sql


@pytest.fixture
def table(spark):
    made = []

    def make(name, rows, schema):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.createDataFrame(rows, schema).write.format("parquet").saveAsTable(name)
        made.append(name)

    yield make
    for n in made:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def rows(spark, name):
    return sorted((tuple(r) for r in spark.table(name).collect()), key=str)


def test_insert_update_upsert(spark, table):
    table("m1", [], "url string, title string")
    got = sql(spark, "CRAWLING MERGE INTO m1 USING (SELECT 'a' AS url, 'A' AS title) AS src ON (src.url = m1.url) WHEN NOT MATCHED THEN INSERT BY NAME")
    assert tuple(got.first()) == (1, 0, 0) and rows(spark, "m1") == [("a", "A")]
    got = sql(spark, "CRAWLING MERGE INTO m1 USING (SELECT * FROM VALUES ('a','new'),('b','B') AS v(url, title)) AS s ON m1.url = s.url WHEN MATCHED THEN UPDATE BY NAME WHEN NOT MATCHED THEN INSERT BY NAME;")
    assert tuple(got.first()) == (1, 1, 0) and rows(spark, "m1") == [("a", "new"), ("b", "B")]


def test_delete_and_condition(spark, table):
    table("m2", [(1, "x"), (2, "y"), (3, "z")], "id int, status string")
    sql(spark, "CRAWLING MERGE INTO m2 USING (SELECT 2 AS id) AS s ON (s.id = m2.id) WHEN MATCHED THEN DELETE")
    assert [r[0] for r in rows(spark, "m2")] == [1, 3]
    now = datetime.now()
    table("m3", [("old", 10, datetime(2024, 1, 1)), ("fresh", 20, now)], "url string, value int, updated_at timestamp")
    sql(spark, "CRAWLING MERGE INTO m3 USING (SELECT * FROM VALUES ('old',100,current_timestamp()),('fresh',200,current_timestamp()) AS v(url,value,updated_at)) AS s ON s.url = m3.url WHEN MATCHED AND updated_at < current_timestamp() - INTERVAL '1' DAY THEN UPDATE BY NAME WHEN NOT MATCHED THEN INSERT BY NAME")
    assert {r[0]: r[1] for r in rows(spark, "m3")} == {"old": 100, "fresh": 20}


def test_not_matched_by_source(spark, table):
    table("m4", [("keep1", "o"), ("keep2", "o"), ("remove", "o")], "url string, title string")
    src = "(SELECT * FROM VALUES ('keep1','n'),('keep2','n') AS v(url,title)) AS s ON (m4.url = s.url)"
    assert tuple(sql(spark, f"CRAWLING MERGE INTO m4 USING {src} WHEN MATCHED THEN UPDATE BY NAME WHEN NOT MATCHED BY SOURCE THEN DELETE").first()) == (0, 2, 1)
    assert [r[0] for r in rows(spark, "m4")] == ["keep1", "keep2"]
    table("m5", [("new", "a", False), ("archived", "a", True), ("old", "a", False)], "url string, status string, is_archived boolean")
    sql(spark, "CRAWLING MERGE INTO m5 USING (SELECT 'new' AS url, 'b' AS status, false AS is_archived) AS s ON s.url = m5.url WHEN MATCHED THEN UPDATE BY NAME WHEN NOT MATCHED BY SOURCE AND is_archived = false THEN UPDATE SET status = 'removed'")
    assert {r[0]: r[1] for r in rows(spark, "m5")} == {"new": "b", "archived": "a", "old": "removed"}


def test_created_from_source(spark):
    spark.sql("DROP TABLE IF EXISTS m6")
    got = sql(spark, "CRAWLING MERGE INTO m6 USING (SELECT * FROM VALUES (1,'a'),(2,'b') AS v(id,status)) AS s ON s.id = m6.id WHEN MATCHED THEN UPDATE WHEN NOT MATCHED THEN INSERT")
    assert tuple(got.first()) == (2, 0, 0) and got.columns == ["rows_inserted", "rows_updated", "rows_deleted"]
    spark.sql("DROP TABLE m6")


def test_edges(spark):
    t = spark.createDataFrame([("a", 1, "x"), (None, 5, "n"), ("c", 3, "z")], "k string, v int, w string")
    s = spark.createDataFrame([("a", 7, 0), ("b", 8, 1), ("a", 9, 2), (None, 4, 3), ("b", 6, 4)], "k string, v int, o int")
    m = Merge(t, s, ["k"], order="o").when_matched_update().when_not_matched_insert().result()
    assert sorted(m.target.collect(), key=str) == sorted([("a", 9, "x"), (None, 5, "n"), (None, 4, None), ("b", 6, None), ("c", 3, "z")], key=str)
    assert tuple(m.counts.first()) == (2, 3, 0)
    m = Merge(t, s, ["k"], order="o").when_matched_update(assign={"v": "target.v + source.v"}).when_not_matched_by_source_delete().limit(0).result()
    assert tuple(m.counts.first()) == (0, 0, 2) and sorted(r.v for r in m.target.collect()) == [1]
    m = Merge(t, s, {"k": "k"}, order="o").when_not_matched_insert("source.v > 5", {"k": "source.k", "w": "'new'"}).result()
    assert sorted(r.w for r in m.target.collect()) == ["n", "new", "x", "z"]
    assert fresh_keys(s, t, ["k"], "v < 2").count() == 3
    assert keyed_overwrite(t, spark.createDataFrame([("a", 0)], "k string, v int"), "k").count() == 3


def test_against_a_row_loop(spark):
    rnd = random.Random(4)
    for _ in range(3):
        target = {k: rnd.randrange(100) for k in rnd.sample(range(30), 15)}
        source = [(rnd.randrange(30), rnd.randrange(100), i) for i in range(20)]
        want, n = dict(target), [0, 0, 0]
        for k, v, _ in source:
            n[1 if k in want else 0] += 1
            want[k] = v
        m = Merge(spark.createDataFrame(list(target.items()), "k int, v int"), spark.createDataFrame(source, "k int, v int, o int"), ["k"], order="o").when_matched_update().when_not_matched_insert().result()
        assert dict(map(tuple, m.target.collect())) == want and tuple(m.counts.first()) == tuple(n)


def test_parser():
    s = parse_merge("CRAWLING MERGE INTO db.t USING (SELECT ';WHEN' AS a FROM x WHERE (b = ')')) src ON (db.t.a = src.a AND t.b = src.c) WHEN MATCHED AND t.n > (SELECT 1) THEN UPDATE SET a = coalesce(src.a, 'x, y'), b = 2 WHEN NOT MATCHED BY TARGET THEN INSERT (a, b) VALUES (src.a, f(1, 2)) WHEN NOT MATCHED BY SOURCE THEN DELETE LIMIT 5")
    assert s.target == "db.t" and s.alias == "src" and s.on == {"a": "a", "b": "c"} and s.limit == 5
    assert s.clauses[0].assign == {"a": "coalesce(src.a, 'x, y')", "b": "2"} and s.clauses[1].assign == {"a": "src.a", "b": "f(1, 2)"}
    assert parse_merge("CRAWLING MERGE INTO t USING s USING (a, b) WHEN MATCHED THEN DELETE").on == {"a": "a", "b": "b"}
    for bad in ("CRAWLING MERGE INTO t", "CRAWLING MERGE INTO t USING s ON t.a > s.a WHEN MATCHED THEN DELETE", "CRAWLING MERGE INTO t USING s ON t.a = s.a WHEN MATCHED THEN EXPLODE"):
        with pytest.raises(StatementError):
            parse_merge(bad)


def test_stream_into(spark):
    spark.sql("DROP TABLE IF EXISTS st")
    assert sql(spark, "STREAM (SELECT id FROM range(10)) INTO st LIMIT 4").first()[0] == 4
    assert sql(spark, "STREAM (SELECT id FROM range(3)) INTO st").first()[0] == 3 and spark.table("st").count() == 7
    spark.sql("DROP TABLE st")
    assert sql(spark, "SELECT 1 AS a").first().a == 1




def test_a_failed_swap_leaves_the_table(spark, monkeypatch):
    from webloom.operators import merge as M

    spark.sql("DROP TABLE IF EXISTS swap_t")
    spark.range(3).write.saveAsTable("swap_t")
    rows = spark.table("swap_t").selectExpr("id + 10 AS id")
    monkeypatch.setattr(M, "quote_text", lambda t: "no text")
    with pytest.raises(Exception):
        M.replace_table(spark, "swap_t", rows)
    assert sorted(r.id for r in spark.table("swap_t").collect()) == [0, 1, 2]
    monkeypatch.undo()
    M.replace_table(spark, "swap_t", rows)
    assert sorted(r.id for r in spark.table("swap_t").collect()) == [10, 11, 12]
    M.replace_table(spark, "swap_t", spark.table("swap_t").selectExpr("id * 2 AS id"))
    assert sorted(r.id for r in spark.sql("SELECT * FROM swap_t").collect()) == [20, 22, 24]
    spark.sql("INSERT INTO swap_t VALUES (1)")
    assert spark.table("swap_t").count() == 4
    spark.sql("DROP TABLE swap_t")
