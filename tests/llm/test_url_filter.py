import duckdb
import pytest

from quadrat.llm import url_filter as U

ROWS = [
    (1, "https://www.A.example.com/en/70?x=1"), (2, "http://a.example.com/en/9"), (3, "http://x.net/de/4"), (4, "http://q.example.net/de/81"),
    (5, "http://free-bets.org/"), (6, "http://cheap.org/loan"), (7, "http://freebetsx.org/cheapest"), (8, None), (9, ""), (10, "no scheme casino-win"),
    (11, "http://org/es/"), (12, "HTTP://h?u=http://z/en/"), (1, "https://www.A.example.com/en/70?x=1"), (None, "http://notcom/en/"),
]


def test_hosts_rules_and_boundaries(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string").selectExpr("*", "'x' host", "1 verdict", "2 _url")
    got = sorted((tuple(r) for r in U.filter_urls(df).collect()), key=str)
    by = {r[0]: r for r in got}
    assert by[1][1:4] == ("www.a.example.com", "/en/70", "example.com/en/7") and by[1][7] == "allow"
    assert by[2][3] == "com/en/" and by[2][7] == "block"
    assert by[3][7] == "allow" and by[4][3] == "example.net/de/8" and by[4][7] == "block"
    assert by[5][7] == "block" and by[6][4:] == (0, 2, 6, "block") and by[7][4:] == (0, 0, 0, "allow")
    assert by[8][1:] == ("", "", None, 0, 0, 0, "allow") and by[9][1:3] == ("", "") and by[10][1:] == ("", "", None, 1, 2, 12, "block")
    assert by[11][7] == "block" and by[12][1:3] == ("h", "") and by[None][3] is None
    assert len(got) == len(ROWS)


def test_empty_table(spark):
    assert U.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_equals_sql(spark, sf_dir):
    c = duckdb.connect()
    c.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    want = c.sql(f"SELECT page_id, host, path, rule, n_strict, n_soft, weight, verdict FROM ({U.SQL['op3_url_filter']})").fetchall()
    got = [tuple(r) for r in U.op3_url_filter(spark, sf_dir).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_a_loaded_vocabulary(spark):
    terms = U.load_vocabulary(spark.createDataFrame([("Foo", 4), ("foo", 3), ("bar", 2), ("", 9), (None, 9), ("z", None)], "term string, weight int"))
    assert terms == {"foo": 4, "bar": 2}
    df = spark.createDataFrame([(1, "http://FOO.org/foo"), (2, "http://foo.org/bar"), (3, "http://bar.org/bars")], "page_id long, url string")
    got = {r["page_id"]: (r["weight"], r["verdict"]) for r in U.filter_urls(df, rules=(), vocabulary=terms).collect()}
    assert got == {1: (4, "allow"), 2: (6, "block"), 3: (2, "allow")}
    assert U.filter_urls(df, rules=(), vocabulary={}).where("verdict = 'allow'").count() == 3
    with pytest.raises(ValueError):
        U.load_vocabulary(spark.createDataFrame([("a", 1), ("b", 1)], "term string, weight int"), 1)
