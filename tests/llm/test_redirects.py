"""URLs without path that hold another URL."""

import duckdb

from foliant.llm import queries, urls


def test_redirect_urls(spark):
    rows = [
        (1, "http://a.example.com?next=http://b.org/fr/1"), (2, "https://shop.example.net#https://x/en/2"), (3, "http://a.org?u=x://y/fr/1#z://w/en/"), (4, "http://a.org/fr/1?u=http://b.net/"),
        (5, "http://net?u=http://b/"), (6, "://?x://y/z"), (7, "http://bad.host?u=http://b.org/fr/1"), (8, "http://a.example.com?" + "x" * 50_000 + "://b/de/"),
    ]
    listed = spark.createDataFrame([("http://bad.host",)], "url string")
    got = {r.page_id: (r.host, r.path, r.canonical, r.rule, r.verdict) for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), listed).collect()}
    assert got == {
        1: ("a.example.com", "", "a.example.com", None, "allow"), 2: ("shop.example.net", "", "shop.example.net", None, "allow"), 3: ("a.org", "", "a.org", None, "allow"),
        4: ("a.org", "/fr/1", "a.org/fr/1", "org/fr/", "allow"), 5: ("net", "", "net", None, "allow"), 6: ("", "", None, None, "allow"), 7: ("bad.host", "", "bad.host", None, "block"), 8: ("a.example.com", "", "a.example.com", None, "allow"),
    }


def test_filter_against_sql(spark, sf):
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
        want = con.execute(queries.ORACLES["op2_url_filter"]).fetchall()
    got = [tuple(r) for r in queries.op2_url_filter(spark, sf).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and {r[4] for r in got} == {"allow", "block"}
