from pyspark.sql import functions as F

from deskweave.llm import url_filter


def judged(spark, rows, links=None):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = url_filter.judge(pages, links if links is not None else url_filter.html_links(pages))
    return {r["page_id"]: tuple(r)[1:] for r in found.collect()}


def test_hosts_paths_and_longest_rule(spark):
    rows = [
        (1, "HTTP://A.Example.NET/en/x?q#f", None), (2, "http://example.net/fr/", None),
        (3, "http://example.net", None), (4, "http://notexample.com/de/x", None),
        (5, "https://sub.example.com/de/x/", None), (6, "http://a.org/fr/://b/", None),
        (7, None, None), (8, "no scheme", ""), (9, "", ""), (10, "x://net#/", None),
        (11, "http://host.net?x=/en/", None), (12, "://net/", None),
    ]
    got = judged(spark, rows)
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[2] == ("example.net", "/fr/", "net/", "block")
    assert got[3] == ("example.net", "", None, "allow")
    assert got[4] == ("notexample.com", "/de/x", None, "allow")
    assert got[5] == ("sub.example.com", "/de/x/", "example.com/de/", "block")
    assert got[6] == ("a.org", "/fr/://b/", "org/fr/", "allow")
    assert got[7] == got[8] == got[9] == ("", "", None, "allow")
    assert got[10] == ("net", "", None, "allow") and got[11] == ("host.net", "", None, "allow")
    assert got[12] == ("net", "/", "net/", "block")


def test_decisions_reach_aliases_and_allow_goes_first(spark):
    links = [("http://a.de/", "http://x.net/"), ("http://b.de/1", "http://a.de/"),
             ("http://c.de/", "http://y.net/"), ("http://c.de/", "http://z.org/fr/"),
             (None, "http://a.de/"), ("http://d.de/", "http://d.de/")]
    edges = spark.createDataFrame(links, "a string, b string")
    rows = [(1, "http://a.de/"), (2, "http://b.de/1#top"), (3, "http://c.de/"), (4, "http://d.de/"),
            (5, "http://x.net/"), (6, "http://z.org/fr/"), (7, None), (8, "http://y.net/"), (1, "http://a.de/")]
    got = judged(spark, [(*r, None) for r in rows], edges)
    assert {k: v[3] for k, v in got.items()} == {
        1: "block", 2: "block", 3: "allow", 4: "allow", 5: "block", 6: "allow", 7: "allow", 8: "block",
    }


def test_links_in_html(spark):
    html = """<LINK href='/c?x=1&amp;y=2' rel="canonical"><meta http-equiv=refresh content="0; URL='next'">
        <link rel=stylesheet href=/s.css><link rel="canonical" href="//n.net/q#z">"""
    pages = spark.createDataFrame(
        [(1, "http://h.de/dir/page?q", html), (2, None, html), (3, "http://h.de", None)],
        "page_id long, url string, html string",
    )
    got = {tuple(r) for r in url_filter.html_links(pages).collect()}
    assert got == {
        ("http://h.de/dir/page?q", "http://h.de/c?x=1&y=2"),
        ("http://h.de/dir/page?q", "http://h.de/dir/next"),
        ("http://h.de/dir/page?q", "http://n.net/q"),
    }
    assert judged(spark, [(1, "http://h.de/dir/page?q", html)])[1][3] == "block"


def test_empty_table_and_other_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", "", "x")], "page_id long, url string, html string, host string")
    more = pages.withColumns({c: F.lit("x") for c in ("path", "own", "rule", "verdict", "root")})
    assert url_filter.judge(more, url_filter.html_links(more)).first()["verdict"] == "block"
    none = pages.where("false")
    assert url_filter.judge(none, url_filter.html_links(none)).count() == 0
