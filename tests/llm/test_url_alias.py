"""URL rules and alias groups."""

from conftest import SF001
from ledgerlens.llm import url_alias as U
from ledgerlens.llm.catalog import ORACLE_SQL, op4_url_alias
from oracle_util import compare, duck


def judge(spark, rows, rules=U.RULES, redirects=None):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("page_id", "page_id")
    links = spark.createDataFrame(redirects, "source string, target string") if redirects else None
    return {r["page_id"]: r for r in U.judge(df, U.rule_table(spark, rules), links).collect()}


def test_table_against_sql(spark):
    assert compare(op4_url_alias(spark, SF001).toPandas(), duck(SF001).sql(ORACLE_SQL["op4_url_alias"]).df()) == []


def test_hosts_paths_and_longest_rule(spark):
    got = judge(
        spark,
        [
            (1, "http://WWW.Example.ORG/en/12?q#f", None),
            (2, "https://example.org/en/2", ""),
            (3, "http://a.com/fr/x", None),
            (4, "http://a.com/de/x", None),
            (5, "http://a.com/it", None),
            (6, "no url", None),
            (7, None, None),
            (8, "http://notexample.org/es/1", None),
            (9, "http://host?x", None),
            (None, "http://b.com/de/", None),
            (None, "http://b.com/de/", None),
        ],
    )
    view = {k: (r["host"], r["path"], r["rule"], r["verdict"]) for k, r in got.items()}
    assert view[1] == ("www.example.org", "/en/12", "example.org/en/1", "block")
    assert view[2] == ("example.org", "/en/2", "org/", "allow")
    assert view[3][2:] == ("com/fr/", "allow") and view[4][2:] == ("com/de/", "block")
    assert view[5][2:] == (None, "allow")
    assert view[6] == ("", "", None, "allow") == view[7]
    assert view[8][2] == "org/" and view[9] == ("host", "", None, "allow")
    assert view[None][3] == "block"


def test_decisions_reach_aliases_and_allow_comes_first(spark):
    canonical = '<html><head><LINK href="/de/a" rel=canonical></head>'
    refresh = "<meta http-equiv='refresh' content='0; url=http://x.com/de/b'>"
    rows = [
        (1, "http://x.com/a", canonical),  # alias of x.com/de/a: blocked
        (2, "https://x.com/a/#part", None),  # the same node as 1
        (3, "http://y.net/b", refresh),  # alias of x.com/de/b: blocked
        (4, "http://z.net/1", None),  # by two redirects to a blocked and an allowed url
        (5, "http://q.net/1", None),
        (6, "http://x.com/de/b", None),
    ]
    redirects = [
        ("http://z.net/1", "http://z.net/2"),
        ("http://z.net/2", "http://x.com/de/c"),
        ("http://z.net/2", "http://x.com/fr/c"),
        ("http://z.net/1", "http://z.net/1"),
    ]
    got = {k: r["verdict"] for k, r in judge(spark, rows, redirects=redirects).items()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block"}


PAGE = "http://x.com/z/page?q=1"
RESOLVED = [  # what the url standard's reference resolution gives for links on PAGE
    ("http://h.net/p?page=2&amp;ref=x", "http://h.net/p?page=2&ref=x"),
    ("?q=2", "http://x.com/z/page?q=2"),
    ("?u=http://h.net/", "http://x.com/z/page?u=http://h.net/"),
    ("/de/../fr/9", "http://x.com/fr/9"),
    ("../de/./9", "http://x.com/de/9"),
    ("../../../up", "http://x.com/up"),
    ("b/c/..", "http://x.com/z/b/"),
    ("next", "http://x.com/z/next"),
    ("//h.net/a", "http://h.net/a"),
    ("#part", "http://x.com/z/page?q=1#part"),
    ("/a&#47;b&#x26;c&lt;&amp;lt;", "http://x.com/a/b&c<&lt;"),
    ("/&#233;&#x1F642;&#0;", "http://x.com/é\U0001f642\ufffd"),
    ("mailto:me@h.net", None),
]


def test_links_are_resolved_like_a_browser_does(spark):
    rows = [(i, PAGE, f'<link rel="canonical" href="{link}">') for i, (link, _) in enumerate(RESOLVED)]
    rows += [(99, "http://host", '<link rel="canonical" href="a">')]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted(t for _, t in RESOLVED if t) + ["http://host/a"]
    assert sorted(r["target"] for r in U.page_edges(df).collect()) == sorted(want)


def alias_rows():
    link = '<link rel="canonical" href="{}">'.format
    return [
        (1, "http://a.net/1", link("http://b.com/de/x?page=2&amp;ref=x")),  # blocked by its alias
        (2, "http://c.net/z?q=1", link("?q=2")),
        (3, "http://c.net/z?q=2", link("http://b.com/fr/../de/1")),  # 2 and 3: blocked
        (4, "http://d.net/a/b/", link("../../e")),
        (5, "http://d.net/e", link("http://example.org/es/..")),  # 4 and 5: allowed
        (6, "http://d.net/x/../y", None),
        (7, "http://e.net/", link("http://d.net/y")),
        (8, "http://d.net/y/", link("http://b.com/de/")),  # 6, 7 and 8: blocked
        (9, "http://f.net/", link("javascript:void(0)")),
    ]


def test_aliases_behind_references_queries_and_dots(spark):
    got = {k: r["verdict"] for k, r in judge(spark, alias_rows()).items()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block", 7: "block", 8: "block", 9: "allow"}


def test_sql_agrees_on_aliases(spark, tmp_path):
    import duckdb

    df = spark.createDataFrame(alias_rows(), "page_id long, url string, html string")
    df.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert compare(op4_url_alias(spark, str(tmp_path)).toPandas(), con.sql(ORACLE_SQL["op4_url_alias"]).df()) == []


def test_no_rows(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert U.judge(empty, U.rule_table(spark, U.RULES)).count() == 0
