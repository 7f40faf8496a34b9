"""Links of pages: resolution by the examples of RFC 3986, references, comments, rel lists; and what they do to verdicts."""

from urllib.parse import urljoin

from pyspark.sql import functions as F

from pactum.llm import url_filter

# The reference examples of RFC 3986, section 5.4, against http://a/b/c/d;p?q (fragments are dropped).
EXAMPLES = {
    "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g",
    "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q", "g#s": "http://a/b/c/g",
    "g?y#s": "http://a/b/c/g?y", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y",
    ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g",
    "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g", "../../../g": "http://a/g",
    "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.",
    ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g",
    "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h", "g;x=1/./y": "http://a/b/c/g;x=1/y",
    "g;x=1/../y": "http://a/b/c/y", "g?y/./x": "http://a/b/c/g?y/./x", "g?y/../x": "http://a/b/c/g?y/../x",
    "g:h": None, "mailto:x@y": None, "": None, "https://o/x/../y": "https://o/y", "  g\n": "http://a/b/c/g"}


def test_links_resolve_by_the_rules(spark):
    df = spark.createDataFrame([(r, x) for r, x in EXAMPLES.items()], "link string, want string")
    out = df.select("link", "want", url_filter.resolve(F.lit("http://a/b/c/d;p?q"), F.col("link")).alias("got"))
    assert {r["link"]: r["got"] for r in out.collect()} == EXAMPLES


def test_links_resolve_like_a_library(spark):
    bases = ["http://a.net", "http://a.net/", "https://a.net/x/y/", "http://a.net/x/../y/z?w#f"]
    links = ["q", "../q/r", "/q/./r", "?a=1", "q?b#c", "../../../q", "./..", "//o.org/z"]
    df = spark.createDataFrame([(b, x, urljoin(b, x).split("#")[0]) for b in bases for x in links], "b string, x string, want string")
    for r in df.select("b", "x", "want", url_filter.resolve(F.col("b"), F.col("x")).alias("got")).collect():
        assert r["got"] == r["want"], r


def test_character_references(spark):
    cases = {"a&amp;b": "a&b", "&#47;&#x2F;&sol;": "///", "&#8364;&#x1F600;": "€😀", "&amp;#47;": "&#47;", "&#99999999;": "�9;",
             "&#0;": "�", "plain & text": "plain & text", "&#4 &#47": "\x04 /"}
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    assert {r[0]: r[1] for r in df.select("c", url_filter.decode_references(F.col("c"))).collect()} == cases


def test_verdicts_through_all_kinds_of_links(spark):
    blocked = "http://bad.net/q/r/z"
    pages = [
        (1, blocked, ""),
        (2, "http://a.test/x/y", "<link rel='alternate canonical' href='http://bad.net/q/./r/z'>"),
        (3, "http://b.test/", "<!-- <link rel=canonical href='http://bad.net/q/r/z'> -->"),
        (4, "http://c.test/", "<script>'<link rel=canonical href=\"http://bad.net/q/r/z\">'</script>"),
        (5, "http://d.test/", "<LINK HREF=http://bad.net/q/r/z REL=CANONICAL>"),
        (6, "http://e.test/", "<link data-rel=canonical href='http://bad.net/q/r/z'>"),
        (7, "http://f.test/", "<link rel=canonicals href='http://bad.net/q/r/z'>"),
        (8, "http://g.test/", '<meta http-equiv="Refresh" content="5; URL=\'http://bad&#46;net/q/r/z\'">'),
        (9, "http://h.test/p/", "<base href='//bad.net/q/'><link rel=canonical href='s/../r/z#top'>"),
        (10, "http://bad.net/q/s/t", "<link rel=canonical href='../r/z'>"),
        (11, "http://i.test/1", "<link rel=stylesheet href='/x'><link rel=canonical href='?p=1'>"),
        (12, "http://i.test/1?p=1", "<link rel=canonical href='http://bad.net/q/r/z'>"),
        (13, "http://j.test/", "<!-- open comment <link rel=canonical href='http://bad.net/q/r/z'>"),
        (14, "http://k.test/", "<link rel=canonical href='http://bad.net/" + "x" * 70_000 + "'>"),
        (15, None, "<link rel=canonical href='http://bad.net/q/r/z'>"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_pages(df).collect()}
    assert {i for i, v in got.items() if v == "block"} == {1, 2, 5, 8, 9, 10, 11, 12} and len(got) == 15


def test_plan_holds_no_copies_of_its_steps(spark):
    df = spark.createDataFrame([(1, "http://a.test/", "")], "page_id long, url string, html string")
    plan = url_filter.page_links(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") < 1000
