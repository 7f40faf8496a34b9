"""URL filter with redirect equivalence.

Explicit rules judge a URL by host suffix and path prefix, the longest rule
wins.  Redirects and canonical links join URLs into aliases; connected
components over those edges carry a block to every alias that no rule judges,
unless the component also holds an explicitly allowed URL, which takes
precedence.  A URL without rule and without blocked alias is allowed.

A node is the URL without scheme and fragment, so http/https and anchors of
one address are one node.

Nulls and edge cases: a null URL, or one without ``://``, has empty host and
path, fits no rule and has no alias; links that cannot be resolved to an http
address, or are longer than 65,536 characters, are no edges; a very long page
is scanned once and only its link, meta and base tags are kept; repeated rows
get equal verdicts; an empty table gives an empty result.  Only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum.llm.common import LOWER, UPPER, durable
from pactum.llm.components import connected_components

# The rules of the query, as (host and path, verdict).
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)

# Elements whose content is no markup of the page, and the named character references that URLs need.
UNSEEN = (r"(?is)<!--.*?(?:-->|\z)|<(script|style|template|noscript|textarea|title|xmp|iframe)\b[^>]*>.*?"
          r"(?:</\1\s*>|\z)")
NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&colon;", ":"), ("&sol;", "/"), ("&amp;", "&"))
LONGEST_LINK = 65_536


def _rest(url: Column) -> Column:
    """What follows the first ``://`` (empty if there is none)."""
    return F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def url_node(url: Column) -> Column:
    """Host, path and query; null where the URL has no host."""
    host = url_host(url)
    tail = F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^#]*)", 1)
    return F.when(F.length(host) > 0, F.concat(host, tail))


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value, quoted or not; empty if it is not there."""
    found = rf"""(?i)(?<![\w-]){name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, found, i) for i in (1, 2, 3)])


def decode_references(c: Column) -> Column:
    """Numeric character references and those named references that occur in addresses."""
    def put(text: Column, ref: Column) -> Column:
        digits = F.regexp_replace(ref, r"[&#;xX]", "")
        code = F.when(F.rlike(ref, F.lit("[xX]")), F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return F.replace(text, ref, char)

    refs = F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?i)&#(?:x[0-9a-f]{1,6}|[0-9]{1,7});?"), F.lit(0)))
    # Longer references first, so that none is cut out of another that lacks its semicolon.
    refs = F.array_sort(refs, lambda x, y: F.length(y) - F.length(x))
    out = F.when(F.contains(c, F.lit("&#")), F.aggregate(refs, c, put)).otherwise(c)
    for name, char in NAMED:
        out = F.replace(out, F.lit(name), F.lit(char))
    return out


def _without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments."""
    parts = F.split(F.regexp_replace(path, r"^/", ""), "/")
    # A last segment of dots names a folder, so a slash stays behind it.
    parts = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    empty = F.array().cast("array<string>")
    stack = F.aggregate(parts, empty, lambda acc, x: F.when(x == ".", acc).when(
        x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x))))
    tidy = F.concat(F.lit("/"), F.array_join(stack, "/"))
    return F.when(F.rlike(path, F.lit(r"(?:^|/)\.\.?(?:/|$)")), tidy).otherwise(path)


def resolve(base: Column, link: Column) -> Column:
    """The absolute address that ``link`` names on a page at ``base`` (RFC 3986, without fragment); null if none.

    Only http and https addresses are named; a base without host resolves only absolute links.
    """
    link = F.btrim(link, F.lit(" \t\n\f\r"))
    scheme = F.lower(F.regexp_extract(link, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    rest = F.regexp_replace(link, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    site = F.regexp_extract(rest, r"^(//[^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^(?://[^/?#]*)?([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)", 1)
    base_scheme = F.lower(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    base_site = F.concat(F.when(F.length(base_scheme) > 0, base_scheme).otherwise(F.lit("http")), F.lit("://"), url_host(base))
    base_path = url_path(base)
    base_query = F.regexp_extract(_rest(base), r"^[^?#]*(\?[^#]*)", 1)
    folder = F.regexp_extract(base_path, r"^(.*/)", 1)
    merged = F.concat(F.when(F.length(folder) > 0, folder).otherwise(F.lit("/")), path)
    whole = F.concat(F.substring_index(base_site, ":", 1), F.lit(":"), site, _without_dots(path), query)
    return (F.when((F.length(link) == 0) | (F.length(link) > LONGEST_LINK), None)
            .when(scheme.isin("http", "https") & (F.length(site) > 2),
                  F.concat(scheme, F.lit(":"), site, _without_dots(path), query))
            .when(F.length(scheme) > 0, None)
            .when(F.length(site) > 2, whole)
            .when(F.length(url_host(base)) == 0, None)
            .when(F.length(path) == 0, F.concat(base_site, base_path, F.when(F.length(query) > 0, query).otherwise(base_query)))
            .when(F.startswith(path, F.lit("/")), F.concat(base_site, _without_dots(path), query))
            .otherwise(F.concat(base_site, _without_dots(merged), query)))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst): canonical links and client redirects found in the pages' markup.

    Comments and the content of scripts, styles and the like are no markup.
    ``rel`` is a list of words; a ``base`` element moves what links start from.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    # Markup without these words holds no such link; only the other pages are searched further.
    told = pages.where(F.col(url_col).isNotNull() & F.rlike(html, F.lit("(?i)canonical|refresh")))
    tags = told.select(F.col(url_col).cast("string").alias("src"), F.regexp_replace(html, UNSEEN, " ").alias("h")).select(
        "src", F.regexp_extract_all("h", F.lit(r"(?i)<(?:link|meta|base)\b[^>]*>"), F.lit(0)).alias("tags"))

    def canonical(tag: Column) -> Column:
        words = F.split(F.lower(F.btrim(_attribute(tag, "rel"), F.lit(" \t\n\f\r"))), r"\s+")
        return F.rlike(tag, F.lit(r"(?i)^<link\b")) & F.array_contains(words, "canonical")

    def refresh(tag: Column) -> Column:
        return F.rlike(tag, F.lit(r"(?i)^<meta\b")) & (F.lower(F.trim(_attribute(tag, "http-equiv"))) == "refresh")

    found = F.concat(
        F.transform(F.filter("tags", canonical), lambda t: decode_references(_attribute(t, "href"))),
        F.transform(F.filter("tags", refresh), lambda t: F.regexp_extract(
            decode_references(_attribute(t, "content")), r"""(?i)\burl\s*=\s*["']?\s*([^"'\s>]+)""", 1)))
    home = F.get(F.filter("tags", lambda t: F.rlike(t, F.lit(r"(?is)^<base\b.*\bhref"))), F.lit(0))
    links = tags.select("src", decode_references(_attribute(home, "href")).alias("home"), found.alias("found"))
    base = F.coalesce(resolve(F.col("src"), F.col("home")), F.col("src"))
    links = links.select("src", "found", base.alias("base"))
    # Links are resolved and kept inside the array: a filter on rows would be moved below these steps, with a copy of
    # them for each time that it names one.
    named = F.filter(F.transform("found", lambda link: resolve(F.col("base"), link)), lambda dst: dst.isNotNull())
    return links.select("src", F.explode(named).alias("dst"))


def explicit_verdicts(hosts_paths: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(host, path, rule, verdict) for the distinct (host, path) rows that a rule fits."""
    spark = hosts_paths.sparkSession
    rows = [(r, r.partition("/")[0], "/" + r.partition("/")[2] if "/" in r else "", v, len(r)) for r, v in rules]
    table = spark.createDataFrame(rows, "rule string, r_host string, r_path string, verdict string, r_len int")
    depths = sorted({h.count(".") + 1 for _, h, *_ in rows})
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -k) for k in depths]))
    probe = hosts_paths.select("host", "path", F.explode(suffixes).alias("suffix"))
    hit = probe.join(table, (F.col("suffix") == F.col("r_host")) & F.startswith(F.col("path"), F.col("r_path")))
    best = hit.groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "verdict"), F.struct("r_len", "rule")).alias("b"))
    return best.select("host", "path", F.col("b.rule").alias("rule"), F.col("b.verdict").alias("verdict"))


def judge_urls(pages: DataFrame, links: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, url, host, path, rule, verdict, alias_of) per row; ``links`` is (src, dst) of URLs.

    ``alias_of`` is the least node of the URL's component, null outside any.
    """
    url = F.col(url_col).cast("string")
    p = pages.select(F.col(id_col).alias("page_id"), url.alias("url"))
    p = p.select("page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
                 url_node(F.col("url")).alias("node"))
    ends = links.select(F.col("src").alias("src"), F.col("dst").alias("dst"))
    edges = durable(ends.select(url_node(F.col("src")).alias("a"), url_node(F.col("dst")).alias("b"))
                    .distinct(), "links")
    parts = durable(connected_components(edges, "a", "b"), "aliases")
    # A node is host, path and query without scheme, so it splits like a URL once "://" stands before it.
    located = parts.select("node", "component", url_host(F.concat(F.lit("://"), "node")).alias("host"),
                           url_path(F.concat(F.lit("://"), "node")).alias("path"))
    ruled = durable(explicit_verdicts(
        p.select("host", "path").unionByName(located.select("host", "path")).distinct(), rules), "ruled")
    seeds = located.join(ruled, ["host", "path"])
    decided = seeds.groupBy("component").agg(
        F.when(F.bool_or(F.col("verdict") == "allow"), F.lit("allow")).otherwise(F.lit("block")).alias("spread"))
    spread = durable(parts.join(decided, "component", "left"), "spread").select(
        F.col("node").alias("s_node"), F.col("component").alias("alias_of"), "spread")
    r = ruled.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), "rule", "verdict")
    # Both tables grow with the pages, and their text packs so well that file sizes understate them: no broadcast.
    out = p.join(r.hint("merge"), (F.col("host") == F.col("r_host")) & (F.col("path") == F.col("r_path")), "left") \
        .join(spread.hint("merge"), F.col("node") == F.col("s_node"), "left")
    return out.select("page_id", "url", "host", "path", "rule",
                      F.coalesce("verdict", "spread", F.lit("allow")).alias("verdict"), "alias_of")


def judge_pages(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id",
                url_col: str = "url", html_col: str = "html") -> DataFrame:
    return judge_urls(pages, page_links(pages, url_col, html_col), rules, id_col, url_col)
