"""Main texts: what must stay, what must go, deep pages, and pages generated with a known article."""

import random

import pytest

from pactum.llm import wrapper


def texts(page, n=8):
    return wrapper.extract_group([page.replace("{i}", str(i)) for i in range(n)])


def expect(page, *blocks, n=8):
    assert texts(page, n) == ["\n\n".join(b.replace("{i}", str(i)) for b in blocks) for i in range(n)]


def test_marked_parts_of_an_article_stay():
    expect("<article><p class='teaser'>Lead {i}</p><p>Text {i}</article>", "Lead {i}", "Text {i}")
    expect("<article><section class='widget-theory'><p>Widgets {i}</section><p>More {i}</article>", "Widgets {i}", "More {i}")
    expect("<article><h2>Abstract</h2><p>Text {i}<h2>Methods</h2><p>M {i}</article>", "Abstract", "Text {i}", "Methods", "M {i}")
    expect("<article><p>Text {i}<p><a href=x>Source {i}</a></article>", "Text {i}", "Source {i}")


def test_main_around_a_small_article_stays():
    expect("<nav>Menu</nav><main><h1>Head {i}</h1><p>The long text {i}</p><article><p>Small {i}</article></main><footer>F</footer>",
           "Head {i}", "The long text {i}", "Small {i}")
    expect("<main><article><p>Text {i}</article><div class='related-posts'><p>Other {i}</div><div class='share'>S {i}</div></main>",
           "Text {i}")


def test_roles_inside_an_article_go():
    for junk in ("<nav>{i}</nav>", "<aside>{i}</aside>", "<form>{i}</form>", "<footer>{i}</footer>", "<div class='ad'>{i}</div>",
                 "<div class='cookie-notice'>{i}</div>", "<div id=comments><article><p>{i}</article></div>", "<script>{i}</script>",
                 "<div class='ad-slot top'>{i}</div>", "<p class='notice'>{i}</p>", "<div role=search>{i}</div>", "<!-- {i} -->",
                 "<div class='newsletter'>Sign up now</div>", "<div class='share-bar'>Share this</div>"):
        expect(f"<article><p>One {{i}}</p>{junk}<p>Two {{i}}</p></article>", "One {i}", "Two {i}")


def test_slots_choose_where_nothing_is_marked():
    page = ("<div class=top>Site</div><ul><li><a href=/>Home</a><li><a href=/n>News {i}</a></ul><div><h1>Title {i}</h1><h2>Abstract</h2>"
            "<p>Text {i}<p><a href=s>A link {i}</a><p>End {i}<p><a href=t>Last link {i}</a></div><div>All rights reserved</div>")
    expect(page, "Title {i}", "Abstract", "Text {i}", "A link {i}", "End {i}", "Last link {i}")
    assert texts(page, 2)[0].startswith("Site")  # two pages are no evidence


def test_deep_pages():
    for unit in ("<div>", "<div><p>", "<article>", "<ul><li>", "<section class=a>"):
        deep = unit * 100_000
        assert wrapper.extract_group([deep + "end", deep + "other"]) == ["end", "other"]
    assert wrapper.extract_group(["</b></i></div>" * 100_000 + "x"]) == ["x"]


@pytest.mark.parametrize("seed", range(6))
def test_generated_pages_give_their_article(seed):
    """Pages of a random host layout; the article's blocks are known."""
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(500)]

    def text(n):
        return " ".join(rnd.choices(words, k=n))

    marked = rnd.choice(["article", "main", "div class=post", "div"])
    before = rnd.sample(["<nav><a href=/>Home</a></nav>", "<div class=logo>Site</div>", "<div class=ad>{}</div>",
                         "<header><p>Welcome</p></header>", "<ul><li><a href=/>A</a><li><a href=/b>B</a></ul>"], 3)
    after = rnd.sample(["<footer>{}</footer>", "<div>Imprint</div>", "<section class=comments><p>{}</p></section>",
                        "<div class=sidebar><p>{}</p></div>"], 2)
    inner = rnd.sample(["<aside>{}</aside>", "<form>{}</form>", "<div class=ad>{}</div>"], 2)
    pages, want = [], []
    for _ in range(12):
        blocks = [text(3), *[text(rnd.randint(5, 30)) for _ in range(rnd.randint(1, 6))]]
        parts = [f"<h1>{blocks[0]}</h1>", *[f"<p>{b}</p>" for b in blocks[1:]]]
        for x in inner:
            parts.insert(rnd.randint(1, len(parts) - 1), x.format(text(4)))
        body = f"<{marked}>" + "".join(parts) + f"</{marked.split()[0]}>"
        pages.append("<html><body>" + "".join(x.format(text(5)) for x in before) + body
                     + "".join(x.format(text(5)) for x in after) + "</body></html>")
        want.append("\n\n".join(blocks))
    assert wrapper.extract_group(pages) == want


def test_repeated_rows_travel_once(spark, monkeypatch):
    rows = [(None, None, "<article><p>Same text</article>")] * 500 + [(1, "http://a.net/", "<p>x")] * 3
    out = wrapper.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()
    assert len(out) == 503 and sum(r["text"] == "Same text" for r in out) == 500


def test_groups_are_bounded_in_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(wrapper, "GROUP_BYTES", 20_000)
    for n in (20, 40):
        rows = [(i, "http://a.net/", f"<p>{i}" + "x" * 10_000) for i in range(n)]
        plan = wrapper.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
        seen.append(plan.count())
        parts = spark.createDataFrame([(n * 10_000,)], "b long").selectExpr(f"ceil(b / {wrapper.GROUP_BYTES})").first()[0]
        assert parts == n // 2
    assert seen == [20, 40]
