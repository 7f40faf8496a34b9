"""Operators against plain brute force on small fixtures."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pactum.llm import (blocks, decontaminate, fm_index, jaccard_join, link_counts, substring_dedup, tokens, url_filter, warc,
                        wrapper)
from pactum.llm.components import connected_components

DOCS = "doc_id long, text string, source string"


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, share):
    return " ".join(f"e{rng.randrange(10 ** 6)}" if rng.random() < share else w for w in text.split(" "))


def components(pairs, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_match_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(999, i) for i in range(500, 560)] + [(7, 7)]
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df, "a", "b").collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {n: c for n, c in components(edges, nodes).items()}


def brute_jaccard(rows, k=5):
    sets = {}
    for i, t, _ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else \
            frozenset([tuple(w)] if w else [])
    pairs = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    found = components(pairs, sets)
    return {i: (len(sets[i]), found[i], sum(i in p for p in pairs)) for i in sets}


def jaccard_rows():
    rng = random.Random(11)
    rows, n = [], itertools.count(1)
    passage = sentence(rng, 60)
    for _ in range(25):
        base = sentence(rng, rng.randrange(30, 150))
        rows.append((next(n), base, "a"))
        for _ in range(rng.randrange(4)):
            rows.append((next(n), edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.05])), "b"))
        rows.append((next(n), f"{sentence(rng, 40)} {passage}", "c"))
    base = sentence(rng, 200)
    rows += [(next(n), edited(rng, base, rng.choice([0.003, 0.01, 0.02, 0.04])), "near") for _ in range(60)]
    rows += [(next(n), t, "x") for t in ("", None, "One", "one", "one two", "One two ", "a b c d e", "a b c d e f")]
    return rows


@pytest.mark.parametrize("cell", [30_000, 700])
def test_jaccard_components_match_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(jaccard_join, "CELL_SHINGLES", cell)  # small: cells are dealt in many chunks
    monkeypatch.setattr(link_counts, "CHUNK_SHINGLES", cell)
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 20 * cell)     # small: copies lie in several blocks
    rows = jaccard_rows()
    out = jaccard_join.jaccard_components(spark.createDataFrame(rows, DOCS).repartition(5))
    got = {r["id"]: (r["n_shingles"], r["component"], r["n_links"]) for r in out.collect()}
    assert got == brute_jaccard(rows)


@pytest.mark.parametrize("gain", [0, 10 ** 9])
@pytest.mark.parametrize("slab", [50, 4_000_000])
def test_link_counts_by_postings_and_by_products(monkeypatch, gain, slab):
    """Both ways of counting common shingles, in small and in large steps, with copies and with two sides."""
    import numpy as np

    monkeypatch.setattr(link_counts, "GEMM_GAIN", gain)
    monkeypatch.setattr(link_counts, "SLAB", slab)
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2 ** 63, 40, np.uint64)
    sets = [np.unique(np.concatenate((rng.choice(base, 40 - int(rng.integers(0, 12)), replace=False),
                                      rng.integers(0, 2 ** 63, int(rng.integers(0, 6)), np.uint64)))) for _ in range(60)]
    sets += [rng.integers(0, 2 ** 63, 3, np.uint64) for _ in range(5)]
    copies = rng.integers(1, 4, len(sets))
    plain = [frozenset(s.tolist()) for s in sets]

    def linked(a, b):
        return 100 * len(plain[a] & plain[b]) >= 80 * len(plain[a] | plain[b])

    for side in (None, rng.integers(0, 2, len(sets))):
        want = [sum(int(copies[j]) for j in range(len(sets)) if j != i and linked(i, j)
                    and (side is None or side[i] != side[j])) for i in range(len(sets))]
        assert link_counts.degrees(sets, copies, side, 80).tolist() == want


def test_keep_first_leaves_one_of_each_group(spark):
    rows = [*jaccard_rows(), (1, "another text under a used id", "dup")]
    want = {c for _, c, _ in brute_jaccard(rows[:-1]).values()}
    out = jaccard_join.keep_first(spark.createDataFrame(rows, DOCS))
    ids = [r["doc_id"] for r in out.collect()]
    assert out.columns == ["doc_id", "text", "source"]
    assert len(ids) == len(set(ids)) and set(ids) <= want | {1}


def test_shingles_are_those_of_plain_splitting():
    import pyarrow as pa

    texts = ["One two\tTHREE four  five six", None, "", " x ", "Straße und É ÄPFEL e e e e e", "a\x0bb\x85c d e f"]
    sets = jaccard_join.shingle_sets(pa.array(texts, pa.large_string()), 5)
    for s, t in zip(sets, texts, strict=True):
        w = (t or "").encode().lower().split()
        assert len(s) == len({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else ())
    w = tokens.words_of(pa.array(texts, pa.string()))
    raw = w.data.tobytes()
    assert [raw[a:b] for a, b in zip(w.start, w.end, strict=True)] == [x for t in texts for x in (t or "").encode().split()]


def test_fm_index_counts_like_a_scan():
    rng = np.random.default_rng(3)
    seq = np.concatenate([np.append(rng.integers(1, 6, 300), 0) for _ in range(6)]).astype(np.int64)
    seq[700:760] = seq[100:160]
    starts = np.array([i for i in range(len(seq) - 8) if 0 not in seq[i:i + 8]])
    place = fm_index.FMIndex(seq, 7, 16).repeated(seq, starts, 8)
    grams = {}
    for i in starts:
        grams.setdefault(tuple(seq[i:i + 8]), []).append(i)
    by_place = {}
    for i, p in zip(starts, place, strict=True):
        assert (p >= 0) == (len(grams[tuple(seq[i:i + 8])]) > 1)
        if p >= 0:
            by_place.setdefault(p, set()).add(tuple(seq[i:i + 8]))
    assert all(len(v) == 1 for v in by_place.values())
    tree = fm_index.WaveletMatrix(seq, 7)
    at = rng.integers(0, len(seq) + 1, 200)
    c = rng.integers(0, 7, 200)
    assert tree.rank(c, at).tolist() == [int((seq[:a] == s).sum()) for s, a in zip(c, at, strict=True)]


def brute_repeats(rows):
    first, out = {}, {}
    for i, t, _ in sorted(rows, key=lambda r: r[0]):
        w = (t or "").split()
        gone = set()
        for s in range(len(w) - 19):
            g = tuple(w[s:s + 20])
            if first.setdefault(g, (i, s)) != (i, s):
                gone.update(range(s, s + 20))
        out[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


@pytest.mark.parametrize("hot", [10, 10 ** 9])
def test_substring_dedup_matches_window_table(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", hot)
    rng = random.Random(2)
    rows, n = [], itertools.count(1)
    passage, other = sentence(rng, 70), sentence(rng, 45)
    for i in range(260):
        words = sentence(rng, rng.randrange(5, 120)).split()
        at = rng.randrange(len(words) + 1)
        words[at:at] = (passage if i % 2 else other).split()[rng.randrange(8):]
        rows.append((next(n), " ".join(words), "s"))
    rows += [(next(n), rows[3][1], "copy"), (next(n), "a b " * 60, "periodic"), (next(n), "", "e"), (next(n), None, "e"),
             (next(n), f"{other} {other}", "self")]
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(4)).collect()
    want = brute_repeats(rows)
    assert {r["id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in out} == want
    assert all(r["n_removed"] == sum(s["last"] - s["first"] + 1 for s in r["spans"]) for r in out)


def edit_distance_in(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_myers_is_the_edit_distance():
    rng = random.Random(9)
    for _ in range(150):
        p = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 90)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 120)))
        d, end = decontaminate.myers(p, t)
        assert d == min(len(p), edit_distance_in(p, t))
        assert edit_distance_in(p, t[:end]) == d


def test_decontamination_matches_full_search(spark):
    rng = random.Random(4)
    items = [(i, sentence(rng, rng.randrange(8, 40))) for i in range(12)] + [(90, "short one"), (91, ""), (92, None)]
    rows = []
    for i in range(60):
        t = sentence(rng, 60)
        if i % 3:
            item = list(items[i % 12][1])
            for _ in range(rng.randrange(0, 14)):
                item[rng.randrange(len(item))] = rng.choice("xyz")
            t = f"{t}\n{''.join(item).upper()}, {sentence(rng, 20)}"
        rows.append((i, t, "s"))
    rows += [(100, "A Short, ONE here", "s"), (101, "a shorter one", "s"), (102, None, "s"), (103, "", "s")]
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.find_items(docs, bench).collect()}
    want = {}
    for i, t, _ in rows:
        for item, text in items:
            p = decontaminate.normal(text)
            if not p:
                continue
            k = int(0.06 * len(p)) if len(p) >= decontaminate.SHORT else 0
            p = p if len(p) >= decontaminate.SHORT else f" {p} "
            d = edit_distance_in(p, f" {decontaminate.normal(t)} ")
            if d <= k:
                want[i, item] = d
    assert found == want and (100, 90) in found and (101, 90) not in found
    clean = {r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench).collect()}
    assert clean == {r[0] for r in rows} - {i for i, _ in want}


def test_items_are_read_in_bounded_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 60)
    items = spark.createDataFrame([(i, "some benchmark text number %d" % i) for i in range(7)], "item_id long, text string")
    parts = list(decontaminate.item_blocks(items))
    assert len(parts) > 2 and sorted(i for p in parts for i, _ in p) == list(range(7))
    docs = spark.createDataFrame([(1, "so some benchmark text number 5 it is", "s"), (2, "no", "s")], DOCS)
    assert {r["doc_id"] for r in decontaminate.find_items(docs, items).collect()} == {1}


def test_url_blocks_spread_to_aliases(spark):
    link = '<html><head><link rel="canonical" href="{}"></head></html>'
    fresh = '<meta http-equiv="refresh" content="0; url={}">'
    pages = [
        (1, "http://a.example.net/x", link.format("https://free.test/p")),         # blocked by net/
        (2, "https://free.test/p", ""),                                            # alias of 1
        (3, "http://free.test/q", fresh.format("/p")),                             # redirects to 2
        (4, "http://lone.test/", ""),
        (5, "http://www.example.net/en/z", link.format("https://free.test/p2")),   # allowed
        (6, "http://b.net/x", link.format("//free.test/p2")),                      # blocked, alias of the allowed 5
        (7, "https://free.test/p2#top", ""),                                       # allow takes precedence
        (8, "http://q.example.com/de/a", ""), (9, "http://q.example.com/de", ""), (10, "HTTP://WIKI.ORG/fr/a?x", ""),
        (11, None, None), (12, "no-scheme.net/x", ""), (13, "http://notexample.net", ""), (14, "http://c.net?x=/", ""),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_pages(df).collect()}
    assert got == {
        1: ("net/", "block"), 2: (None, "block"), 3: (None, "block"), 4: (None, "allow"),
        5: ("example.net/en/", "allow"), 6: ("net/", "block"), 7: (None, "allow"), 8: ("example.com/de/", "block"),
        9: (None, "allow"), 10: ("org/fr/", "allow"), 11: (None, "allow"), 12: (None, "allow"), 13: (None, "allow"),
        14: (None, "allow")}


def test_url_parts(spark):
    rows = [("http://Ab.C/x/y?q#f", "ab.c", "/x/y"), ("x://h#a", "h", ""), ("h/p", "", ""), (None, "", ""),
            ("a://b://c/d", "b:", "//c/d"), ("s://É.DE/É", "É.de", "/É")]
    df = spark.createDataFrame(rows, "url string, host string, path string")
    out = df.select("host", "path", url_filter.url_host(F.col("url")).alias("h"), url_filter.url_path(F.col("url")).alias("p"))
    assert all((r["host"], r["path"]) == (r["h"], r["p"]) for r in out.collect())


PAGE = ("<!DOCTYPE html><html><head><title>T {i}</title><style>p{{}}</style></head><body>"
        "<header><div class='logo'>Site</div><h1>Site name</h1></header><nav><ul><li><a href='/'>Home</a><li>News {i}</ul></nav>"
        "<div id='cookie-notice'>We use cookies {i}</div><div class=\"wrap\"><{root}><h2>Title {i} &amp; more</h2>"
        "<p>First   {i}\n text <b>bold</b><br>line<p>Second {i} <script>var x='</p>';</script>end"
        "<div>All rights belong to the site</div><form><input><button>Go</button></form>"
        "<aside>Side {i}</aside><!-- no > --><ul><li>item {i}</li><li>two</li></ul></{close}>"
        "<section class='comments'><article class='comment'><p>A very long reader comment {i}, longer than the text is, "
        "and longer still than it should be for such a small page of a test</p></article></section></div>"
        "<footer>Foot {i}</footer></body></html>")


@pytest.mark.parametrize("root", ["article", "main", "div class='post-body'", "div"])
def test_main_text_by_wrapper(root):
    pages = [PAGE.format(i=i, root=root, close=root.split()[0]) for i in range(8)]
    got = wrapper.extract_group(pages)
    # Texts that are the same on every page stay where they stand inside the article.
    want = ["\n\n".join([f"Title {i} & more", f"First {i} text bold line", f"Second {i} end", "All rights belong to the site",
                         f"item {i}", "two"]) for i in range(8)]
    assert got == want


def test_wrapper_needs_evidence():
    page = "<html><body><article><h1>A</h1><p>One text.</p></article></body></html>"
    assert wrapper.extract_group([page]) == ["A\n\nOne text."]
    assert wrapper.extract_group([page] * 30) == ["A\n\nOne text."] * 30  # copies are one page
    assert wrapper.extract_group(["", "plain text", "<p>open <b", "<a<b>>x"])[:2] == ["", "plain text"]


def test_all_marked_parts_of_a_page_stay():
    two = ("<body><nav>Menu</nav><main><article><header><h2>Part {i}</h2></header><p>Short {i}</article>"
           "<article><p>The longer part {i} of the page</article></main><footer>Foot {i}</footer>")
    got = wrapper.extract_group([two.format(i=i) for i in range(8)])
    assert got == [f"Part {i}\n\nShort {i}\n\nThe longer part {i} of the page" for i in range(8)]
    classed = ("<body><div class='logo'>Site</div><div><p class='text'>One {i}<p class='text'>The second one {i} is longer"
               "<table><tr><td class='content'>Cell {i}<td>Plain {i}</table></div><div><a href='/{i}'>Next {i}</a></div>")
    want = [f"One {i}\n\nThe second one {i} is longer\n\nCell {i}\n\nPlain {i}" for i in range(8)]
    assert wrapper.extract_group([classed.format(i=i) for i in range(8)]) == want


def test_tree_matching_is_the_largest_ordered_match():
    def tree(spec):
        place = wrapper.Place(spec[0])
        place.kids = [tree(s) for s in spec[1:]]
        return place

    a = tree(("r", ("x", ("y",)), ("z",), ("x",)))
    b = tree(("r", ("z",), ("x", ("y",)), ("w",), ("x",)))
    assert wrapper.match(a, b, {}) == 4
    wrapper.align(a, b, {})
    assert len([x for x in wrapper._shape(a) if x]) == 7


def test_main_texts_over_groups(spark, monkeypatch):
    monkeypatch.setattr(wrapper, "GROUP", 4)
    pages = [(i, f"http://h{i % 2}.test/{i}", PAGE.format(i=i, root="article", close="article")) for i in range(20)]
    pages += [(50, None, None), (51, "http://h0.test/", ""), (3, pages[3][1], pages[3][2])]
    out = wrapper.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(out) == 23
    for r in out:
        assert r["n_chars"] == len(r["text"])
        assert (r["page_id"] >= 50) == (r["text"] == "")
        if r["page_id"] < 50:
            assert r["text"].startswith(f"Title {r['page_id']} & more\n\nFirst {r['page_id']} text bold line")


def test_warc_round_trip_of_long_payloads(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("aé漢\U0001F600 \r\n") for _ in range(90_000))
    pages = [(1, "http://x/\r\nWARC/1.1", long), (2, "u", "short\r\n\r\nWARC/1.1\r\n\r\n"), (3, "u", None), (4, "u", ""),
             (5, "v", long), (6, None, long + "x"), (None, "n", "null id"), (7, "w", "twice"), (7, "w", "twice"),
             (8, "w", long + "y"), (8, "w", long + "y"), (8, "w", long + "z")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted(((r["id"], r["type"], r["n_bytes"], r["digest"], r["refers"]) for r in warc.round_trip(df).collect()),
                 key=repr)
    import base64

    want = []
    for i, _, h in pages:
        raw = (h or "").encode()
        top = max((j for j, _, g in pages if (g or "").encode() == raw and j is not None), default=None)
        revisit = top is not None and i != top
        want.append((i, "revisit" if revisit else "response", len(raw),
                     base64.b32encode(hashlib.sha1(raw).digest()).decode(), top if revisit else None))
    assert got == sorted(want, key=repr)


def test_small_payloads_are_never_revisits(spark):
    df = spark.createDataFrame([(i, "u", "same") for i in range(4)], "page_id long, url string, html string")
    assert {r["type"] for r in warc.round_trip(df, min_bytes=5).collect()} == {"response"}


def test_blocks_round_trip(spark):
    rows = [(1, "É\n", "a"), (None, None, "a"), (3, "", "b")]
    out = blocks.packed(spark.createDataFrame(rows, DOCS), 3).toArrow()
    assert sorted(zip(out.column("id").to_pylist(), blocks.unpack(out.column("z").combine_chunks()).to_pylist())) == [
        (blocks.NULL_ID, ""), (1, "É\n"), (3, "")]


def test_warc_rows_of_one_payload_leave_in_batches():
    """A payload of many chunks is sent on while it is cut; its digests come from the first pass."""
    import hashlib

    import pyarrow as pa

    text = "é" * 10_000_000
    first = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([3]), pa.array([text])], ["id", "t1", "t2", "payload"])
    digests = next(warc._digests(iter([first])))
    assert digests["n_bytes"][0].as_py() == 20_000_000
    assert digests["digest"][0].as_py() == warc._base32(hashlib.sha1(text.encode()))
    assert len(digests["running"][0]) == -(-20_000_000 // warc.CHUNK) - 1
    rows = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["u"]), pa.array([text]), digests["n_bytes"], digests["digest"],
                                       digests["running"], pa.array([None], pa.int64())],
                                      ["id", "url", "payload", "n_bytes", "digest", "running", "refers"])
    batches = list(warc._records(iter([rows])))
    assert len(batches) == 3 and max(b.nbytes for b in batches) < warc.BATCH_BYTES + 2 * warc.CHUNK + 500 * 400
    body = "".join(v.split("\r\n\r\n", 1)[1] for b in batches for v in b.column(0).to_pylist())
    assert body == text
