"""Main text of pages by wrapper induction.

Pages of one host are parsed into trees of block elements.  Runs of siblings
with one label are folded, so a page is a small skeleton.  The skeletons of a
group of same-host pages are aligned by simple tree matching (the largest
order-preserving match of the children of two equal nodes) and merged into one
template.  A text that fills its template node on nearly all pages is constant;
a node whose text varies is a slot.

The article is what the outermost ``article`` and ``main`` elements hold, in
page order.  Inside an article element (or a ``main`` without one) all text is
the article's, constants too, but for elements whose role is sure: menus,
asides, footers, forms, comments, adverts.  An element whose class could be a
role or a subject (``teaser``, ``widget-theory``) goes only where the template
finds its text constant.  Beside an article element roles by class decide.

Where a page has no such element the template's slots choose: the article
reaches from the first slot that is not mostly links to the last, with all that
stands between, the headings right before, and next to it texts of a slot's own
node and link paragraphs of a slot's element.  A template is trusted from ``TRUSTED`` different pages
on; below that every block counts as a slot.

A host's pages are dealt into groups of about ``GROUP`` pages or ``GROUP_BYTES``
by a hash of id, url and text, each with its own template, so a host with a
third of all pages is many small groups; rows repeated in a batch travel as one
row and a count.  Trees of any depth are walked without recursion.

Nulls and edge cases: null or empty html gives an empty text; a null url, or
one without host, belongs to the empty host; a very long page is parsed whole;
repeated rows each get their text; an empty table gives an empty result.  Other
columns, whatever their names, are never read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.llm.common import durable
from pactum.llm.url_filter import url_host

GROUP = 200
GROUP_BYTES = 8 << 20
TRUSTED = 5
CONSTANT_SHARE = 0.9

# Element names and words of class or id attributes with a known role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas audio video title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
SKIPPED = frozenset("nav header footer aside form button select textarea menu dialog fieldset head".split())
ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert menu menubar toolbar".split())
# Class and id words of a sure role (whole words, or joined to a PART), and those that can also be a subject.
SURE = frozenset(
    "ad ads advert adverts advertisement adbox breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "gdpr masthead menu nav navbar navigation notice notices pager pagination sidebar sponsor sponsored toolbar".split())
PART = frozenset(
    "area bar block box banner container content footer form group header inner item items left list main message notice "
    "notices outer panel policy primary region right row section secondary slot top bottom unit wrap wrapper text thread "
    "widget".split())
DOUBTFUL = frozenset(
    "banner disclaimer form header login modal newsletter overlay popup promo promotion recommended related replies reply "
    "respond search share sharing signup social subscribe subscription teaser widget".split())
ARTICLE_WORDS = frozenset("ad ads advert comment comments promo related reply sponsored teaser".split())
BODY_WORDS = frozenset("article body content entry main post story text".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
          "thead": {"tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}}
SCOPES = frozenset("ul ol dl table article main section div body html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?][^>]*>", re.S)
_ATTR = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_NAME = re.compile(r"[^\s]+")
_WHITE = re.compile(r"\s+")


class Node:
    """A block element: label, children (nodes and (text, linked) pairs) and its role.

    ``role``: 2 never part of an article, 1 perhaps (its class can also be a subject), 0 no role.
    """

    __slots__ = ("tag", "label", "kids", "role", "body", "place")

    def __init__(self, tag: str, label: str, role: int, body: bool):
        self.tag, self.label, self.role, self.body = tag, label, role, body
        self.kids: list = []
        self.place: Place | None = None


class Place:
    """A folded skeleton node, or a template node once merged: children, texts and their pages."""

    __slots__ = ("label", "kids", "texts", "merged")

    def __init__(self, label: str):
        self.label = label
        self.kids: list[Place] = []
        self.texts: Counter = Counter()
        self.merged: Place | None = None


def _sure(name: str) -> bool:
    """A class or id that is a role's word, or such words joined to words for parts (``cookie-notice``, ``ad_box2``)."""
    words = [w for w in _SPLIT.split(name) if w]
    return any(w in SURE for w in words) and all(w in SURE or w in PART or w in DOUBTFUL for w in words)


def _role(tag: str, attrs: str) -> tuple[str, int, bool]:
    found = {k.lower(): (a or b or c).lower() for k, a, b, c in _ATTR.findall(attrs)} if "=" in attrs else {}
    kinds = found.get("class", "")
    names = _NAME.findall(kinds + " " + found.get("id", ""))
    words = {w for name in names for w in _SPLIT.split(name) if w}
    role = found.get("role", "")
    if tag in ("main", "body", "html"):
        sure = doubt = False
    elif tag == "article":
        # An article element of a role's class is a comment, a card of another article, an advert.
        sure, doubt = any(_sure(n) for n in names) or bool(words & ARTICLE_WORDS), False
    else:
        sure = tag in SKIPPED or role in ROLES or any(_sure(n) for n in names)
        doubt = bool(words & DOUBTFUL) or bool(words & SURE)
    body = tag in ("article", "main") or role in ("main", "article") or "articlebody" in found.get("itemprop", "") \
        or bool(words & BODY_WORDS)
    return f"{tag}.{' '.join(sorted(w for w in _SPLIT.split(kinds) if w))}", 2 if sure else int(doubt), body


def parse(page: str) -> Node:
    root = Node("html", "html.", 0, False)
    stack = [root]
    opened: Counter = Counter()
    links = 0
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            stack[-1].kids.append((text, links > 0))
        if not m:
            break
        at = m.end()
        close, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            continue
        tag = tag.lower()
        if not close and tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            if not attrs.rstrip().endswith("/") or tag in ("script", "style"):
                at = end.end() if end else n
            continue
        if tag == "a":
            links = 0 if close else 1
        if tag in INLINE:
            if tag == "br":
                stack[-1].kids.append((" ", False))
            continue
        if tag in ("html", "body") or tag in VOID:
            if tag == "hr":
                stack[-1].kids.append(Node("hr", "hr.", 0, False))
            continue
        if close:
            if opened[tag]:
                while stack[-1].tag != tag:
                    opened[stack.pop().tag] -= 1
                opened[stack.pop().tag] -= 1
                links = 0
            continue
        if stack[-1].tag == "p":
            opened[stack.pop().tag] -= 1
        if any(opened[x] for x in CLOSES.get(tag, ())):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in CLOSES[tag]:
                    opened.subtract(x.tag for x in stack[i:])
                    del stack[i:]
                    break
                if stack[i].tag in SCOPES:
                    break
        node = Node(tag, *_role(tag, attrs))
        stack[-1].kids.append(node)
        if not attrs.rstrip().endswith("/") or tag in ("p", "div", "article", "section", "main", "li"):
            stack.append(node)
            opened[tag] += 1
    return root


def _clean(text: str) -> str:
    return _WHITE.sub(" ", entities.unescape(text)).strip()


def fold(root: Node) -> Place:
    """The page's skeleton: a run of sibling nodes of one label is one place, with the children of all of them."""
    top = Place(root.label)
    todo = [([root], top)]
    while todo:
        nodes, place = todo.pop()
        run: list[Node] = []
        for node in nodes:
            node.place = place
            for kid in node.kids:
                if isinstance(kid, Node):
                    if run and kid.label == run[0].label:
                        run.append(kid)
                        continue
                    run = [kid]
                    place.kids.append(Place(kid.label))
                    todo.append((run, place.kids[-1]))
    return top


def _shape(place: Place) -> tuple:
    """The labels in order with their ends, equal for equal trees."""
    out: list = []
    todo: list = [place]
    while todo:
        p = todo.pop()
        out.append(p if p is None else p.label)
        if p is not None:
            todo.append(None)
            todo.extend(reversed(p.kids))
    return tuple(out)


def match(a: Place, b: Place, memo: dict) -> int:
    """Simple tree matching: nodes in the largest order-preserving match of two trees."""
    if a.label != b.label:
        return 0
    todo = [(a, b)]
    while todo:
        x, y = todo[-1]
        if (id(x), id(y)) in memo:
            todo.pop()
            continue
        below = [(p, q) for p in x.kids for q in y.kids if p.label == q.label and (id(p), id(q)) not in memo]
        if below:
            todo += below
        else:
            memo[id(x), id(y)] = 1 + _table(x, y, memo)[-1][-1]
    return memo[id(a), id(b)]


def _table(a: Place, b: Place, memo: dict) -> list[list[int]]:
    """Matched nodes of each pair of prefixes of the children, their own matches being in ``memo``."""
    rows = [[0] * (len(b.kids) + 1)]
    for x in a.kids:
        row = [0]
        for j, y in enumerate(b.kids):
            both = rows[-1][j] + memo[id(x), id(y)] if x.label == y.label else 0
            row.append(max(row[j], rows[-1][j + 1], both))
        rows.append(row)
    return rows


def align(template: Place, page: Place, memo: dict) -> None:
    """Merge a page's skeleton into the template; each skeleton node learns its template node."""
    match(template, page, memo)
    todo = [(template, page)]
    while todo:
        into, new = todo.pop()
        new.merged = into
        rows = _table(into, new, memo)
        i, j, pairs = len(into.kids), len(new.kids), {}
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs[j] = into.kids[i]
        kids, known = [], iter(into.kids)
        for j, kid in enumerate(new.kids):
            if j in pairs:
                for old in known:
                    kids.append(old)
                    if old is pairs[j]:
                        break
                todo.append((pairs[j], kid))
            else:
                kids.append(_adopt(kid))
        into.kids = [*kids, *known]


def _adopt(place: Place) -> Place:
    """A copy of a skeleton as new template nodes."""
    top = place.merged = Place(place.label)
    todo = [place]
    while todo:
        p = todo.pop()
        for kid in p.kids:
            kid.merged = Place(kid.label)
            p.merged.kids.append(kid.merged)
            todo.append(kid)
    return top


def _copy_merged(known: Place, page: Place) -> None:
    todo = [(known, page)]
    while todo:
        a, b = todo.pop()
        b.merged = a.merged
        todo += zip(a.kids, b.kids, strict=True)


class Block(NamedTuple):
    """A run of text between block tags: its element and the element above, its template node, share of link text."""

    text: str
    node: Node
    parent: Node | None
    place: Place
    linked: float
    doubtful: bool


def _blocks(root: Node, article: bool) -> list[Block]:
    """All blocks below ``root`` but those of elements that are no part of an article.

    ``article``: the root belongs to the article, so only sure roles go and others are marked doubtful.
    """
    out: list[Block] = []

    def flush(node, parent, parts, body, doubt):
        text = _clean("".join(t for t, _ in parts)) if parts else ""
        if text:
            linked = 0 if body else sum(len(t) for t, a in parts if a)
            out.append(Block(text, node, parent, node.place.merged, linked / max(1, sum(len(t) for t, _ in parts)), doubt))
        parts.clear()

    # A frame is a node, what is left of its children, the open run of text and what holds for its text.
    frames = [(root, None, iter(root.kids), [], article, article, False)]
    while frames:
        node, parent, kids, parts, inside, body, doubt = frames[-1]
        for kid in kids:
            if not isinstance(kid, Node):
                parts.append(kid)
                continue
            flush(node, parent, parts, body, doubt)
            if kid.tag == "header" and body:
                # Of a header inside the article only the headings are its text.
                heads = [h for h in kid.kids if isinstance(h, Node) and h.tag in HEADINGS]
                frames.append((kid, node, iter(heads), [], inside, body, doubt))
                break
            if kid.role == 2 or (kid.role == 1 and not inside):
                continue
            now = inside or kid.tag == "article" or (kid.tag == "main" and not _holds(kid, "article"))
            frames.append((kid, node, iter(kid.kids), [], now, body or kid.body, doubt or kid.role == 1))
            break
        else:
            flush(node, parent, parts, body, doubt)
            frames.pop()
    return out


def _holds(node: Node, tag: str) -> bool:
    todo = [k for k in node.kids if isinstance(k, Node)]
    while todo:
        n = todo.pop()
        if n.role != 2:
            if n.tag == tag:
                return True
            todo += [k for k in n.kids if isinstance(k, Node)]
    return False


def _roots(page: Node) -> list[Node]:
    """The elements that hold the article, in page order: none inside another; empty if there are none."""
    out, todo = [], [page]
    while todo:
        node = todo.pop()
        if node.tag in ("article", "main"):
            out.append(node)
        else:
            todo += [k for k in reversed(node.kids) if isinstance(k, Node) and (k.role == 0 or k.tag in ("article", "main"))
                     and k.role != 2]
    return out


def _chosen(blocks: list[Block], constant) -> list[Block]:
    """Of a page without article elements: from the first slot of text to the last, and what belongs to them."""
    core = [i for i, b in enumerate(blocks) if b.linked <= 0.5 and not constant(b)]
    if not core:
        return []
    first, last = core[0], core[-1]
    homes, places = {id(blocks[i].parent) for i in core}, {id(blocks[i].place) for i in core}

    def beside(b: Block) -> bool:
        if id(b.place) in places and b.linked <= 0.5:
            return True
        return b.node.tag == "p" and id(b.parent) in homes and not constant(b)

    while first and (blocks[first - 1].node.tag in HEADINGS or beside(blocks[first - 1])):
        first -= 1
    while last + 1 < len(blocks) and beside(blocks[last + 1]):
        last += 1
    return blocks[first:last + 1]


def extract_group(pages: list[str]) -> list[str]:
    """Main text of each page of a same-host group, by the template of the group."""
    template: Place | None = None
    by_shape: dict[tuple, Place] = {}
    parsed: list[tuple[bool, list[Block]]] = []
    for page in pages:
        root = parse(page)
        skeleton = fold(root)
        shape = _shape(skeleton)
        if shape in by_shape:
            _copy_merged(by_shape[shape], skeleton)
        else:
            by_shape[shape] = skeleton
            if template is None:
                template = _adopt(skeleton)
            else:
                align(template, skeleton, {})
        roots = _roots(root)
        out: list[Block] = []
        for node in roots or [root]:
            out += _blocks(node, bool(roots) and (node.tag == "article" or not _holds(node, "article")))
        parsed.append((bool(roots), out))
    seen_pages = set()
    for _, out in parsed:
        key = tuple(b.text for b in out)
        if key not in seen_pages:
            seen_pages.add(key)
            for text, place in {(b.text, id(b.place)): (b.text, b.place) for b in out}.values():
                place.texts[text] += 1
    enough = max(TRUSTED, CONSTANT_SHARE * len(seen_pages))

    def constant(b: Block) -> bool:
        return len(seen_pages) >= TRUSTED and b.place.texts[b.text] >= enough

    result = []
    for marked, out in parsed:
        out = [b for b in out if not (b.doubtful and constant(b))]
        result.append("\n\n".join(b.text for b in (out if marked else _chosen(out, constant))))
    return result


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed pages; rows repeated in a batch become one row and a count."""
    press = zstandard.ZstdCompressor(level=3)
    for b in batches:
        rows = Counter(zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True))
        cols = list(zip(*rows, strict=True)) if rows else [()] * b.num_columns
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, b.schema.field(i).type) for i, c in enumerate(cols[:-1])],
             pa.array([press.compress(t.encode()) for t in cols[-1]], pa.binary()), pa.array(rows.values(), pa.int64())],
            [*b.schema.names[:-1], "z", "copies"])


def _extract(t: pa.Table) -> pa.Table:
    t = t.combine_chunks().sort_by([("page_id", "ascending"), ("url", "ascending"), ("h", "ascending")])
    grow = zstandard.ZstdDecompressor()
    texts = extract_group([grow.decompress(z).decode() if len(z) else "" for z in t.column("z").to_pylist()])
    return pa.table({"page_id": t.column("page_id"), "url": t.column("url"), "text": pa.array(texts, pa.string()),
                     "n_chars": pa.array([len(x) for x in texts], pa.int64()), "copies": t.column("copies")})


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row."""
    url = F.col(url_col).cast("string")
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), url_host(url).alias("host"),
                     html.alias("html"))
    counts = durable(p.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("html")).alias("bytes")),
                     "host-pages")
    parts = F.ceil(F.greatest(F.col("n") / F.lit(GROUP), F.col("bytes") / F.lit(GROUP_BYTES), F.lit(1.0)))
    z = p.select("page_id", "url", "host", F.xxhash64("page_id", "url", "html").alias("h"), "html").mapInArrow(
        _squeeze, "page_id long, url string, host string, h long, z binary, copies long")
    dealt = z.join(counts.withColumnRenamed("host", "c_host"), F.col("host") == F.col("c_host")).withColumn(
        "part", F.pmod(F.col("h"), parts).cast("int"))
    out = dealt.select("host", "part", "page_id", "url", "h", "z", "copies").groupBy("host", "part").applyInArrow(
        _extract, "page_id long, url string, text string, n_chars long, copies long")
    return out.select("page_id", "url", "text", "n_chars", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")
