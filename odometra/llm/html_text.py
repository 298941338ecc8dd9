"""Main text of web pages by wrapper induction (operator 6).

Pages of one host share wrappers. All pages of a host are aligned: nodes of their DOM trees
match if they have the same label path (element and class words from the root on), as in
simple tree matching of trees whose neighbours of one label count as one. Counting texts by
path therefore aligns any number of pages without pairs of them. Texts that are the same in
nearly all pages that have the node, or in nearly all pages, are template; what varies is
slots. Near copies of an article count as one page, or the article would look like template:
pages are told apart by what is left without common texts and texts alike to them. In each
page, the deepest node that holds nearly all of what varies, with the heading beside it, is
a vote for its path. A page's text is that of the node with most votes that it has, without
containers in it that are all template (the article's own headings, paragraphs, quotes and
lists stay even where they recur) and without boilerplate: by its element (nav, footer, form, ...), or by a name in
class, id or role (comments, related-posts) if nodes of that path recur in the host, so that
a section of one article is never lost for its name. Only a page without such a node falls
back on <article>, <main>, or the whole body, where such names count by themselves.
"""

from __future__ import annotations

import re
from binascii import crc32
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_in_pandas, materialize, ship_package, table

#: Share of pages in which a template node's text is the same, pages it takes, and their share of the pages that near copies may not go below.
SAME, PAGES, VARIED = 0.8, 4, 0.05
#: Pages that vote for a content node.
VOTES = 2
#: Share of the varying text that the content node holds.
HOLDS = 0.9

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn del em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
DROPPED = frozenset("script style noscript template nav footer aside form iframe svg canvas object embed select button textarea input head title dialog menu audio video".split())
HEADINGS = frozenset("h1 h2 h3 header hgroup".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
PROSE = INLINE | frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre ul ol li dl dt dd table caption colgroup thead tbody tfoot tr td th figure figcaption address details summary center".split())
#: Names in class, id or role that mark what isn't the article: each of the first words, and names made of them and of the second.
MARKS = frozenset("ad ads advert adverts advertisement banner sponsor sponsored promo promoted nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side widget related recommended share sharing social comment comments respond disqus replies cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login form search pagination pager toolbar skip complementary contentinfo".split())
PLAIN = frozenset("site page main global top bottom left right primary secondary list item items box block bar area section wrap wrapper container inner outer content posts post articles links link buttons icons thread tree text row col".split())
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACES = re.compile(r"\s+")


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


class _Paths(dict):
    """Hash of a label path by the hash of its parent's and the label."""

    def __missing__(self, key: tuple[int, str]) -> int:
        if len(self) >= 100_000:
            self.clear()
        value = self[key] = _hash(f"{key[0]}/{key[1]}")
        return value


_paths = _Paths()


class Node:
    __slots__ = ("tag", "label", "children", "parent", "dropped", "noted", "path", "depth")

    def __init__(self, tag: str, attrs: list[tuple[str, str | None]], parent: Node | None) -> None:
        self.tag, self.parent, self.children = tag, parent, []
        named = dict(attrs)
        self.label, self.noted = described(tag, named.get("class"), named.get("id"), named.get("role")) if named else (tag, False)
        self.path, self.depth = (_paths[parent.path, self.label], parent.depth + 1) if parent else (0, 0)
        self.dropped = tag in DROPPED or "hidden" in named or named.get("aria-hidden") == "true"
        if tag == "header":  # of an article it may hold the title
            up = parent
            while up is not None and up.tag not in ("article", "main"):
                up = up.parent
            self.dropped |= up is None
        if tag in ("html", "body", "article", "main"):
            self.dropped, self.noted = "hidden" in named, False

    def out(self, slots: frozenset[int] | None) -> bool:
        """Whether the node is boilerplate: by its element, or by a name that, where a wrapper is known, is one of its slots."""
        return self.dropped or (self.noted and (slots is None or self.path in slots))


def is_mark(name: str) -> bool:
    words = set(filter(None, _SPLIT.split(name)))
    return bool(words & MARKS) and words <= MARKS | PLAIN


@lru_cache(maxsize=100_000)
def described(tag: str, *names: str | None) -> tuple[str, bool]:
    """Label of an element with these class, id and role, and whether they mark what isn't the article."""
    said = " ".join(filter(None, names)).lower()
    words = {w for w in _SPLIT.split(said) if w and not w.isdigit()}
    return tag + "".join(f".{w}" for w in sorted(words)), any(map(is_mark, said.split()))


class _Builder(HTMLParser):
    """A tolerant tree builder: unknown end tags are skipped, open elements closed."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", [], None)
        self.open: Counter[str] = Counter()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self._close("p", CLOSES_P - {"p"})
        elif tag in ("li", "option", "tr"):
            self._close(tag, {"ul", "ol", "table", "select", "menu"})
        elif tag in ("td", "th"):
            self._close("td", {"tr", "table"}) or self._close("th", {"tr", "table"})
        elif tag in ("dt", "dd"):
            self._close("dt", {"dl"}) or self._close("dd", {"dl"})
        node = Node(tag, attrs, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.children.append(Node(tag, attrs, self.at))

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID:
            self._close(tag, {"article", "table"} if tag in INLINE or tag == "p" else ())

    def updatepos(self, i: int, j: int) -> int:
        """Line numbers aren't asked for."""
        return j

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)

    def _close(self, tag: str, barrier: object) -> bool:
        """Close the innermost open element of a tag, if no barrier stands between."""
        node = self.at if self.open[tag] else self.root
        while node.parent is not None:
            if node.tag == tag:
                while self.at is not node.parent:
                    self.open[self.at.tag] -= 1
                    self.at = self.at.parent
                return True
            if node.tag in barrier:
                return False
            node = node.parent
        return False


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def placed(node: Node, slots: frozenset[int] | None = None) -> Iterator[tuple[Node, str]]:
    """Blocks of a subtree in page order with the element that each is in, white space made one blank."""
    line: list[str] = []
    at, stack = node, [node]

    def text() -> str:
        found = _SPACES.sub(" ", "".join(line)).strip()
        line.clear()
        return found

    while stack:
        x = stack.pop()
        if isinstance(x, str):
            line.append(x)
        elif isinstance(x, tuple):  # the end of an element
            if t := text():
                yield at, t
            at = x[0]
        elif x is not node and x.out(slots):
            if x.tag not in INLINE and (t := text()):
                yield at, t
        elif x.tag in ("br", "wbr"):
            line.append(" " if x.tag == "br" else "")
        elif x.tag in INLINE:
            stack.extend(reversed(x.children))
        else:
            if t := text():
                yield at, t
            stack.append((at,))
            at = x
            stack.extend(reversed(x.children))
    if t := text():
        yield at, t


def blocks(node: Node, template: frozenset[int] = frozenset(), slots: frozenset[int] | None = None) -> list[str]:
    """Texts of the blocks of a subtree in page order, without template containers.

    A container is an element below the node that isn't prose itself (div, section, ...). It is
    template if all of its blocks are. Headings, paragraphs, quotes and lists stay wherever
    they recur, unless they are in such a container: articles may end alike.
    """
    found = list(placed(node, slots))
    if not template:
        return [t for _, t in found]
    varies: set[int] = set()
    holders: list[list[int]] = []
    for at, t in found:
        above, x = [], at
        while x is not None and x is not node:
            if x.tag not in PROSE:
                above.append(id(x))
            x = x.parent
        holders.append(above)
        if (h := _hash(t)) not in template and _at(at.path, h) not in template:
            varies.update(above)
    return [t for (_, t), above in zip(found, holders, strict=True) if varies.issuperset(above)]


def _at(path: int, text: int) -> int:
    """Hash of a text at a path."""
    return _hash(f"{path}:{text}")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def sketches(texts: list[str]) -> list[list[int]]:
    """Two smallest hashes, by two functions, of each text's runs of three words (its end is followed by its start)."""
    words = [t.split() for t in texts]
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    x = np.array([crc32(w.encode("utf-8", "surrogatepass")) for ws in words for w in ws], np.uint64)
    following = np.arange(1, len(x) + 1)
    following[ends - 1] = starts
    y = x[following]
    runs = _mixed(_mixed(_mixed(x) + y) + y[following])
    return [(np.minimum.reduceat(_mixed(runs + np.uint64(k)), starts) >> np.uint64(1)).astype(np.int64).tolist() for k in (1, 2)]


def outline(html: str) -> tuple:
    """What induction needs of a page: paths of its outermost nodes with a mark; of its blocks the path, text, text at the path, two sketches and length; the paths above blocks with the parent's place and depth, and whether it is a heading."""
    root = parse(html)
    found, noted, stack = list(placed(root)), set(), [root]
    while stack:
        x = stack.pop()
        if x.noted:
            noted.add(x.path)
        elif not x.dropped:
            stack.extend(c for c in x.children if isinstance(c, Node))
    paths = [at.path for at, _ in found]
    texts = [_hash(t) for _, t in found]
    ats = [_at(p, t) for p, t in zip(paths, texts, strict=True)]
    first, second = sketches([t for _, t in found]) if found else ([], [])
    place: dict[int, int] = {}
    ups: list[int] = []
    nodes: list[Node] = []
    for at, _ in found:
        chain = []
        while at is not None and at.path not in place:
            chain.append(at)
            at = at.parent
        for node in reversed(chain):
            place[node.path] = len(ups)
            ups.append(place[node.parent.path] if node.parent else -1)
            nodes.append(node)
    tokens = {(0, t) for t in (*texts, *first, *second)} | set(zip(paths, ats, strict=True))
    return list(noted), texts, ats, first, second, [len(t) for _, t in found], [place[p] for p in paths], [k for k, _ in tokens], [t for _, t in tokens], list({0, *paths}), list(place), ups, [n.depth for n in nodes], [n.tag in HEADINGS for n in nodes]


_OUTLINE = "noted array<long>, texts array<long>, ats array<long>, first array<long>, second array<long>, chars array<long>, places array<long>, keys array<long>, tokens array<long>, held array<long>, paths array<long>, ups array<long>, depths array<long>, headings array<boolean>"


def vote(texts, ats, chars, places, paths, ups, depths, headings, template: frozenset[int]) -> int | None:
    """Path of the page's content node; none if nothing below the body holds what varies."""
    own = [0] * len(paths)
    for t, a, n, k in zip(texts, ats, chars, places, strict=True):
        if t not in template and a not in template:
            own[k] += n
    inner = set(ups)
    for k in range(len(paths) - 1, 0, -1):  # parents stand before their children
        own[ups[k]] += own[k]
    total = own[0] if own else 0
    best = max((k for k in inner if k >= 0 and depths[k] > 2 and own[k] >= HOLDS * total), key=lambda k: depths[k], default=None) if total else None
    while best is not None and depths[ups[best]] > 2 and any(h and own[k] and ups[k] == ups[best] for k, h in enumerate(headings)):
        best = ups[best]
    return None if best is None else int(paths[best])


def _find(node: Node, paths: list[int], slots: frozenset[int]) -> list[Node]:
    """Nodes on the first of the paths that has text."""
    wanted, found, stack = set(paths), {}, [node]
    while stack:
        x = stack.pop()
        if x.path in wanted:
            found.setdefault(x.path, []).append(x)
        stack.extend(c for c in reversed(x.children) if isinstance(c, Node) and not c.out(slots))
    return next((some for p in paths if p in found and (some := [n for n in found[p] if next(placed(n, slots), None)])), [])


def _all(node: Node, tag: str) -> list[Node]:
    """Outermost elements of a tag outside boilerplate, in page order."""
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if x.tag == tag:
            out.append(x)
            continue
        stack.extend(c for c in reversed(x.children) if isinstance(c, Node) and not c.out(None))
    return out


def extract(html: str | None, paths: list[int] | None, template: frozenset[int], slots: frozenset[int] = frozenset()) -> str:
    """The text of the node on the first of a wrapper's paths; without one, of <article>, <main> or the body."""
    root = parse(html)
    if paths and (found := _find(root, paths, slots)):
        return "\n\n".join(t for n in found for t in blocks(n, template, slots))
    found = _all(root, "article") or _all(root, "main") or [root]
    return "\n\n".join(t for n in found for t in blocks(n, template))


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _outlined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in _OUTLINE.split(", ")]
    for pdf in batches:
        yield pd.concat([pdf[["host"]].reset_index(drop=True), pd.DataFrame([outline(h) for h in pdf["html"]], columns=names)], axis=1)


def _voted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        names = ["texts", "ats", "chars", "places", "paths", "ups", "depths", "headings"]
        got = [vote(*x, frozenset(() if t is None else t)) for t, *x in zip(pdf["template"], *[pdf[c] for c in names], strict=True)]
        kept = [(h, p) for h, p in zip(pdf["host"], got, strict=True) if p is not None]
        yield pd.DataFrame(kept, columns=["host", "path"]).astype({"host": "object", "path": "int64"})


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, paths, template, slots) of (host, html): content nodes by votes, texts that are template, marked nodes that recur.

    Every page counts, by its whole html. Counts are made per partition first, so that a host
    with a third of all pages is no group of one task.
    """
    outlines = materialize(pages.where("html is not null").select("host", "html").mapInPandas(_outlined, f"host string, {_OUTLINE}"))
    token = F.explode(F.arrays_zip("keys", "tokens")).alias("x")
    counts = outlines.select("host", token).groupBy("host", F.col("x.keys").alias("key"), F.col("x.tokens").alias("token")).agg(F.count("*").alias("n")).where(F.col("n") >= PAGES)
    sizes = outlines.select("host", F.explode("held").alias("key")).groupBy("host", "key").agg(F.count("*").alias("pages"))
    common = materialize(counts.join(sizes, ["host", "key"]).where(F.col("n") >= SAME * F.col("pages")).groupBy("host").agg(F.collect_set("token").alias("common")))
    own = F.filter(F.arrays_zip("texts", "ats", "first", "second"), lambda b: ~F.coalesce(F.arrays_overlap("common", F.array(b["texts"], b["ats"], b["first"], b["second"])), F.lit(False)))
    told = outlines.join(common, "host").withColumn("own", F.coalesce(F.array_min(F.transform(own, lambda b: b["first"])), F.lit(0)))
    kept = told.select("host", "own", F.explode(F.filter(F.arrays_zip("keys", "tokens"), lambda x: F.array_contains("common", x["tokens"]))).alias("x"))
    same = kept.groupBy("host", F.col("x.keys").alias("key"), F.col("x.tokens").alias("token")).agg(F.count_distinct("own").alias("n"))
    differ = told.select("host", "own", F.explode("held").alias("key")).groupBy("host", "key").agg(F.count_distinct("own").alias("differ"), F.count("*").alias("pages"))
    fixed = same.join(differ, ["host", "key"]).where((F.col("n") >= PAGES) & (F.col("n") >= SAME * F.col("differ")) & (F.col("differ") >= VARIED * F.col("pages")))
    template = materialize(fixed.groupBy("host").agg(F.collect_set("token").alias("template")))
    voted = outlines.select("host", "texts", "ats", "chars", "places", "paths", "ups", "depths", "headings").join(template, "host", "left").mapInPandas(_voted, "host string, path long")
    votes = voted.groupBy("host", "path").agg(F.count("*").alias("n")).where(F.col("n") >= VOTES)
    paths = votes.groupBy("host").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "path"))).alias("found")).select("host", F.col("found.path").alias("paths"))
    slots = outlines.select("host", F.explode("noted").alias("path")).groupBy("host", "path").agg(F.count("*").alias("n")).where(F.col("n") >= PAGES)
    slots = slots.groupBy("host").agg(F.collect_set("path").alias("slots"))
    return paths.join(template, "host", "full").join(slots, "host", "left")


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), a row per input row.

    Null and empty html give empty text; pages without a host in their url share the host
    ''; repeated rows give equal texts; an empty table gives no rows.
    """
    named = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).withColumn("host", host_of(F.col("url")))
    ship_package(pages.sparkSession)
    known = materialize(wrappers(named)).withColumnRenamed("host", "known_host")
    joined = named.join(known, F.col("host") == F.col("known_host"), "left").select("page_id", "url", "html", "paths", "template", "slots")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            held = [[frozenset(() if x is None else x) for x in pdf[c]] for c in ("template", "slots")]
            texts = [extract(h, None if p is None else list(p), t, n) for h, p, t, n in zip(pdf["html"], pdf["paths"], *held, strict=True)]
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return map_in_pandas(joined, run, "page_id long, url string, text string, n_chars long", key="page_id")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
