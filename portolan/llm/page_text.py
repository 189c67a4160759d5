"""Main text of web pages, from the container that the pages of a host agree on."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.operators.lookup import lookup_join
from portolan.sources.scratch import store

# Elements of HTML by their part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body br canvas center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre"
    " search section summary table tbody td tfoot th thead title tr ul video".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
CONTAINERS = frozenset("article body center div main section td".split())
DROPPED = frozenset(
    "aside audio button datalist dialog embed footer form head header iframe input label menu nav noembed"
    " noframes noscript script search select style svg template textarea title video xmp".split()
)
# A start tag closes an open element of these, up to the nearest of the second set.
CLOSES = {t: ({"p"}, {"button", "td", "th", "table"}) for t in BLOCKS - {"br", "body", "html", "head", "option", "tbody", "td", "th", "tr", "title"}} | {
    "li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
# Words in classes, ids and roles of what is not the article. They count if the name they
# are part of has just such words and those of layout: "search-box", not "search-term".
OTHER_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs byline comment commentary"
    " comments complementary consent contentinfo cookie cookies copyright dialog discussion disqus footer form gdpr header"
    " login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo"
    " promoted promotion related reply replies respond responses search share sharing sidebar signup skip social sponsor"
    " sponsored subscribe toolbar widget widgets".split()
)
LAYOUT_WORDS = frozenset(
    "area article articles bar block bottom box button buttons col column container desktop entry fixed form global group"
    " header home icons inner item items layout left link links list main mobile module outer page panel post posts primary"
    " right row secondary section site slot small sticky stories sub top unit wrap wrapper".split()
)
ARTICLE_WORDS = frozenset("article body content entry main post story text".split())

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_QUOTED = re.compile(r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
# Tags whose quotes do not close before the page ends are read up to the next ">"; a page
# with so many of them is read without regard to quotes, as each costs a look at its rest.
_BROKEN_QUOTES = 8
_MARK = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+|\d+")
_LONGEST_PATH = 400
# A host's paths are those that at least one in LAYOUTS of its pages votes for, two at least,
# and the one with most votes.
LAYOUTS = 5


@dataclass(slots=True)
class Element:
    tag: str
    parent: Element | None
    path: str
    dropped: bool
    box: Element | None = None  # the nearest container, itself included
    weight: int = 0  # of a container: score per character
    score: int = 0
    linked: bool = False


def _marks(attributes: str, other_words: frozenset[str]) -> tuple[str, set[str], bool]:
    """Classes (else the id) with digits generalised, the words of classes, id and role, and
    whether one of these names something else than the article."""
    found: dict[str, str] = {}
    for name, a, b, c in _MARK.findall(attributes):
        found.setdefault(name.lower(), html.unescape(a or b or c).lower())
    named = sorted(set(found.get("class", "").split())) or found.get("id", "").split()
    words, other = set(), False
    for name in " ".join(found.values()).split():
        parts = {p for p in _PART.findall(name) if not p.isdigit()}
        other |= bool(parts & other_words) and parts <= other_words | LAYOUT_WORDS
        words |= parts
    return "".join("." + re.sub(r"\d+", "#", n) for n in named), words, other


def _tokens(source: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """start, end, whether it ends an element, name and attributes of the tags of a page, in
    one pass; comments and declarations have no name. The caller may send a place to go on from."""
    at, last, broken = 0, source.rfind(">"), 0
    while (start := source.find("<", at)) >= 0:
        at = start + 1
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(source)
            yield start, at, False, "", ""
            continue
        if source[at : at + 1] in ("!", "?"):
            end = source.find(">", at)
            at = end + 1 if end >= 0 else len(source)
            yield start, at, False, "", ""
            continue
        if at > last or not (m := _NAME.match(source, at)):
            continue  # a tag that never ends is text, as other signs are
        rest = _QUOTED.match(source, m.end()) if broken < _BROKEN_QUOTES else None
        if rest:
            attributes, at = rest[1], rest.end()
        else:
            broken += 1
            end = source.find(">", m.end())
            attributes, at = source[m.end() : end], end + 1
        at = (yield start, at, bool(m[1]), m[2].lower(), attributes) or at


class Page:
    """Elements and text of a page; ``parts`` has (element, text), element None at the
    edge of a block. ``forms`` tells whether forms are dropped."""

    def __init__(self, source: str, forms: bool = True):
        self.root = Element("", None, "", False, weight=1)
        self.root.box = self.root
        self.containers = [self.root]
        self.parts: list[tuple[Element | None, str]] = []
        stack, at = [self.root], 0
        places: dict[str, list[int]] = {}  # where elements of each name are in the stack
        dropped = DROPPED if forms else DROPPED - {"form"}
        other_words = OTHER_WORDS if forms else OTHER_WORDS - {"form"}

        def text(until: int) -> None:
            if until > at:
                run = source[at:until]
                self.parts.append((stack[-1], html.unescape(run) if "&" in run else run))

        def nearest(tags) -> int:
            return max((places[t][-1] for t in tags if places.get(t)), default=0)

        def cut(last: int) -> None:
            for e in stack[last:]:
                places[e.tag].pop()
            del stack[last:]

        def close(tags: set[str], stops: set[str]) -> None:
            last = nearest(tags)
            if last and last >= nearest(stops) and last >= nearest(CONTAINERS):
                while last > 1 and stack[last - 1].tag in tags and stack[last - 1].tag not in stops:
                    last -= 1
                cut(last)

        tokens, sent = _tokens(source), None
        while True:
            try:
                start, end, ending, tag, attributes = tokens.send(sent)
            except StopIteration:
                break
            sent = None
            text(start)
            at = end
            if not tag:
                continue
            if tag in BLOCKS:
                self.parts.append((None, " "))
            if ending:
                found = nearest((tag,))
                # A stray end tag does not close what is around it.
                if found and (tag in CONTAINERS or tag in ("html", "table") or found >= nearest(("article", "main", "body", "td"))):
                    cut(found)
                continue
            if tag in CLOSES:
                close(*CLOSES[tag])
            label, words, other = _marks(attributes, other_words) if attributes else ("", set(), False)
            parent = stack[-1]
            path = f"{parent.path}/{tag}{label}"
            if len(path) > _LONGEST_PATH:
                path = "~" + xxhash.xxh64_hexdigest(path)
            out = parent.dropped or tag in dropped or (other and tag in BLOCKS and tag not in ("html", "body", "main", "article"))
            element = Element(tag, parent, path, out, parent.box, linked=parent.linked or tag == "a")
            if tag in CONTAINERS and not out:
                element.weight = 8 if tag == "article" else 5 if tag == "main" else 3 if words & ARTICLE_WORDS else 2
                element.box = element
                self.containers.append(element)
            if tag in RAW:
                closing = re.compile(f"</{tag}(?=[\\s/>])|</{tag}\\Z", re.I).search(source, end)
                close_at = source.find(">", closing.start()) if closing else -1
                at = sent = close_at + 1 if close_at >= 0 else len(source)
            elif tag not in VOID and not attributes.endswith("/") or tag in CONTAINERS:
                places.setdefault(tag, []).append(len(stack))
                stack.append(element)
        text(len(source))

    def best(self) -> Element:
        """The container with most text of its own: text counts whole for the nearest
        container and half as much for each one further out; links do not count."""
        for element, run in self.parts:
            if element is None or element.dropped or element.linked:
                continue
            worth, box = len(run.strip()) * 16, element.box
            for _ in range(5):
                box.score += worth * box.weight
                if box.parent is None:
                    break
                worth, box = worth // 2, box.parent.box
        return max(self.containers, key=lambda c: c.score)  # the first of equals

    def inside(self, path: str) -> str:
        """Text of the outermost containers at ``path``, without what is dropped."""
        within: dict[int, bool] = {}
        chosen = {id(c) for c in self.containers if c.path == path}

        def kept(element: Element | None) -> bool:
            line = []
            while element is not None and id(element) not in within:
                line.append(element)
                if id(element) in chosen:
                    within[id(element)] = True
                    break
                element = element.parent
            inner = element is not None and within[id(element)]
            for e in line:
                within[id(e)] = inner
            return inner

        runs = [run for element, run in self.parts if element is None or not element.dropped and kept(element)]
        return " ".join("".join(runs).split())


def read(source: str | None) -> Page:
    """The page, with forms kept if nothing else holds text."""
    page = Page(source or "")
    if any(e is not None and not e.dropped and run.strip() for e, run in page.parts):
        return page
    return Page(source or "", forms=False)


def host_of(url_col: str) -> Column:
    authority = F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#\\]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", ""))


def host_paths(pages: DataFrame, html_col: str) -> DataFrame:
    """host, paths: the container paths that the host's pages score best, most votes first.

    Each page has one vote; of equal votes the greater score counts, then the path by name.
    Pages without a host do not vote.
    """

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bests = [read(t.as_py()).best() for t in batch.column(1)]
            at = [i for i, b in enumerate(bests) if b.score]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array([bests[i].path for i in at], pa.string()), pa.array([bests[i].score for i in at], pa.int64())],
                names=["host", "path", "score"],
            )

    votes = pages.filter("host <> ''").select("host", F.col(html_col).cast("string")).mapInArrow(vote, "host string, path string, score long")
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("score").alias("score"))
    most = counted.groupBy("host").agg(F.sum("votes").alias("all"), F.max(F.struct("votes", "score", "path"))["path"].alias("first"))
    layouts = lookup_join(counted, most, ["host"]).filter(
        (F.col("path") == F.col("first")) | ((F.col("votes") > 1) & (F.col("votes") * LAYOUTS >= F.col("all")))
    )  # LAYOUTS a host at most
    ordered = F.sort_array(F.collect_list(F.struct("votes", "score", "path")), asc=False)
    return layouts.groupBy("host").agg(F.transform(ordered, lambda x: x["path"]).alias("paths"))


def article(page: Page, paths: list[str] | None) -> str:
    """The text at the path of ``paths`` that scores best on the page, or at its own best
    container if none of them has text there."""
    own = page.best()
    if paths:
        agreed = sorted((c for c in page.containers if c.path in paths), key=lambda c: -c.score)
        for path in dict.fromkeys(c.path for c in agreed):
            if found := page.inside(path):
                return found
    return page.inside(own.path)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col`` and text: the main text of every page, empty if it has none.

    Containers of each page are scored, and the pages of a host vote on the path of tags
    and classes (digits generalised) of the best one. Paths with a good share of a host's
    votes, so that it may have several layouts, are its own; each page is read again at the
    one of them that scores best on it, or at its own best container where none has text
    there or the page has no host. Menus, headers, footers, sidebars, notices, adverts,
    forms, scripts, styles and reader comments inside the container are dropped, known by
    their elements or by names made of such words alone. Character references are decoded,
    white space in a block is one space, blocks are joined by one space. Null html is an
    empty page. Broken markup is read as far as it goes, in time in proportion to its
    length. Of pages alike each votes and returns a row; an empty table gives none. Other
    columns are not read, whatever their names.
    """
    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).cast("string").alias("_html"), host_of(url_col).alias("host"))
    paths = store(host_paths(rows, "_html"), "host-paths")
    schema = T.StructType([pages.schema[id_col], pages.schema[url_col], T.StructField("text", T.StringType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source, paths in zip(batch.column(2), batch.column(3)):
                texts.append(article(read(source.as_py()), paths.as_py()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=schema.names)

    joined = lookup_join(rows, paths, ["host"], "left")
    return joined.select(id_col, url_col, "_html", "paths").mapInArrow(extract, schema)
