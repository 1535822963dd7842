"""Main text of web pages by containers that the pages of a host agree on.

Each page is parsed into elements and text blocks, and its containers are scored by the text they hold outside menus,
notices and the like. Pages vote with the path of their best container, tags and classes with digits generalised; Spark
adds the votes up per host. Then every page is read again with the path that won, or its own best one if it lacks that.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute in the workers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillset.llm.common import in_pieces, text_of
from quillset.session import broadcast_if_small, materialise

#: Elements whose content is no text: of the first kind also when their end tag is missing, of the second only up to it.
RAW = frozenset("script style noscript template textarea iframe title".split())
FOREIGN = frozenset("svg math object canvas select".split())
#: An attribute, by the rules of HTML: an unquoted value may hold quotes; a quote that never closes ends before ``>``.
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|((?!["'])[^\s>]*+)|["']([^>]*+)))?+""")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[\s/]++|{re.sub(r'[(](?=[^?])', '(?:', ATTRIBUTE.pattern)})*+)(?:>|\Z)",
    re.S,
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
#: What an opening tag ends when it is still open, and where to stop looking for it.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
CONTAINER = frozenset("article body div main section td".split())
NOT_TEXT = frozenset("aside button dialog footer form head menu nav".split())
NOT_TEXT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu navigation search".split())
#: Words that mark a class or id as no main text wherever they stand in it.
NOT_TEXT_NAMES = frozenset(
    "ad ads adsense adsbygoogle advert adverts advertisement advertising sponsor sponsored nav navbar navigation menu submenu breadcrumb "
    "breadcrumbs sidebar footer footnav masthead topbar comments commentlist respond disqus cookie cookies consent gdpr popup modal "
    "newsletter subscribe pagination pager toolbar".split()
)
#: Words that articles use too: a name counts if all its words are of these, of those above, or say nothing of the content.
VAGUE_NAMES = frozenset(
    "aside alert banner comment copyright legal login notice notices notification overlay promo promotion recommendations recommended related "
    "replies reply search share sharing signup social subscription widget widgets".split()
)
FILLING_NAMES = frozenset(
    "area article articles bar block body bottom box btn button buttons card col container content footer global group header icon icons inner "
    "item items left link links list main message module news page panel post posts primary right row secondary section site small stories "
    "strip text title top unit wrap wrapper".split()
)
INLINE_NAMES = frozenset("ad ads adsense adsbygoogle advert adverts advertisement advertising sponsor sponsored".split())
HEADER_NAMES = frozenset({"header"})
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
SPACE = re.compile(r"\s+")


class Element:
    """Parent, tag, generalised name, whether it holds no main text, and whether it is in an article."""

    __slots__ = ("in_article", "key", "parent", "skipped", "tag")

    def __init__(self, parent: int, tag: str, key: str, skipped: bool, in_article: bool):
        self.parent, self.tag, self.key, self.skipped, self.in_article = parent, tag, key, skipped, in_article


def attributes(rest: str) -> Iterator[tuple[str, str]]:
    for match in ATTRIBUTE.finditer(rest) if rest and not rest.isspace() else ():
        yield match[1].lower(), match[2] or match[3] or match[4] or match[5] or ""


def hides(name: str, value: str) -> bool:
    if name == "style":
        return "display:none" in "".join(value.lower().split())
    return name == "hidden" or (name == "aria-hidden" and value.lower() == "true")


def boilerplate(value: str) -> bool:
    """Whether one of the names in a class or id says that the element is no main text."""
    for name in value.split():
        words = {w.lower() for w in NAME.findall(name) if len(w) > 1 and not w.isdigit()}
        if words & NOT_TEXT_NAMES or (words & VAGUE_NAMES and words <= VAGUE_NAMES | FILLING_NAMES):
            return True
    return False


def named(tag: str, rest: str, in_article: bool) -> tuple[str, bool]:
    """The element's generalised name, and whether tag, role, class or id say that it is no main text."""
    skipped, classes = tag in NOT_TEXT or (tag == "header" and not in_article), []
    for name, value in attributes(rest) if rest else ():
        if name == "role":
            skipped = skipped or value.lower() in NOT_TEXT_ROLES
        elif name in ("class", "id"):
            if name == "class":
                classes = sorted(re.sub(r"[\d>]+", "0", c.lower()) for c in value.split())
            words = {w.lower() for w in NAME.findall(value)}
            if tag not in ("html", "body", "article", "main"):
                skipped = skipped or boilerplate(value) or (not in_article and bool(words & HEADER_NAMES))
            elif tag == "article":
                skipped = skipped or bool(words & {"comment", "comments", "reply", "related", "ad", "advert", "promo"})
        elif hides(name, value):
            skipped = skipped or tag not in ("html", "body")
    return ".".join([tag, *classes]) if classes else tag, skipped


def mutes(rest: str) -> bool:
    """Whether an inline element is hidden or an advert."""
    for name, value in attributes(rest):
        if hides(name, value) or (name in ("class", "id") and not INLINE_NAMES.isdisjoint(w.lower() for w in NAME.findall(value))):
            return True
    return False


class Page:
    """Elements, the root first, and blocks of text (innermost element, text, characters of it inside links)."""

    def __init__(self, html: str):
        self.elements = [Element(-1, "", "", False, False)]
        self.blocks: list[tuple[int, str, int]] = []
        self._stack = [0]
        self._open: dict[str, list[int]] = {}  # tag -> depths of its open elements
        self._held: list[str] = []
        self._linked = self._links = 0
        self._muted: list[list] = []  # inline elements without text: tag, elements of that tag open in it, depth it began at
        self._read(html)

    def _flush(self) -> None:
        if not self._held:
            return
        text = SPACE.sub(" ", unescape("".join(self._held))).strip()
        if text:
            self.blocks.append((self._stack[-1], text, min(self._linked, len(text))))
        self._held, self._linked = [], 0

    def _cut(self, depth: int) -> None:
        """End the elements from this depth on."""
        self._flush()
        while len(self._stack) > depth:
            self._open[self.elements[self._stack.pop()].tag].pop()
        while self._muted and self._muted[-1][2] > depth:
            self._muted.pop()

    def _nearest(self, tags: Iterable[str]) -> int:
        depth = 0
        for tag in tags:
            depths = self._open.get(tag)
            if depths and depths[-1] > depth:
                depth = depths[-1]
        return depth

    def _close(self, tags: Iterable[str], stops: Iterable[str]) -> None:
        depth = self._nearest(tags)
        if depth and depth > self._nearest(stops):
            self._cut(depth)

    def _text(self, text: str) -> None:
        if not self._muted:
            self._held.append(text)
            if self._links:
                self._linked += len(text)

    def _read(self, html: str) -> None:
        at, unended = 0, set()
        while match := TOKEN.search(html, at):
            start, stop = match.span()
            if start > at:
                self._text(html[at:start])
            at = stop
            end, tag, rest = match.group("end", "tag", "rest")
            if tag is None:
                continue
            tag = tag.lower()
            if end:
                self._end(tag)
            elif tag in RAW or (tag in FOREIGN and not rest.endswith("/") and tag not in unended):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
                if end or tag in RAW:
                    at = end.end() if end else len(html)
                else:
                    unended.add(tag)
            elif tag not in FOREIGN:
                self._start(tag, rest)
        if at < len(html):
            self._text(html[at:])
        self._flush()

    def _end(self, tag: str) -> None:
        if self._muted and self._muted[-1][0] == tag:
            self._muted[-1][1] -= 1
            if not self._muted[-1][1]:
                self._muted.pop()
        if tag == "a":
            self._links = max(0, self._links - 1)
        elif tag in BLOCK:
            depth = self._nearest((tag,))
            if depth:
                self._cut(depth)
            else:
                self._flush()

    def _start(self, tag: str, rest: str) -> None:
        if tag == "br":
            self._text("\n")
            return
        if tag not in BLOCK:
            self._links += tag == "a"
            if self._muted and self._muted[-1][0] == tag:
                self._muted[-1][1] += 1
            elif tag not in VOID and mutes(rest):
                self._muted.append([tag, 1, len(self._stack)])
            return
        self._flush()
        if tag in ENDS:
            self._close(*ENDS[tag])
        elif tag not in ("html", "body", "head"):
            self._close(("p",), ("td", "th", "table", "button"))
        if tag in ("body", "article", "main"):
            self._close(("head",), ())
        if tag in VOID:
            return
        parent = self.elements[self._stack[-1]]
        key, skipped = named(tag, rest, parent.in_article)
        skipped = skipped or parent.skipped or bool(self._muted)
        self._open.setdefault(tag, []).append(len(self._stack))
        self.elements.append(Element(self._stack[-1], tag, key, skipped, parent.in_article or tag in ("article", "main")))
        self._stack.append(len(self.elements) - 1)
        if tag in CONTAINER:
            self._links = 0

    def path_of(self, at: int) -> str:
        keys = []
        while at > 0:
            keys.append(self.elements[at].key)
            at = self.elements[at].parent
        return ">".join(reversed(keys))

    def on_path(self, path: str) -> set[int]:
        """Elements with main text that the path leads to, found from the root down."""
        keys = path.split(">") if path else []
        last, reached = len(keys), {0: 0}
        for i, e in enumerate(self.elements[1:], 1):
            depth = reached.get(e.parent)
            if depth is not None and depth < last and keys[depth] == e.key:
                reached[i] = depth + 1
        return {i for i, depth in reached.items() if depth == last and not self.elements[i].skipped}

    def best_container(self) -> tuple[int, float]:
        """The container of the main text, and its score: characters outside links in it that are not skipped."""
        elements, score = self.elements, [0.0] * len(self.elements)
        for inner, text, linked in self.blocks:
            if not elements[inner].skipped:
                score[inner] += len(text) - linked
        inside: dict[int, list[int]] = {}
        for i in range(len(elements) - 1, 0, -1):  # an element comes after its parent
            score[elements[i].parent] += score[i]
        total = score[0]
        for tag in ("article", "main"):
            marked = [i for i, e in enumerate(elements) if e.tag == tag and not e.skipped]
            if marked and 2 * sum(score[i] for i in marked) >= total:
                best = max(marked, key=lambda i: (score[i], -i))
                return best, score[best]
        for i, e in enumerate(elements):
            if not e.skipped and (e.tag in CONTAINER or e.tag == "html") and score[i] >= 0.9 * total > 0:
                inside.setdefault(e.parent, []).append(i)
        best = 0
        while best in inside:
            best = max(inside[best], key=lambda i: (score[i], -i))
        return best, score[best]

    def text(self, chosen: set[int]) -> str:
        inside = [False] * len(self.elements)
        for i, e in enumerate(self.elements):
            inside[i] = i in chosen or (e.parent >= 0 and inside[e.parent])
        return "\n\n".join(text for inner, text, _ in self.blocks if inside[inner] and not self.elements[inner].skipped)


def main_text(html: str, path: str | None = None) -> str:
    """Blocks of the containers on ``path``, or of the page's best one, joined by an empty line."""
    page = Page(html)
    if not page.blocks:
        return ""
    return page.text((page.on_path(path) if path is not None else set()) or {page.best_container()[0]})


def host(url: str = "url") -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The winning path of each host: the one most pages voted for, then the one of the higher score, then the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "html"):
            hosts, paths, scores = [], [], []
            for name, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                read = Page(page)
                at, score = read.best_container()
                if read.blocks and score > 0:
                    hosts.append(name)
                    paths.append(read.path_of(at))
                    scores.append(score)
            yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.string()), "path": pa.array(paths, pa.string()), "score": pa.array(scores, pa.float64())})

    votes = pages.select(host(url).alias("host"), text_of(html).alias("html")).mapInArrow(run, "host string, path string, score double")
    votes = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("score").alias("score"))
    return votes.groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), -F.col("score"), "path")).alias("path"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: key, url, text, n_chars. Null and empty pages, and pages without main text, give the empty text; pages
    without a host vote together. An empty table gives an empty one; pages are read in time linear in their length, however
    deep they nest. Other columns are not read; repeated rows give repeated results."""
    paths = materialise(host_paths(pages, url, html), "host-paths")
    rows = pages.select(F.col(key).alias(key), F.col(url).alias("url"), text_of(html).alias("html"), host(url).alias("host"))
    rows = rows.join(broadcast_if_small(paths), "host", "left")
    kinds = f"`{key}` {pages.schema[key].dataType.simpleString()}, url {pages.schema[url].dataType.simpleString()}, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "html"):
            texts = [main_text(page, path) for page, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=[key, "url", "text"])

    texts = rows.select(key, "url", "html", "path").mapInArrow(run, kinds)
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
