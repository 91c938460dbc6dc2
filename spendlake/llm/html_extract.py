"""Main text of web pages by a site style tree.

All pages of a host are merged into one tree. A node is an element's path: tag, classes and id of it and of the elements
around it, digits levelled; elements more than ``DEPTH`` containers deep belong to the node of that depth. Nodes that can be
cut are containers (``CONTAINERS``), never a paragraph, a cell or a word within one.

A node's importance, from 0 to 1, has two parts:

* Content: each distinct text between two tags in the branch, link texts on their own, weighs the inverse of its perplexity
  over the host's distinct pages, exp(-H): 1 for a text of one page, 1/k for one that is equally on k pages. The node has the
  mean of all distinct texts of its branch, so it gets the importance of the nodes below by their numbers of texts. Copies of
  one story, however many, are few among the distinct texts of a site's stories and do not pull them down.
* Presentation: the entropy of the sequences of child elements, as a share of its maximum. It scales the content from
  ``SAME_LOOK`` (the same on all pages) to 1 (another on each).

Markup is the prior: elements, classes and ids that name a menu, an advert, … make a node *named*. A class or id counts if it
is a noise name as a whole, never on ``html``, ``body``, ``main`` and ``article``. Branches below ``LEAST_IMPORTANCE`` (in an
``article``: ``LEAST_IN_STORY``; named: ``LEAST_NAMED``) are cut from each page. On fewer than ``MIN_PAGES`` distinct pages
the prior decides alone: a few pages say nothing on what repeats. So it does on what never repeats, yet is no part of the
story (readers' comments, dialogs, hidden elements, controls), and on words and paragraphs. ``prior=False`` leaves everything but scripts,
styles and the head to the tree.

A ``header`` within ``main`` or ``article`` is the story's. A ``form`` is cut unless it holds at least half of the page's text and
``STORY_WORDS`` words: then it stands around the story. Of what remains everything is text, unless ``main`` holds at least half of
it: then all that stands in ``main``. An ``article`` is no bound: it can be a teaser beside the story, or a part of it. A page
of which the tree would leave nothing keeps what the prior left.

Counts are summed per host, node and hash before the entropies, so a host with a third of all pages is no hot group.

Null or empty html: an empty text. Null urls and such without ``://`` share the host "". Unclosed and stray tags are
taken as a browser would, roughly. Repeated pages are each returned, and count once in the tree. Nested elements of any
depth take time in proportion to the page. Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.url_filter import host_and_path
from spendlake.sources.scratch import written

MIN_PAGES = 8
LEAST_IMPORTANCE = 0.35
LEAST_IN_STORY = 0.1
LEAST_NAMED = 0.98
SAME_LOOK = 0.7
STORY_WORDS = 50
DEPTH = 64
MOST_BROADCAST = 8 << 20  # bytes of nodes
SALTS = 64

# Elements and names that are noise wherever they stand.
NOISE_TAGS = frozenset(
    """head title nav header footer aside script style noscript template iframe svg button select textarea
    object embed canvas audio video dialog menu""".split()
)
NOISE_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu breadcrumb
    breadcrumbs sidebar footer header masthead cookie cookies consent gdpr newsletter subscribe subscription signup login
    popup modal share sharing related recommended comment comments reply replies disqus toolbar pagination pager
    topnav subnav adbox""".split()
)
# What may stand beside a noise name in a compound one (cookie-notice, main-nav). By themselves these names tell nothing: a
# notice or an alert can be the story, so the style tree decides on it.
QUALIFIERS = frozenset(
    """notice notices notification alert overlay social skip site main top bottom upper lower global primary secondary user
    reader mobile desktop box bar list lists item items link links button buttons icon icons wrapper wrap container block
    widget area slot unit form group posts articles stories thread x left
    right body text policy""".split()
)
NOISE_COMPOUNDS = frozenset(
    tuple(w.split("-"))
    for w in "side-bar social-links social-icons social-buttons social-media social-bar skip-link skip-links site-notice".split()
)
# Elements that hold the page or its story, whatever their class or id says on its layout.
WHOLE_TAGS = frozenset("html body main article".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu".split())
# What the prior alone decides on.
SURE_TAGS = NOISE_TAGS - set("nav header footer aside menu".split())
SURE_NAMES = frozenset("comment comments reply replies disqus cookie cookies consent gdpr login signup popup modal".split())
# What is never text, with or without the prior.
UNSEEN_TAGS = frozenset("head title script style noscript template iframe svg textarea object embed canvas audio video".split())
# What the tree may cut.
CONTAINERS = frozenset(
    "div section nav header footer aside ul ol dl dir menu form fieldset address details table center figure dialog".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr
    ul""".split()
)
# What a start tag closes, up to the elements that end the search.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <(?P<raw>script|style|textarea|title|noscript|iframe|template)\b(?:[^>"']++|"[^"]*"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)
      | <(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:[^>"']++|"[^"]*"|'[^']*')*+)>
      | </?[a-z!?][^>]*(?:>|\Z)
      | <[!?][^>]*(?:>|\Z)""",
    re.DOTALL | re.IGNORECASE | re.VERBOSE,
)
# One attribute: its name and its value, which is consumed whole, whatever stands in it.
ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
NAME_PART = re.compile(r"[^\W\d_]+")
DIGITS = re.compile(r"\d+")


IN_STORY, IS_NAMED = 1, 2  # kinds of nodes; 0: any other


class Element:
    __slots__ = ("tag", "path", "noise", "named", "in_main", "in_story", "form", "nodes")

    def __init__(
        self, tag: str, path: int, noise: bool, named: bool, in_main: bool, in_story: bool, form: int, nodes: tuple
    ) -> None:
        self.tag, self.path, self.noise, self.named, self.in_main, self.in_story = tag, path, noise, named, in_main, in_story
        self.form = form  # the number of the outermost form around it, 0 without one
        self.nodes = nodes  # it and the containers around it, as far as they are nodes: (path, kind)


@lru_cache(1 << 16)
def _below(path: int, label: str) -> int:
    """The path of an element with that label below a path."""
    digest = blake2b(label.encode("utf-8", "surrogatepass"), digest_size=8, key=path.to_bytes(8, "little", signed=True))
    return int.from_bytes(digest.digest(), "little", signed=True)


def is_noise_name(name: str) -> bool:
    """Whether a class or id, in lower case, is a noise name or one with qualifiers only."""
    parts = NAME_PART.findall(name)
    if NOISE_NAMES.isdisjoint(parts):
        return tuple(parts) in NOISE_COMPOUNDS
    return all(p in NOISE_NAMES or p in QUALIFIERS for p in parts)


PLAIN, NAMED, SURE = 0, 1, 2


@lru_cache(1 << 14)
def _label(tag: str, attributes: str) -> tuple[str, int]:
    """What names the element in the tree, and what the prior says of it."""
    says = SURE if tag in SURE_TAGS else NAMED if tag in NOISE_TAGS else PLAIN
    if not attributes:
        return tag, says
    label = tag
    for m in ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if kind == "hidden" or (kind == "role" and value in NOISE_ROLES):
            says = SURE
        elif kind in ("class", "id"):
            names = value.split()
            label += "|" + " ".join(sorted(DIGITS.sub("0", n) for n in names))
            if tag not in WHOLE_TAGS:
                for name in filter(is_noise_name, names):
                    says = max(says, NAMED if SURE_NAMES.isdisjoint(NAME_PART.findall(name)) else SURE)
    return label, says if says == SURE or tag in CONTAINERS else SURE if says else PLAIN


class Page:
    """The blocks of a page that are not noise, and what its nodes show, in page order. Named nodes are noise and others are
    not, but for those ``turned``. With ``whole`` named ones are looked at, but are no blocks."""

    def __init__(self, source: str, turned: frozenset[int] = frozenset(), prior: bool = True, whole: bool = False) -> None:
        self.turned, self.prior, self.whole = turned, prior, whole
        self.blocks: list[tuple[bool, int, str]] = []  # (whether it stands in main, its form, text)
        self.looks: dict[tuple[int, int], list[str]] = {}  # of each node with text the labels of child elements
        self.texts: dict[tuple[int, int], set[str]] = {}  # and the texts of its branch
        self._parts: list[str] = []
        self._in_main, self._form, self._forms = False, 0, 0
        self._places: dict[str, list[int]] = defaultdict(list)  # of the open elements of each tag
        self._blocks: list[int] = []  # of open block elements
        self._stack = [Element("", 0, False, False, False, False, 0, ())]
        at = 0
        for m in TOKEN.finditer(source):
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            if m["tag"]:
                self._tag(m["tag"].lower(), m["attributes"], bool(m["end"]))
        if at < len(source):
            self._text(source[at:])
        self._flush()

    def _text(self, raw: str) -> None:
        top = self._stack[-1]
        if top.noise:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if not top.named:
            self._parts.append(text)
            self._in_main = self._in_main or top.in_main
            self._form = top.form
        if top.nodes and not text.isspace():
            text = " ".join(text.split())
            for node in top.nodes:
                self.texts.setdefault(node, set()).add(text)

    def _flush(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            self.blocks.append((self._in_main, self._form, text))
        self._parts, self._in_main, self._form = [], False, 0

    def _pop_to(self, at: int) -> None:
        gone = self._stack[at:]
        if any(e.tag in BLOCK_TAGS for e in gone):
            self._flush()
        for e in gone:
            self._places[e.tag].pop()
        while self._blocks and self._blocks[-1] >= at:
            self._blocks.pop()
        del self._stack[at:]

    def _last(self, tags: Iterable[str]) -> int:
        """Where the innermost open element of some tags stands; -1 if there is none."""
        return max((self._places[t][-1] for t in tags if self._places[t]), default=-1)

    def _close(self, tags: Iterable[str], stops: Iterable[str]) -> None:
        while (at := self._last(tags)) > self._last(stops):
            self._pop_to(at)

    def _tag(self, tag: str, attributes: str, is_end: bool) -> None:
        if is_end:
            if tag == "br":
                self._parts.append(" ")
            at = self._last((tag,))
            if at > 0 and (tag in BLOCK_TAGS or not self._blocks or self._blocks[-1] < at):
                self._pop_to(at)
            return
        if tag in BLOCK_TAGS:
            while self._blocks and self._stack[self._blocks[-1]].tag == "p":
                self._pop_to(self._blocks[-1])
            self._flush()
        elif tag in ("br", "td", "th", "img"):
            self._parts.append(" ")
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag in VOID_TAGS:
            return
        if not attributes.endswith("/") or tag in BLOCK_TAGS:
            self._enter(tag, attributes)
        elif not self._stack[-1].noise and self._stack[-1].nodes:
            self.looks.setdefault(self._stack[-1].nodes[-1], []).append(tag)

    def _enter(self, tag: str, attributes: str) -> None:
        above = self._stack[-1]
        label, says = _label(tag, attributes)
        if tag == "header" and says == NAMED and (above.in_main or above.in_story):
            says = _label("div", attributes)[1]
        if not self.prior:
            says = SURE if tag in UNSEEN_TAGS else PLAIN
        path, nodes, form, named = above.path, above.nodes, above.form, above.named
        noise = above.noise or says == SURE
        if not noise:
            if nodes:
                self.looks.setdefault(nodes[-1], []).append(label)
            turned = False
            if len(nodes) < DEPTH:
                path = _below(path, label)
                if tag in CONTAINERS:
                    nodes = (*nodes, (path, IS_NAMED if says == NAMED else IN_STORY if above.in_story else 0))
                    turned = path in self.turned
            if self.whole:
                named = named or says == NAMED
            else:
                noise = (says == NAMED) != turned
            if tag == "form" and not form and self.prior:
                self._forms += 1
                form = self._forms
        in_main, in_story = above.in_main or tag == "main", above.in_story or tag == "article"
        self._stack.append(Element(tag, path, noise, named, in_main, in_story, form, nodes))
        self._places[tag].append(len(self._stack) - 1)
        if tag in BLOCK_TAGS:
            self._blocks.append(len(self._stack) - 1)

    def kept(self) -> list[tuple[bool, str]]:
        """The blocks without those of forms, unless these stand around the story: (whether in main, text)."""
        every, sizes, words = 0, Counter(), Counter()
        for _, form, text in self.blocks:
            every += len(text)
            sizes[form] += len(text)
            words[form] += text.count(" ") + 1
        story = {f for f in sizes if not f or (2 * sizes[f] >= every and words[f] >= STORY_WORDS)}
        return [(in_main, text) for in_main, form, text in self.blocks if form in story]

    def text(self) -> str:
        kept = self.kept()
        every, main = [text for _, text in kept], [text for in_main, text in kept if in_main]
        return "\n\n".join(main if 2 * sum(map(len, main)) >= sum(map(len, every)) else every)


def main_text(source: str, turned: frozenset[int] = frozenset(), prior: bool = True) -> str:
    return Page(source, turned, prior).text() or (Page(source, prior=prior).text() if turned else "")


def _hash(parts: list[str]) -> int:
    digest = blake2b("\x00".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


NODES = "host string, page long, path long, kind byte, is_text boolean, value long"


def style_nodes(batches: Iterator[pa.RecordBatch], prior: bool = True) -> Iterator[pa.RecordBatch]:
    """Of (host, html): for each page and node with text the hash of its presentation and those of its distinct texts."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int8(), pa.bool_(), pa.int64()]
    for batch in batches:
        rows: list[tuple] = []
        for host, source in zip(*(c.to_pylist() for c in batch.columns)):
            page = Page(source, prior=prior, whole=True)
            if page.texts:
                whole = _hash([text for *_, text in page.blocks])
                hashes = {t: _hash([t]) for texts in page.texts.values() for t in texts}
                for node, texts in page.texts.items():
                    rows.append((host, whole, *node, False, _hash(page.looks.get(node, []))))
                    rows.extend((host, whole, *node, True, hashes[t]) for t in texts)
        columns = zip(*rows) if rows else [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "page", "path", "kind", "is_text", "value"]
        )


def importance(pages: DataFrame, prior: bool = True) -> DataFrame:
    """host, path, kind, pages and importance (0 to 1) of every node of the site style trees of (host, html)."""
    nodes = pages.mapInArrow(lambda batches: style_nodes(batches, prior), NODES).distinct()
    node = ["host", "path", "kind"]
    counts = nodes.groupBy(*node, "is_text", "value").agg(F.count("*").alias("n"))
    sums = counts.groupBy(*node).agg(
        F.sum(F.expr("if(is_text, 0, n)")).alias("pages"),
        F.sum(F.expr("if(is_text, 0, n * ln(n))")).alias("s"),
        F.avg(F.expr("if(is_text, 1 / n, null)")).alias("content"),
    )
    look = F.when(F.col("pages") > 1, (F.log("pages") - F.col("s") / F.col("pages")) / F.log("pages")).otherwise(1.0)
    found = F.col("content") * (F.lit(SAME_LOOK) + F.lit(1 - SAME_LOOK) * look)
    return sums.select(*node, "pages", found.alias("importance"))


def turned_paths(pages: DataFrame, min_pages: int = MIN_PAGES, least: float = LEAST_IMPORTANCE, prior: bool = True) -> DataFrame:
    """(host, turned): the nodes of each host, if it has any, on which the tree does not decide as the prior."""
    bound = F.when(F.col("kind") == IN_STORY, F.least(F.lit(LEAST_IN_STORY), F.lit(least))).otherwise(least)
    other = F.when(F.col("kind") == IS_NAMED, F.col("importance") >= LEAST_NAMED).otherwise(F.col("importance") < bound)
    found = importance(pages, prior).where((F.col("pages") >= min_pages) & other)
    return found.groupBy("host").agg(F.collect_set("path").alias("turned"))


def with_turned(rows: DataFrame, turned: DataFrame) -> DataFrame:
    """``rows`` with their host's ``turned`` nodes. It is broadcast if it is small, counted; else each host's rows are dealt
    over ``SALTS`` tasks, with a copy of the host's nodes for each."""
    turned = written(turned, "turned")
    size = turned.agg(F.sum(8 * F.size("turned") + F.length("host")).alias("n")).first()["n"] or 0
    if size <= MOST_BROADCAST:
        return rows.join(F.broadcast(turned), "host", "left")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)).cast("int"))
    return salted.join(turned.select("*", salts), ["host", "salt"], "left").drop("salt")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, least: float = LEAST_IMPORTANCE, prior: bool = True) -> DataFrame:
    """page_id, url, text and n_chars of every row of (page_id, url, html)."""
    source = F.coalesce(F.col("html"), F.lit("")).alias("html")
    rows = pages.select("page_id", "url", host_and_path(F.col("url"))[0].alias("host"), source)
    turned = turned_paths(rows.select("host", "html"), min_pages, least, prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = batch.column("turned").to_pylist()
            texts = [main_text(s, frozenset(c or ()), prior) for s, c in zip(batch.column("html").to_pylist(), turns)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    schema = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    joined = with_turned(rows, turned).select("page_id", "url", "html", "turned")
    return joined.mapInArrow(run, f"{schema}, text string, n_chars long")
