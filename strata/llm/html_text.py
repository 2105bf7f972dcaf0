"""Main text of web pages by site style trees.

1. Every page is parsed into elements. An element's path is the chain of its
   ancestors' tags, classes and ids (numbers dropped).
2. The DOMs of one host are merged by path: a node of the site's tree counts
   how it is presented (the sequence of its child elements) and what it
   contains (its text). Pages of one text count once, and so does a value that
   a page repeats: c is the number of distinct pages with a value, n that of
   distinct pages with the path. A value's importance is 1 - log c / log n: 0
   where all pages have it, 1 where one page has it. A path's importance is the
   mean over its presentations and contents, which is the mean of the two
   entropies. A path on a single page has importance 1.
3. Elements whose markup states their purpose (menus, headers, footers,
   sidebars, notices, adverts, forms, scripts, styles, comments) are branches
   of importance 0. A class or id states one if all of its words are of that
   kind or say where the branch stands ("site-header", "cookie-banner"); one
   that merely holds such a word ("has-sidebar", "share-price") states nothing.
   An article or main element that is not inside another one ends what class
   and id of its ancestors state, and its text is preferred to all other.
4. Paths below ``LEAST`` on ``LEAST_PAGES`` distinct pages or more are searched:
   an element there goes if the mean of its path's presentation and of its own
   content is below ``LEAST`` too, so what only one page has always stays. In
   an article or main element the bound is ``LEAST_MAIN``, unless a name hints
   at noise: there a text has to be on nearly all pages. html and body never
   go, and an article or page that would lose all its text keeps it.
5. What is left is read block by block.

The merged tree is counted by aggregation, so a host that owns a third of all
pages is spread by (path, page, value) like any other. The elements to
remove are broadcast if they are at most ``MOST_NODES``; more of them are
joined to the pages by host.

Defined cases: null and empty html gives an empty string; null urls share one
host; text outside any element counts as the body's; broken markup is read as
far as it goes; repeated rows give repeated rows and count once; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.common import map_arrow, read, saved
from strata.llm.url_filter import split_url

LEAST, LEAST_MAIN, LEAST_PAGES, MOST_NODES = 0.3, 0.05, 3, 200_000

# Markup names: fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas audio video select".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td "
                  "tfoot th thead tr ul".split())
NOISE = frozenset("head nav header footer aside form button menu dialog option label".split()) | RAW
MAIN = frozenset("article main".split())
NOISE_WORDS = frozenset("ad ads advert adverts advertisement advertisements sponsor sponsored promo promotion banner nav navbar "
                        "navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget cookie cookies consent "
                        "notice notices alert popup modal overlay newsletter subscribe signup login search share sharing social "
                        "related recommended comment comments reply replies disqus pagination pager toolbar".split())
#: words beside those that only place a branch or say what kind of box it is
PLACE_WORDS = frozenset("site page main global top bottom left right primary secondary box block bar list item items container wrapper wrap "
                        "section area inner outer link links button buttons icon icons".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
MAIN_ROLES = frozenset("main article".split())
#: opening one of these closes an open one of those
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",)}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")


class Element:
    __slots__ = ("tag", "path", "stated", "named", "noise", "main", "kept", "parent", "cut", "children", "texts")

    def __init__(self, tag: str, path: int, stated: bool, named: bool, main: bool, kept: bool, parent: Element | None = None):
        self.tag, self.path, self.main, self.kept, self.parent, self.cut = tag, path, main, kept, parent, False
        self.stated, self.named, self.noise = stated, named, stated or named  # by tag and role, by class and id
        self.children: list[str] = []
        self.texts: list[str] = []


def _named(names: list[str]) -> bool:
    """Whether one of the names is a whole role of noise."""
    return any(not NOISE_WORDS.isdisjoint(w) and all(x in NOISE_WORDS or x in PLACE_WORDS for x in w) for w in map(_WORD.findall, names))


def _element(tag: str, attrs: str, parent: Element) -> Element:
    own = {}
    for name, *values in _ATTR.findall(attrs):  # the first of a name holds
        own.setdefault(name.lower(), next((v for v in values if v), "").lower())
    names, roles = own.get("class", "").split() + own.get("id", "").split(), own.get("role", "").split()
    words = [w for name in names for w in _WORD.findall(name)]
    main = tag in MAIN or not MAIN_ROLES.isdisjoint(roles)
    stated = tag in NOISE or not NOISE_ROLES.isdisjoint(roles)
    named = tag != "main" and _named(names)
    if tag in ("html", "body"):  # such words on the page itself say nothing about a branch
        stated = named = False
    stated, named = stated or parent.stated, named or (parent.named and not (main and not parent.main))
    main = parent.main or (main and not stated and not named)
    kept = main and (parent.kept or not parent.main) and NOISE_WORDS.isdisjoint(words)  # in an article, and no name hints at noise
    path = xxhash.xxh64_intdigest(f"{tag}.{'.'.join(words)}{'!' if kept else ''}", seed=parent.path & 0xFFFFFFFF) >> 1
    return Element(tag, path, stated, named, main, kept, parent)


def parse(page: str) -> Iterator[tuple[str, object]]:
    """Events in page order: ("open", element), ("text", (stack, text)),
    ("break", None) at block edges, ("close", element)."""
    root = Element("", 0, False, False, False, False)
    stack = [root]
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            yield "text", (stack, page[at:])
            break
        if m.start() > at:
            yield "text", (stack, page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if any(e.tag == tag for e in stack[1:]):
                while True:
                    e = stack.pop()
                    yield "close", e
                    if e.tag == tag:
                        break
            if tag in BLOCK:
                yield "break", None
            continue
        if tag in BLOCK:
            yield "break", None
            if stack[-1].tag == "p" and tag != "br":
                yield "close", stack.pop()
            for e in CLOSES.get(tag, ()):
                if stack[-1].tag == e:
                    yield "close", stack.pop()
        stack[-1].children.append(tag)
        if tag in RAW:  # its content is no text of the page
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else (n if tag in ("script", "style") else at)
            continue
        if tag in VOID:
            continue
        e = _element(tag, m[3], stack[-1])
        stack.append(e)
        yield "open", e
    while len(stack) > 1:
        yield "close", stack.pop()


def branches(page: str) -> tuple[list[tuple[Element | None, str]], list[Element]]:
    """The texts that are not noise by markup, each with its element (None at
    block edges), and the elements that hold them."""
    texts, held = [], []
    for kind, x in parse(page):
        if kind == "break":
            texts.append((None, ""))
        elif kind == "text":
            stack, text = x
            if not stack[-1].noise:
                texts.append((stack[-1], text))
                if not text.isspace():
                    for e in stack[1:]:
                        e.texts.append(text)
        elif kind == "close" and x.texts and not x.noise:
            held.append(x)
    return texts, held


def _content(e: Element) -> int:
    """An element's path and text."""
    return xxhash.xxh64_intdigest(" ".join("".join(e.texts).split()), seed=e.path & 0xFFFFFFFF) >> 1


def _blocks(texts, main: bool, whole: bool) -> str:
    """Blocks in or outside the article or main element; without those in
    elements that are cut, if not ``whole``."""
    parts: list[list[str]] = [[]]
    for e, text in texts:
        if e is None:
            parts.append([])
        elif e.main == main and (whole or not _cut(e)):
            parts[-1].append(text)
    blocks = (" ".join(htmllib.unescape("".join(p)).split()) for p in parts if p)
    return " ".join(b for b in blocks if b)


def _cut(e: Element | None) -> bool:
    while e is not None and not e.cut:
        e = e.parent
    return e is not None


LOOK, CONTENT, PAGE = range(3)


def site_nodes(page: str) -> tuple[int, set[tuple[int, int, int]]]:
    """The page's text as a hash, and (path, kind, value) of its elements that
    hold text and are not noise by their markup."""
    texts, held = branches(page)
    out = set()
    for e in held:
        out |= {(e.path, LOOK, xxhash.xxh64_intdigest(" ".join(e.children)) >> 1), (e.path, CONTENT, _content(e)), (e.path, PAGE, int(e.kept))}
    return xxhash.xxh64_intdigest(_blocks(texts, True, True) or _blocks(texts, False, True)) >> 1, out


def main_text(page: str, removed=frozenset()) -> str:
    """Blocks of the article or main element, or without one of the page, in no
    element that is in ``removed`` (paths with texts); all if none is left."""
    texts, held = branches(page)
    for e in held if removed else ():
        e.cut = e.tag not in ("html", "body") and _content(e) in removed
    return next(filter(None, (_blocks(texts, main, whole) for main in (True, False) for whole in (False, True))), "")


def site_values(pages: DataFrame) -> DataFrame:
    """host, path, kind, value, c: distinct pages with each value of the merged
    trees; ``pages``: host, html."""

    def scan(batch: pa.RecordBatch):
        for a in range(0, batch.num_rows, 256):
            out = {c: [] for c in ("host", "page", "path", "kind", "value")}
            hosts, pages_ = (batch.column(i).slice(a, 256).to_pylist() for i in (0, 1))
            for h, page in zip(hosts, pages_):
                key, nodes = site_nodes(page or "")
                for path, kind, value in nodes:
                    out["path"].append(path)
                    out["kind"].append(kind)
                    out["value"].append(value)
                out["host"] += [h] * len(nodes)
                out["page"] += [key] * len(nodes)
            yield out

    nodes = map_arrow(pages.select("host", "html"), "host string, page bigint, path bigint, kind int, value bigint", scan)
    return nodes.distinct().groupBy("host", "path", "kind", "value").agg(F.count("*").alias("c"))


def site_tree(values: DataFrame) -> DataFrame:
    """host, path, kept (in an article), n (distinct pages), look (importance of
    the presentation), importance of the merged trees; ``values``: as
    ``site_values``."""
    of = lambda kind, x: F.sum(F.when(F.col("kind") == kind, x))
    mean = lambda kind: F.when(F.col("n") > 1, 1 - F.col(f"clogc{kind}") / (F.col(f"c{kind}") * F.log("n"))).otherwise(F.lit(1.0))
    sums = [of(kind, x).alias(f"{name}{kind}") for kind in (LOOK, CONTENT) for name, x in (("c", F.col("c")), ("clogc", F.col("c") * F.log("c")))]
    paths = values.groupBy("host", "path").agg(of(PAGE, F.col("c")).alias("n"), of(PAGE, F.col("value")).alias("kept"), *sums)
    return paths.select("host", "path", (F.col("kept") > 0).alias("kept"), "n", mean(LOOK).alias("look"), ((mean(LOOK) + mean(CONTENT)) / 2).alias("importance"))


def low_elements(values: DataFrame, least: float) -> DataFrame:
    """host, node: the paths with texts to remove."""
    bound = F.when(F.col("kept"), F.lit(min(least, LEAST_MAIN))).otherwise(F.lit(least))
    low = (site_tree(values).where((F.col("importance") < bound) & (F.col("n") >= LEAST_PAGES))
           .select(F.col("host").alias("site"), F.col("path").alias("branch"), "n", "look", bound.alias("bound")))
    own = (F.col("look") + 1 - F.log("c") / F.log("n")) / 2
    return (values.where((F.col("kind") == CONTENT) & (F.col("c") > 1))
            .join(low, F.col("host").eqNullSafe(F.col("site")) & (F.col("path") == F.col("branch")))
            .where(own < F.col("bound")).select("host", F.col("value").alias("node")))


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", least: float = LEAST,
            most_nodes: int = MOST_NODES) -> DataFrame:
    """page_id, url, text of each row of ``pages``."""
    host, _ = split_url(F.col(url))
    kind = pages.schema[page_id].dataType.simpleString()
    own = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host.alias("host"))
    low = saved(low_elements(saved(site_values(own), "site_values"), least), "site_nodes")
    schema = f"page_id {kind}, url string, text string"
    if low.count() <= most_nodes:
        removed: dict[str, set[int]] = {}
        for h, p in low.toLocalIterator():
            removed.setdefault(h, set()).add(p)
        sent = pages.sparkSession.sparkContext.broadcast(removed)
        return map_arrow(own, schema, _texts(lambda batch: [sent.value.get(h, frozenset()) for h in batch.column(3).to_pylist()]))
    by_host = low.groupBy(F.col("host").alias("site")).agg(F.collect_set("node").alias("nodes"))
    return map_arrow(own.join(by_host, F.col("host").eqNullSafe(F.col("site")), "left").select("page_id", "url", "html", "nodes"),
                     schema, _texts(lambda batch: [frozenset(p or ()) for p in batch.column(3).to_pylist()]))


def _texts(removed_of):
    def scan(batch: pa.RecordBatch):
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            yield {"page_id": part.column(0), "url": part.column(1),
                   "text": [main_text(p or "", r) for p, r in zip(part.column(2).to_pylist(), removed_of(part))]}

    return scan


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's rows over whole ``pages``."""
    out = extract(read(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
