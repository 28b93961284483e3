"""The main text of web pages, by what a site's pages have in common.

The documents of one host are merged into a style tree. An element node is a path of tags with
their classes; its style nodes are the sequences of child elements it occurs with (a child that
repeats counts once, so that pages with more or fewer paragraphs share their nodes). A node whose
pages differ in presentation or in content matters, one that looks alike on all is furniture:

    presentation = entropy of its style nodes, to the base of its pages
    content      = 1 - mean over its different texts of log(pages of the text) / log(its pages)
    importance   = (1 - decay ** styles) * presentation + decay ** styles * content

A host with few pages says little, so each node's importance is drawn towards that of the same
node in the tree of all hosts, and this towards ``PRIOR``, by ``WEIGHT`` pages each. Branches
below ``threshold`` are removed from each page. Entropy cannot see that a reader's comment or a
form is no article, as these differ from page to page; so what a page declares counts besides
(``declared``): elements named as navigation, header, footer, aside, form, advert, notice or
comments go, and what stands in ``article`` or ``main`` stays.

Texts are decoded, white space in a block becomes one space, and blocks are joined by an empty
line. Results for odd input: a null or empty html, or one without text, gives an empty text. A
page without a url or host belongs to the host of empty name. Rows are judged one by one,
whatever their ids. Tags that are not closed end where a browser ends them; what is left open
ends with the page. An empty table gives no rows. Columns besides ``page_id``, ``url`` and
``html`` pass unread, whatever their names.
"""

from __future__ import annotations

import functools
import html as references
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.text import pieces
from tabloom.workspace import stage

PRIOR, WEIGHT, DECAY, THRESHOLD = 0.7, 50.0, 0.9, 0.6
#: Elements below this depth belong to the node above them at this depth.
DEPTH = 64

# Names of HTML elements.
RAW = set("script style title textarea xmp iframe noembed noframes".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "html head body address article aside blockquote caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol "
    "p pre search section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCKS - set("html head body caption dd dt li tbody td tfoot th thead tr".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A start tag ends the nearest of these, unless one of the others stands between.
ENDED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "td", "th"}),
    "dd": ({"dd", "dt"}, {"dl", "td", "th"}),
    "dt": ({"dd", "dt"}, {"dl", "td", "th"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
P_SCOPE = {"td", "th", "caption", "table", "button"}

# Elements and words of classes and ids that name what is no article.
FURNITURE = set(
    "head nav footer aside header form dialog menu search noscript template select button label "
    "fieldset datalist svg math canvas object audio video".split()
)
NAMED = set(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner banners "
    "promo promos promotion promotions sponsor sponsors sponsored affiliate "
    "nav navbar navigation menu menus menubar breadcrumb breadcrumbs pager pagination paging "
    "topbar toolbar skiplink sitemap header masthead footer colophon copyright contentinfo "
    "sidebar sidebars aside rail complementary widget widgets "
    "cookie cookies consent gdpr notice notices notification notifications alert alerts "
    "disclaimer popup modal overlay interstitial newsletter subscribe subscription signup signin "
    "login register search searchbox searchform form share sharing social follow "
    "comment comments commentlist reply replies respond discussion disqus "
    "related recommended recommendations teaser teasers trending".split()
)
#: Such words only say how a page that holds both is laid out, or stand for a title's frame.
LAYOUT = {"no", "has", "with", "without", "layout", "hide", "show"}
FRAMES = {"header", "banner", "masthead"}

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?--!?>|.*\Z)"
    r"|<(?:[!?]|/(?![A-Za-z]))[^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)"
    r"((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"""(?<![^\s"'/])(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_HOST = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]*)")
PLAIN, MAIN, OTHER = 0, 1, 2


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _hash(x: str | bytes) -> int:
    return _signed(xxhash.xxh3_64_intdigest(x))


def host(url: str | None) -> str:
    found = _HOST.match((url or "").strip())
    return found[1].lower() if found else ""


@functools.lru_cache(1 << 16)
def _node(parent: int, signature: str) -> int:
    return _hash(f"{parent} {signature}")


def _names_other(name: str, frames: bool) -> bool:
    """Whether a class, id or role says what is no article."""
    parts = [p for p in re.split(r"[^A-Za-z]+", name) if p]
    if not parts or LAYOUT & {p.lower() for p in parts}:
        return False
    ends = {parts[0].lower(), parts[-1].lower()}
    for part in (parts[0], parts[-1]):
        words = _PART.findall(part)
        ends |= {words[0].lower(), words[-1].lower()}
    return bool(ends & (NAMED if frames else NAMED - FRAMES))


@functools.lru_cache(1 << 14)
def _kind(tag: str, attributes: str, inside: int) -> tuple[str, int]:
    """Signature of an element, and whether it is declared the article, something else, or not."""
    names: dict[str, list[str]] = {}
    for key, value in _NAMES.findall(attributes):
        names.setdefault(key.lower(), references.unescape(value.strip("\"'")).split())
    said = [*names.get("class", ()), *names.get("id", ())]
    signature = re.sub(r"\d{3,}", "0", f"{tag} {' '.join(sorted(said))}").strip()
    roles = [r.lower() for r in names.get("role", ())]
    if tag == "main" or "main" in roles:
        return signature, MAIN
    frames = inside != MAIN
    if tag in FURNITURE and (frames or tag != "header"):
        return signature, OTHER
    if tag not in ("html", "body") and any(_names_other(x, frames) for x in [*said, *roles]):
        return signature, OTHER
    if tag == "article" or "article" in roles or "articleBody" in names.get("itemprop", ()):
        return signature, MAIN
    return signature, PLAIN


@dataclass
class _Open:
    tag: str
    node: int
    above: tuple[int, ...]
    kind: int
    by_form: bool = False
    children: list[int] = field(default_factory=list)


class Page:
    """Blocks of text of one page, and the element and style nodes it has.

    ``blocks`` are (node, kind, text) in order; ``above`` gives each node the nodes it stands in,
    itself included; ``styles`` are (node, style), style 0 for nodes without child elements.
    """

    def __init__(self, text: str) -> None:
        self.blocks: list[tuple[int, int, str]] = []
        self.above: dict[int, tuple[int, ...]] = {}
        self.styles: set[tuple[int, int]] = set()
        self._open = [_Open("", 0, (0,), PLAIN)]
        self._tags: Counter[str] = Counter()
        self._buffer: list[str] = []
        self._read(text)

    def _read(self, text: str) -> None:
        at, size = 0, len(text)
        while at < size:
            found = _TOKEN.search(text, at)
            if found is None:
                self._text(text[at:])
                break
            if found.start() > at:
                self._text(text[at : found.start()])
            at = found.end()
            if found[2] is None:
                continue
            tag = found[2].lower()
            if found[1]:
                self._end(tag)
            elif tag in RAW:
                closed = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(text, at)
                at = closed.end() if closed else size
            else:
                self._start(tag, found[3])
        while len(self._open) > 1:
            self._pop()
        self._flush()

    def _text(self, text: str) -> None:
        if self._open[-1].tag in BLOCKS or len(self._open) == 1 or self._open[-1].kind != OTHER:
            self._buffer.append(references.unescape(text) if "&" in text else text)

    def _flush(self) -> None:
        text = " ".join("".join(self._buffer).split())
        self._buffer.clear()
        if text:
            held = next(o for o in reversed(self._open) if o.tag in BLOCKS or not o.tag)
            self.blocks.append((held.node, held.kind, text))
            self.above.setdefault(held.node, held.above)

    def _pop(self) -> None:
        held = self._open[-1]
        if held.tag in BLOCKS:
            self._flush()
        self._open.pop()
        self._tags[held.tag] -= 1
        if held.tag in BLOCKS:
            style = _hash(array("q", held.children).tobytes()) if held.children else 0
            self.styles.add((held.node, style))

    def _close(self, tags: set[str], unless: set[str]) -> None:
        """End the nearest open element of ``tags`` and what is open in it."""
        if not any(self._tags[t] for t in tags):
            return
        for depth in range(len(self._open) - 1, 0, -1):
            if self._open[depth].tag in tags:
                while len(self._open) > depth:
                    self._pop()
                return
            if self._open[depth].tag in unless:
                return

    def _end(self, tag: str) -> None:
        if tag in HEADINGS:
            self._close(HEADINGS, P_SCOPE)
        elif tag == "p":
            self._close({"p"}, P_SCOPE)
        elif tag == "br":
            self._buffer.append(" ")
        elif self._tags[tag]:
            self._close({tag}, {"td", "th"} - {tag} if tag not in ("table", "tr", "tbody", "thead", "tfoot") else set())

    def _start(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "hr":
                self._close({"p"}, P_SCOPE)
                self._flush()
            elif tag == "br":
                self._buffer.append(" ")
            return
        if tag in ("html", "body") and self._tags[tag]:
            return
        if tag == "body":
            self._close({"head"}, set())
        if tag in ENDS_P:
            self._close({"p"}, P_SCOPE)
        if tag in ENDED:
            self._close(*ENDED[tag])
        if tag in HEADINGS and self._open[-1].tag in HEADINGS:
            self._pop()
        parent = self._open[-1]
        signature, kind = _kind(tag, attributes, parent.kind)
        by_form = tag == "form"
        if parent.kind == OTHER and not (kind == MAIN and (tag == "main" or parent.by_form)):
            kind, by_form = OTHER, parent.by_form
        elif kind == PLAIN:
            kind = parent.kind
        if tag in BLOCKS:
            self._flush()
            deep = len(parent.above) >= DEPTH
            node = parent.node if deep else _node(parent.node, signature)
            above = parent.above if deep else (*parent.above, node)
            if not deep and (not parent.children or parent.children[-1] != node):
                parent.children.append(node)
            self.above.setdefault(node, above)
            self._open.append(_Open(tag, node, above, kind, by_form))
        elif kind == OTHER:  # text of other elements belongs to their block, or goes with them
            self._open.append(_Open(tag, parent.node, parent.above, kind, by_form, parent.children))
        else:
            return
        self._tags[tag] += 1

    def plan(self) -> tuple[int, list[int]]:
        """The nodes of blocks that are not declared, and a key for them."""
        nodes = sorted({node for node, kind, _ in self.blocks if kind == PLAIN})
        return _hash(array("q", nodes).tobytes()) if nodes else 0, nodes


_HEADS = {_node(_node(0, "html"), "head"), _node(0, "head")}


def _page(text: str, declared: bool) -> Page:
    """The page; unless ``declared``, of its elements only the head is known to be no text."""
    page = Page(text)
    if not declared:
        heads = {node for node, path in page.above.items() if not _HEADS.isdisjoint(path)}
        page.blocks = [(n, OTHER if n in heads else PLAIN, t) for n, _, t in page.blocks]
    return page


_NODE, _STYLE, _TEXT = 0, 1, 2
_COUNTED = "site long, node long, kind int, key long, pages long, above array<long>"
_SITES = "site long, plan long, nodes array<long>"


def _told(text: str) -> int:
    return _hash(re.sub(r"\d", "0", text.casefold()))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[str | None, str]]:
    for url, text in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
        yield url, text or ""


def count_nodes(pages: DataFrame, declared: bool = True) -> DataFrame:
    """Per host: pages of each element node, of each of its styles, and of each of its texts.

    Rows of kind 3 hold the undeclared nodes of each sort of page (``above``, by ``key``).
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            counts: Counter[tuple[int, int, int, int]] = Counter()
            above: dict[tuple[int, int], tuple[int, ...] | list[int]] = {}
            for url, text in _rows(batch):
                page, site = _page(text, declared), _hash(host(url))
                for node, path in page.above.items():
                    counts[site, node, _NODE, 0] += 1
                    above[node, _NODE] = path
                counts.update((site, node, _STYLE, style) for node, style in page.styles)
                counts.update({(site, node, _TEXT, _told(text)) for node, _, text in page.blocks})
                key, nodes = page.plan()
                if nodes:
                    counts[site, 0, 3, key] += 1
                    above[key, 3] = nodes
            keys = list(counts)
            paths = [above[k[3] if k[2] == 3 else k[1], k[2]] if k[2] in (_NODE, 3) else None for k in keys]
            columns = [pa.array([k[i] for k in keys], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(list(counts.values()), pa.int64()), pa.array([p and list(p) for p in paths], pa.list_(pa.int64()))],
                names=["site", "node", "kind", "key", "pages", "above"],
            )

    held = pages.select("url", "html").mapInArrow(work, _COUNTED)
    return held.groupBy("site", "node", "kind", "key").agg(
        F.sum("pages").alias("pages"), F.first("above", ignorenulls=True).alias("above")
    )


def _measured(counted: DataFrame, decay: float) -> DataFrame:
    """``pages`` and ``importance`` (null where nothing is known) of each site's nodes."""
    is_style, is_text = F.col("kind") == _STYLE, F.col("kind") == _TEXT
    pages = F.col("pages").cast("double")
    some = lambda condition, value: F.sum(F.when(condition, value).otherwise(0.0))
    branching = is_style & (F.col("key") != 0)
    own = counted.groupBy("site", "node").agg(
        F.sum(F.when(F.col("kind") == _NODE, F.col("pages")).otherwise(0)).alias("pages"),
        F.first("above", ignorenulls=True).alias("above"),
        some(is_style, pages).alias("styled"),
        some(is_style, pages * F.log(pages)).alias("style_logs"),
        some(branching, F.lit(1.0)).alias("styles"),
        some(is_text, F.lit(1.0)).alias("texts"),
        some(is_text, F.log(pages)).alias("text_logs"),
    )
    below = (
        own.filter("texts > 0")
        .select("site", F.explode("above").alias("node"), "texts", "text_logs")
        .groupBy("site", "node")
        .agg(F.sum("texts").alias("all_texts"), F.sum("text_logs").alias("all_logs"))
    )
    base = F.log(F.col("pages").cast("double"))
    clipped = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    presentation = clipped((F.log("styled") - F.col("style_logs") / F.col("styled")) / base)
    content = clipped(1 - F.col("all_logs") / (F.col("all_texts") * base))
    share = F.pow(F.lit(decay), F.col("styles"))
    known = (F.col("pages") > 1) & (F.col("styled") > 0)
    return own.join(below, ["site", "node"]).select(
        "site",
        "node",
        "pages",
        F.when(known, (1 - share) * presentation + share * content).alias("importance"),
    )


def _drawn(own: Column, pages: Column, to: Column) -> Column:
    """``own`` importance from ``pages`` pages, drawn towards ``to``."""
    held = F.coalesce(own, to)
    return (held * pages + to * WEIGHT) / (pages + WEIGHT)


def importance(counted: DataFrame, decay: float = DECAY) -> DataFrame:
    """``importance`` of each ``site`` and ``node``, drawn towards the tree of all sites."""
    plain = counted.filter(F.col("kind") < 3)
    everywhere = plain.groupBy(F.lit(0).cast("long").alias("site"), "node", "kind", "key").agg(
        F.sum("pages").alias("pages"), F.first("above", ignorenulls=True).alias("above")
    )
    general = _measured(everywhere, decay).select(
        "node", _drawn(F.col("importance"), F.col("pages"), F.lit(PRIOR)).alias("general")
    )
    own = _measured(plain, decay).join(general, "node", "left")
    drawn = _drawn(F.col("importance"), F.col("pages"), F.coalesce("general", F.lit(PRIOR)))
    return own.select("site", "node", "pages", drawn.alias("importance"))


def blocks(pages: DataFrame, declared: bool = True) -> DataFrame:
    """Rows of ``page_id`` and ``url`` with their ``site``, ``plan`` and blocks of text."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            sites, plans, made = [], [], []
            for url, text in _rows(batch):
                page = _page(text, declared)
                sites.append(_hash(host(url)))
                plans.append(page.plan()[0])
                made.append([
                    {"node": node, "main": kind == MAIN, "text": text}
                    for node, kind, text in page.blocks
                    if kind != OTHER
                ])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(sites, pa.int64()),
                    pa.array(plans, pa.int64()),
                    pa.array(made, _BLOCKS),
                ],
                names=["page_id", "url", "site", "plan", "blocks"],
            )

    schema = (
        f"page_id {kinds['page_id']}, url {kinds['url']}, site long, plan long, "
        "blocks array<struct<node: long, main: boolean, text: string>>"
    )
    return pages.select("page_id", "url", "html").mapInArrow(work, schema)


_BLOCKS = pa.list_(pa.struct([("node", pa.int64()), ("main", pa.bool_()), ("text", pa.string())]))


def _plans(counted: DataFrame, weighed: DataFrame, threshold: float) -> DataFrame:
    """The nodes that stay, for each site and each sort of its pages."""
    sorts = counted.filter("kind = 3").select(
        "site", F.col("key").alias("plan"), F.explode("above").alias("node")
    )
    kept = weighed.filter(F.col("importance") >= threshold).select("site", "node")
    return sorts.join(kept, ["site", "node"]).groupBy("site", "plan").agg(
        F.collect_list("node").alias("kept")
    )


def extract(
    pages: DataFrame,
    threshold: float = THRESHOLD,
    decay: float = DECAY,
    declared: bool = True,
) -> DataFrame:
    """``page_id``, ``url`` and the main ``text`` of every page.

    Pages are read twice: once to count nodes, once to take their blocks. Between, only counts
    are shuffled. What stays is one row for each host and sort of page, joined as its size allows.
    """
    counted = stage(count_nodes(pages, declared), "site-nodes")
    weighed = stage(importance(counted, decay), "site-importance")
    plans = stage(_plans(counted, weighed, threshold), "site-plans")
    found = blocks(pages, declared).join(plans, ["site", "plan"], "left")
    stays = lambda b: b["main"] | F.coalesce(F.array_contains("kept", b["node"]), F.lit(False))
    texts = F.transform(F.filter("blocks", stays), lambda b: b["text"])
    return found.select("page_id", "url", F.array_join(texts, "\n\n").alias("text"))
