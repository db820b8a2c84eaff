"""HTML extraction (operator 6): a style tree for each site and what it says about page branches.

Pages of one host share templates. Their element paths form the host's style
tree; a path's importance is the entropy of the child sequences seen there
(presentation), or for text the share of content that other pages do not
repeat. Paths whose whole branch is of low importance are noise, and so are texts
that nearly all pages repeat at one path. What markup itself declares (menus,
footers, adverts, forms, comments) is noise on any page. Inside what a page
declares its article, statistics cut only whole containers and repeated
paragraphs, never headings or parts of tables and lists.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.plans.hot import attach
from foldwright.session import stage

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/a-zA-Z][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# fixed by the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: what an opening tag ends, up to the tags that hold it in
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
HOLDS_P = frozenset("article aside body button div td th table section main form blockquote li dd fieldset figure".split())
NOISE_TAGS = frozenset("nav footer aside form script style noscript template iframe button select textarea object svg canvas head dialog menu input label title".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NOISE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|menu|nav|navbar|navigation|footer|header|masthead|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"newsletter|subscribe|subscription|share|sharing|social|related|recommend\w*|comments?|disqus|replies|breadcrumbs?|pagination|pager|widget|login|signup|signin|search|toolbar|skip)(?:$|[\s_-])",
    re.I,
)
#: words that also name parts of an article; there they say nothing unless they name a piece of furniture
OPEN_WORDS = r"header|notice|alert|share|sharing|social|related|recommend\w*|search|widget"
OPEN_NAMES = re.compile(rf"(?:^|(?<=[\s_-]))(?:{OPEN_WORDS})(?=$|[\s_-])", re.I)
FURNITURE = re.compile(
    rf"(?:^|[\s_-])(?:{OPEN_WORDS})[_-](?:bars?|box(?:es)?|buttons?|btns?|links?|icons?|lists?|posts?|articles?|stories|form|input|widgets?)(?:$|[\s_-])|"
    rf"(?:^|[\s_-])(?:post|entry|article|page|site)?[_-]?(?:share|sharing|social)[_-](?:share|sharing)(?:$|[\s_-])",
    re.I,
)
#: what stands beside a furniture word in names that mean nothing else, such as ``ad-slot-2`` or ``comments-list``
FILLER = re.compile(
    r"(?:area|article|bar|block|body|bottom|box|btn|button|card|center|col|column|container|content|count|cta|desktop|fixed|floating|form|frame|global|group|holder|icon|inline|inner|input|"
    r"item|label|left|link|list|main|message|mobile|outer|page|panel|placeholder|post|primary|rail|region|right|row|secondary|section|site|slot|sticky|story|strip|text|thread|title|toggle|"
    r"top|unit|wrap|wrapper|zone)s?|boxes|stories|entries|entry|js|\d+(?:x\d+)?",
    re.I,
)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)")
TAG = re.compile(r"[^.#]*")
#: deeper elements share the path of the one at this depth
DEPTH = 40
#: pages of one host that one task reads with ease
HOT_PAGES = 4_000
#: what statistics may cut inside an article
LOOSE = frozenset("div section p ul ol".split())
#: an undeclared container of so many times the text of any declared article is the article; another declared one of a path
#: of its own and less than the inverse of ASIDE of the text stands beside it
UNDECLARED, ASIDE = 2, 4


class Element:
    __slots__ = ("tag", "path", "noise", "main", "children")

    def __init__(self, tag: str, path: str, noise: bool, main: tuple[int, str] | None):
        self.tag, self.path, self.noise, self.main = tag, path, noise, main
        self.children: list[str] = []


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower() if found else ""


def domain_of(host: str) -> str:
    """The last two labels of a host name."""
    return ".".join(host.split(".")[-2:])


def _declared(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Whether markup says that an element is not article text.

    Headers inside an article belong to it, and so do elements with names such as
    ``related-work`` or ``modal-verbs``: there a name must consist of furniture
    words alone. What other names hold is noise only if the style tree says so.
    """
    if tag in NOISE_TAGS or (tag == "header" and not inside) or attributes.get("role", "").lower() in NOISE_ROLES:
        return True
    if tag in ("html", "body", "main") or (tag == "article" and not inside and not re.search("comment|repl", attributes.get("class", "") + attributes.get("id", ""), re.I)):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or HIDDEN.search(attributes.get("style", "")):
        return True
    names = " ".join(attributes[k] for k in ("class", "id") if attributes.get(k))
    if not inside:
        return bool(names and NOISE_NAMES.search(names))
    return bool(FURNITURE.search(names)) or any(_furniture(name) for name in OPEN_NAMES.sub("", names).split())


def _furniture(name: str) -> bool:
    """Whether all words of a name are those of page furniture, so that ``ad-slot`` is noise and ``menu-design`` is not."""
    words = [w for w in re.split("[_-]+", name) if w]
    noise = [bool(NOISE_NAMES.search(w)) for w in words]
    return any(noise) and all(n or FILLER.fullmatch(w) for n, w in zip(noise, words, strict=True))


def walk(page: str):
    """Blocks ``(path, noise, main, text)`` in page order and elements ``(path, child sequence, noise)``.

    ``main`` is the number and path of the outermost declared article, if any.

    Unclosed and crossing tags are mended the way browsers do for the common
    cases: a block ends an open paragraph, list items and cells end their
    neighbours, an end tag without a start is passed over.
    """
    blocks: list[tuple[str, bool, tuple[int, str] | None, str]] = []
    elements: list[tuple[str, str, bool]] = []
    root, declared = Element("", "", False, None), 0
    stack, pieces = [root], []
    last, end = 0, len(page)

    def flush() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                top = stack[-1]
                blocks.append((top.path, top.noise, top.main, text))

    def pop() -> None:
        e = stack.pop()
        if e.tag in BLOCK:
            elements.append((e.path, ">".join(e.children), e.noise))

    while last < end:
        m = TOKEN.search(page, last)
        stop = m.start() if m else end
        if stop > last:
            pieces.append(page[last:stop])
        if not m:
            break
        last = m.end()
        if not m[2]:
            continue
        tag, closing = m[2].lower(), m[1]
        if closing:
            if any(e.tag == tag for e in stack[1:]):
                if tag in BLOCK:
                    flush()
                while stack[-1].tag != tag:
                    if stack[-1].tag in BLOCK:
                        flush()
                    pop()
                if tag not in BLOCK and stack[-1].noise != stack[-2].noise:
                    flush()
                pop()
            elif tag in BLOCK:
                flush()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                pieces.append(" ")
            continue
        attributes = {a[0].lower(): a[1] or a[2] or a[3] for a in ATTRIBUTE.findall(m[3])} if m[3] and "=" in m[3] or "hidden" in (m[3] or "") else {}
        if tag in RAW:
            close = re.compile(f"</{tag}\\s*>", re.I).search(page, last)
            last = close.end() if close else end
            continue
        if tag in BLOCK:
            flush()
            _end_open(stack, tag, pop)
        above = stack[-1]
        noise = above.noise or _declared(tag, attributes, above.main is not None)
        main = None if noise else above.main
        opens = not noise and not main and (tag in ("article", "main") or attributes.get("role", "").lower() in ("main", "article"))
        declared += opens
        if tag not in BLOCK:
            if noise != above.noise or opens:
                flush()
            stack.append(Element(tag, above.path, noise, (declared, above.path) if opens else main))
            continue
        name = tag + "".join(f".{c}" for c in sorted(set(attributes.get("class", "").lower().split()))[:4])
        if above.main and OPEN_NAMES.search(attributes.get("id", "")):
            # the tree rates it apart from its neighbours
            name += "#" + re.sub(r"[\s/.]", "_", attributes["id"].lower())
        path = f"{above.path}/{name}" if len(stack) < DEPTH else above.path
        for e in reversed(stack):
            if e.tag in BLOCK or e is root:
                e.children.append(name)
                break
        stack.append(Element(tag, path, noise, (declared, path) if opens else main))
    flush()
    while len(stack) > 1:
        pop()
    return blocks, elements


def _end_open(stack: list[Element], tag: str, pop) -> None:
    """End what an opening block tag ends by itself."""
    ended, holders = ENDS.get(tag, (None, None))
    if ended:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in holders:
                break
            if stack[i].tag in ended:
                while len(stack) > i:
                    pop()
                break
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == "p":
            while len(stack) > i:
                pop()
            break
        if stack[i].tag in HOLDS_P:
            break


def extract(page: str | None, noisy: frozenset[str] = frozenset()) -> str:
    """The article's blocks joined by empty lines, without the branches and texts in ``noisy``."""
    if not page:
        return ""
    blocks = [b for b in walk(page)[0] if not b[1]]
    left = [b for b in blocks if not _below(b, noisy)] or blocks
    return "\n\n".join(b[3] for b in _article(left))


def _article(blocks: list[tuple[str, bool, tuple[int, str] | None, str]]) -> list[tuple[str, bool, tuple[int, str] | None, str]]:
    """The blocks of the article: declared ones, or those of a container that holds much more text than any declared one."""
    sizes: dict[tuple[int, str], int] = defaultdict(int)
    containers: dict[str, int] = defaultdict(int)
    for path, _, main, text in blocks:
        if main:
            sizes[main] += len(text)
        else:
            containers[path.rpartition("/")[0]] += len(text)
    if not sizes:
        return blocks
    best = max(sizes, key=lambda m: (sizes[m], -m[0]))
    top = max(containers, key=containers.get, default="")
    if containers[top] > UNDECLARED * sizes[best] and top.count("/") > 2:
        return [b for b in blocks if not b[2] and (b[0] + "/").startswith(top + "/")]
    return [b for b in blocks if b[2] and (b[2][1] == best[1] or ASIDE * sizes[b[2]] >= sizes[best])]


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _below(block: tuple[str, bool, tuple[int, str] | None, str], noisy: frozenset[str]) -> bool:
    if not noisy:
        return False
    path, _, main, text = block
    inside = len(main[1]) if main else len(path)
    loose = lambda p: len(p) <= inside or TAG.match(p, p.rfind("/") + 1)[0] in LOOSE
    if any(path[:i] in noisy and loose(path[:i]) for i in range(1, len(path) + 1) if i == len(path) or path[i] == "/"):
        return True
    return loose(path) and f"{path}\t{_hash(text)}" in noisy


def style_nodes(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``(host, path, kind, feature)``: for each page, its paths, their child sequences (``s``) and their texts (``t``), for its host and its domain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: set[tuple[str, str, str, int]] = set()
            rows: list[tuple[str, str, str, int]] = []
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
            for i in range(batch.num_rows):
                page, host = batch.column(1)[i].as_py(), host_of(batch.column(0)[i].as_py())
                if not page or not host:
                    continue
                blocks, elements = walk(page)
                out = {(host, p, "s", _hash(sequence)) for p, sequence, noise in elements if not noise}
                out |= {(host, p, "t", _hash(text)) for p, noise, _, text in blocks if not noise}
                rows += out
                if (domain := domain_of(host)) != host:
                    rows += [(f"*.{domain}", *r[1:]) for r in out]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["host", "path", "kind", "feature"])

    seen = pages.select(F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    return seen.mapInArrow(run, "host string, path string, kind string, feature long")


def noisy_paths(nodes: DataFrame, pages_of_host: DataFrame, least_pages: int, limit: float) -> DataFrame:
    """``(host, paths)``: what a host's style tree says, the paths whose branches hold nothing of importance and
    ``path TAB hash`` of texts that nearly all pages repeat.

    A feature on ``n`` of a path's ``m`` pages has the entropy share ``log n /
    log m`` as content; child sequences have the entropy of their distribution
    to the base ``m``. A branch is as important as its most important path. On
    sites of fewer than ``least_pages`` pages, but three, only what every page
    repeats has no importance.
    """
    features = nodes.groupBy("host", "path", "kind", "feature").agg(F.count("*").alias("n"))
    stats = features.groupBy("host", "path", "kind").agg(
        F.sum("n").alias("total"), F.sum(F.col("n") * F.log("n")).alias("nlogn"), F.avg(F.log("n")).alias("meanlog")
    )
    sites = pages_of_host.filter("pages > 2").withColumn("limit", F.when(F.col("pages") >= least_pages, limit).otherwise(1e-9))
    repeated = features.filter("kind = 't' and n > 2").join(sites, "host").filter(1 - F.log("n") / F.log("pages") < F.col("limit"))
    repeated = repeated.select("host", F.concat_ws("\t", "path", F.col("feature").cast("string")).alias("path"))
    # a single text is unique, a single child sequence says nothing
    stats = stats.join(sites, "host").filter("total > 1 or kind = 't'")
    log_all = F.log("total")
    presentation = (log_all - F.col("nlogn") / F.col("total")) / log_all
    content = 1 - F.col("meanlog") / F.log("pages")
    stats = stats.select("host", "path", "limit", F.when(F.col("kind") == "s", presentation).otherwise(content).alias("importance"))
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(2), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    branches = stats.filter(F.size(parts) > 1).select("host", "limit", F.explode(above).alias("path"), "importance")
    branches = branches.groupBy("host", "path").agg(F.max("importance").alias("importance"), F.first("limit").alias("limit"))
    low = branches.filter((F.col("importance") < F.col("limit")) & ~F.col("path").rlike("^/html[^/]*(/body[^/]*)?$"))
    return low.select("host", "path").union(repeated).groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("paths"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_pages: int = 8, limit: float = 0.2) -> DataFrame:
    """``(id, url, text, n_chars)`` for each row of ``pages``.

    A null page gives an empty text; a null or odd address has no site, so only
    declared noise is cut. Sites of fewer than ``least_pages`` pages add what
    the tree of their domain says, their host's last two labels.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST.pattern, 1))
    nodes = style_nodes(rows, "url", "html")
    sites = rows.groupBy(host.alias("host")).agg(F.count("*").alias("pages")).filter("host <> ''")
    sites = stage(sites.withColumn("domain", F.concat(F.lit("*."), F.substring_index("host", ".", -2))), "sites")
    domains = sites.filter(F.col("domain") != F.concat(F.lit("*."), "host")).groupBy(F.col("domain").alias("host")).agg(F.sum("pages").alias("pages"))
    noisy = stage(noisy_paths(nodes, sites.select("host", "pages").union(domains.filter(F.col("pages") >= least_pages)), least_pages, limit), "noisy")
    coarse = sites.filter(F.col("pages") < least_pages).select("host", "domain").join(noisy.select(F.col("host").alias("domain"), F.col("paths").alias("wider")), "domain")
    noisy = noisy.filter(~F.col("host").startswith("*.")).join(coarse.select("host", "wider"), "host", "full")
    noisy = noisy.select("host", F.array_union(*(F.coalesce(c, F.array().cast("array<string>")) for c in ("paths", "wider"))).alias("paths"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, ...], frozenset[str]] = {}
        for batch in batches:
            texts = []
            for i in range(batch.num_rows):
                paths = tuple(batch.column(3)[i].as_py() or ())
                texts.append(extract(batch.column(2)[i].as_py(), known.setdefault(paths, frozenset(paths))))
                if len(known) > 1000:
                    known.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    # pages without a site have nothing to find; those of large sites are dealt out
    placed = rows.withColumn("host", F.nullif(host, F.lit("")))
    named = attach(placed, noisy, ["host"], sizes=sites.select("host", F.col("pages").alias("__fw_n")), hot_rows=HOT_PAGES).select("id", "url", "html", "paths")
    return named.mapInArrow(run, f"id {kind}, url string, text string, n_chars long")
