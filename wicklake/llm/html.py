"""Operator 7: main text of web pages by wrapper induction."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicklake.llm.common import staged, text_batches

# Nodes of a page that take part in aligning.
MOST_NODES = 1500
MOST_DEPTH = 60
# A text is template if it stands in the same place of so many of the host's pages.
TEMPLATE_SHARE = 0.75
LEAST_PAGES = 3
# Every text that so many of the host's pages have is on a page that all others are aligned to.
OFTEN_SHARE = 0.5
# Pages with more of their text in common are copies of each other and say nothing about the template.
COPY_SHARE = 0.5

# Fixed lists: HTML elements, and names of classes, ids and roles.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption".split())
CLOSES_P = BLOCKS - {"html", "body", "li", "dd", "dt", "tr", "tbody", "thead", "tfoot", "caption"}
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}, "tbody": {"tr", "td", "th", "tbody", "thead"}}
SCOPES = frozenset("html body ul ol table article section div main td th dl select".split())
NEVER = frozenset("head script style noscript template nav footer aside form button select option textarea input label iframe object embed svg canvas "
                  "audio video map menu dialog title".split())
SIDE = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted sidebar nav navbar navigation menu "
                 "breadcrumb breadcrumbs footer cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription signup "
                 "share sharing social related recommended recommendations comment comments commentlist discussion reply replies respond disqus login "
                 "search toolbar pagination pager widget widgets skip complementary contentinfo dialog form gdpr teaser teasers outbrain taboola hidden".split())
TOP = frozenset("header masthead topbar".split())
MAIN = ("article", "main")

_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_LEAF = re.compile(r"p|h[1-6]|li")


class Node:
    __slots__ = ("tag", "names", "kids", "skip")

    def __init__(self, tag: str, names: tuple[str, ...] = (), skip: bool = False):
        self.tag, self.names, self.skip = tag, names, skip
        self.kids: list[Node | str] = []

    @property
    def label(self) -> str:
        return self.tag + "".join("." + n for n in self.names)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        given = {k: v or "" for k, v in attrs}
        if tag in CLOSES_P:
            self._end("p", {"table", "td", "th", "li", "dd"} | {"article", "section", "div", "main", "body"})
        if tag in ENDED_BY:
            self._end_any(ENDED_BY[tag])
        names = tuple(sorted({w.lower() for k in ("class", "id", "role") for w in _SPLIT.split(given.get(k, "")) if w and not w.isdigit()}))
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "").lower()
        node = Node(tag, names, hidden)
        self.open[-1].kids.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag and tag not in BLOCKS:
            self.open.pop()

    def handle_endtag(self, tag):
        if tag == "p" and not any(n.tag == "p" for n in self.open):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in ("table", "td", "th") and tag not in BLOCKS:
                return

    def handle_data(self, data):
        self.open[-1].kids.append(data)

    def _end(self, tag: str, stops: set[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in stops:
                return

    def _end_any(self, tags: set[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return
            if self.open[i].tag in SCOPES:
                return


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def _excluded(node: Node, inside: bool) -> bool:
    """Whether the element is no part of the main text by its kind; `inside` an article or main element a header is."""
    return node.skip or node.tag in NEVER or node.tag == "header" and not inside


def _named(node: Node, inside: bool) -> bool:
    """Whether the class, id or role names something beside the main text. Holds only where the element has not most of the
    page's varying text."""
    if node.tag in ("html", "body"):
        return False
    return node.tag not in MAIN and not SIDE.isdisjoint(node.names) or not inside and not TOP.isdisjoint(node.names)


def _heavy(root: Node, template: set[int]) -> set[int]:
    """The elements with over half of the page's text outside of links, template texts and elements excluded by kind."""
    nodes: list[tuple[Node, int]] = []
    own: list[int] = []
    stack: list[tuple[Node, int, str, bool, bool]] = [(root, -1, f"/{root.label}", False, False)]
    while stack:
        node, parent, path, inside, template_text = stack.pop()
        at = len(nodes)
        nodes.append((node, parent))
        if node is root or node.tag in BLOCKS:
            template_text = bool(template) and _own_is_template(node, path, template)
        own.append(0 if template_text else sum(len(" ".join(k.split())) for k in node.kids if isinstance(k, str)))
        inside = inside or node.tag in MAIN
        stack.extend((k, at, f"{path}/{k.label}" if k.tag in BLOCKS else path, inside, template_text) for k in node.kids
                     if isinstance(k, Node) and k.tag != "a" and not _excluded(k, inside))
    for i in range(len(nodes) - 1, 0, -1):
        own[nodes[i][1]] += own[i]
    return {id(node) for (node, _), k in zip(nodes, own) if 2 * k > own[0]}


def _text(node: Node) -> str:
    parts: list[str] = []
    stack: list[Node | str] = [node]
    while stack:
        at = stack.pop()
        if isinstance(at, str):
            parts.append(at)
        else:
            stack.extend(reversed(at.kids))
    return " ".join(" ".join(parts).split())


@dataclass
class _Item:
    """A block of text as a node to align: its label path and its words."""

    node: Node
    text: str
    kids: list[_Item] = field(default_factory=list)


def _items(root: Node) -> _Item:
    """The element tree with inline elements folded into the text of their block; at most MOST_NODES nodes, breadth first,
    and MOST_DEPTH levels. What lies beyond counts as text."""
    top = _Item(root, "")
    queue, made = [(root, top, 0)], 0
    for node, item, depth in queue:
        own: list[str] = []
        for kid in node.kids:
            if isinstance(kid, str):
                own.append(kid)
            elif kid.tag in BLOCKS and made < MOST_NODES and depth < MOST_DEPTH:
                made += 1
                item.kids.append(_Item(kid, ""))
                queue.append((kid, item.kids[-1], depth + 1))
            elif kid.tag not in ("script", "style", "head"):
                own.append(_text(kid))
        item.text = " ".join(" ".join(own).split())
    return top


def match(a: _Item, b: _Item) -> tuple[int, list[tuple[_Item, _Item]]]:
    """Simple tree matching: the largest number of node pairs with equal labels that keeps order and parents, and those pairs.

    Two nodes match only if their parents do; the children of a matched pair are aligned like sequences, with the matching
    of their subtrees as weight.
    """
    if a.node.label != b.node.label:
        return 0, []
    m, n = len(a.kids), len(b.kids)
    weight = [[0] * (n + 1) for _ in range(m + 1)]
    pairs: dict[tuple[int, int], list] = {}
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            best = max(weight[i - 1][j], weight[i][j - 1])
            if a.kids[i - 1].node.label == b.kids[j - 1].node.label:
                if a.kids[i - 1].kids or b.kids[j - 1].kids:
                    w, p = match(a.kids[i - 1], b.kids[j - 1])
                else:
                    w, p = 1, [(a.kids[i - 1], b.kids[j - 1])]
                # Among equal alignments of leaves prefer those of equal text.
                w = 2 * w + (a.kids[i - 1].text == b.kids[j - 1].text)
                pairs[i, j] = (w, p)
                best = max(best, weight[i - 1][j - 1] + w)
            weight[i][j] = best
    found, i, j = [(a, b)], m, n
    while i and j:
        if (i, j) in pairs and weight[i][j] == weight[i - 1][j - 1] + pairs[i, j][0]:
            found += pairs[i, j][1]
            i, j = i - 1, j - 1
        elif weight[i][j] == weight[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return len(found), found


def _fingerprint(path: str, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\n{text}") & (2**63 - 1)


def _paths(item: _Item, prefix: str = "") -> Iterator[tuple[str, _Item]]:
    stack = [(prefix, item)]
    while stack:
        path, at = stack.pop()
        here = f"{path}/{at.node.label}"
        yield here, at
        stack.extend((here, k) for k in reversed(at.kids))


class _Page:
    """A page to align: its tree, the paths of the tree's nodes, and the length of its text."""

    def __init__(self, root: Node):
        self.tree = _items(root)
        self.paths = [(path, item) for path, item in _paths(self.tree) if item.text]
        self.marks = {id(item): _fingerprint(path, item.text) for path, item in self.paths}
        self.total = sum(len(item.text) for _, item in self.paths)

    def repeated(self, other: _Item) -> list[int] | None:
        """Fingerprints of the texts that aligned nodes of the other page repeat, each once; None if the pages are copies of each other."""
        _, pairs = match(self.tree, other)
        same = [a for a, b in pairs if a.text and a.text == b.text]
        if sum(len(a.text) for a in same) > COPY_SHARE * self.total:
            return None
        return list({self.marks[id(a)] for a in same})

    def holders(self, template: set[int]) -> list[str]:
        """Paths of the elements that hold most of the page's varying text outside of links."""
        slots: list[tuple[str, int]] = []
        for path, item in self.paths:
            if self.marks[id(item)] not in template and not _side_path(path):
                plain = len(item.text) - sum(len(_text(k)) for k in item.node.kids if isinstance(k, Node) and k.tag == "a")
                slots.append((path, max(plain, 0)))
        every = _sums(slots)
        heavy = {path for path, k in every.items() if 2 * k > max(every.values())}
        seen = _sums([(path, k) for path, k in slots if not _side_path(path, heavy)])
        top = max(seen.values(), default=0)
        return [path for path, k in seen.items() if top and k >= 0.8 * top and not _LEAF.fullmatch(path.rpartition("/")[2].split(".")[0])]


def _repeats(shared: int, peers: int) -> bool:
    return shared >= max(LEAST_PAGES - 1, TEMPLATE_SHARE * peers)


def induce(pages: list[str]) -> tuple[list[int], str]:
    """The wrapper of a host: fingerprints (path and text) of its template texts, and the path of its content.

    Every two pages are aligned. A text that its aligned nodes repeat on TEMPLATE_SHARE of the other pages, and on LEAST_PAGES
    in all, is constant and so template; the rest are slots. Pages that are copies of each other are told apart from pages that
    share a template by how much of their text agrees, and do not count. The content is the deepest element that holds most
    of the slots' text outside of links; it is used for pages without an article or main element.

    This is the plain form for a few pages; `main_text` aligns all pages of a host to some of them.
    """
    read = [_Page(parse(p)) for p in pages]
    constant: Counter = Counter()
    peers: Counter = Counter()
    for x, one in enumerate(read):
        for y, other in enumerate(read):
            same = one.repeated(other.tree) if x != y else None
            if same is not None:
                peers[x] += 1
                constant.update((x, f) for f in same)
    template = {f for (x, f), k in constant.items() if _repeats(k, peers[x])}
    weight = Counter(path for page in read for path in page.holders(template))
    holders = [p for p, k in weight.items() if k >= 0.5 * len(pages)]
    return sorted(template), max(holders, key=lambda p: (p.count("/"), p), default="")


def _sums(slots: list[tuple[str, int]]) -> dict[str, int]:
    """The weights of all paths at and above those given."""
    out: defaultdict[str, int] = defaultdict(int)
    for at, k in slots:
        while at:
            out[at] += k
            at = at.rpartition("/")[0]
    return out


def _side_path(path: str, heavy: set[str] | None = None) -> bool:
    """Whether a step of the path is excluded by kind or, if the `heavy` paths are given, by name and not one of them."""
    here = ""
    for step in path.split("/")[1:]:
        here += "/" + step
        tag, *names = step.split(".")
        node = Node(tag, tuple(names))
        if _excluded(node, False) or heavy is not None and here not in heavy and _named(node, False):
            return True
    return False


def extract(html: str | None, template: set[int] = frozenset(), content: str = "") -> str:
    """The blocks of the main text, joined by an empty line.

    The article element (or main, or else the element at the wrapper's content path, or else the body) without the wrapper's
    template texts, and without elements that are something else by their kind, or by their name if most of the page's varying
    text lies outside of them. White space inside a block becomes one space.
    """
    root = parse(html)
    heavy = _heavy(root, template)
    starts = _mains(root, content, heavy)
    blocks: list[str] = []
    parts: list[str] = []

    def close() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            blocks.append(text)

    for path, node, inside in starts:
        # Explicit stack: pages may nest deeper than Python recurses.
        stack: list = [("enter", node, path, inside)]
        while stack:
            what, at, path, inside = stack.pop()
            if what == "text":
                parts.append(at)
                continue
            if what == "close":
                close()
                continue
            if at is not node and (_excluded(at, inside) or id(at) not in heavy and _named(at, inside)):
                parts.append(" ")
                continue
            inside = inside or at.tag in MAIN
            if at.tag in BLOCKS:
                if template and _own_is_template(at, path, template):
                    close()
                    kids = [("enter", k, f"{path}/{k.label}", inside) for k in at.kids if isinstance(k, Node) and k.tag in BLOCKS]
                    stack.extend([*reversed(kids)])
                    continue
                close()
                stack.append(("close", None, "", False))
            elif at.tag in ("br", "td", "th", "img"):
                parts.append(" ")
            for kid in reversed(at.kids):
                if isinstance(kid, str):
                    stack.append(("text", kid, "", False))
                else:
                    stack.append(("enter", kid, f"{path}/{kid.label}" if kid.tag in BLOCKS else path, inside))
        close()
    return "\n\n".join(blocks)


def _own_is_template(node: Node, path: str, template: set[int]) -> bool:
    own = [k if isinstance(k, str) else _text(k) for k in node.kids if isinstance(k, str) or k.tag not in BLOCKS and k.tag not in ("script", "style", "head")]
    text = " ".join(" ".join(own).split())
    return bool(text) and _fingerprint(path, text) in template


def _places(root: Node, content: str, heavy: set[int]) -> dict[str, list[list]]:
    """Outermost article elements, main and body elements, and those at the content path: outside of elements named as something
    else, in a named one that has most of the varying text, and in any other named one."""
    found: dict[str, list[list]] = {kind: [[], [], []] for kind in ("article", "main", "content", "body")}
    stack: list[tuple[str, Node, bool, int]] = [(f"/{root.label}", root, False, 0)]
    while stack:
        path, node, inside, rank = stack.pop()
        if node is not root:
            if _excluded(node, inside):
                continue
            if _named(node, inside):
                rank = max(rank, 1 if id(node) in heavy else 2)
        if node.tag in found:
            found[node.tag][rank].append((path, node, node.tag in MAIN))
            if node.tag == "article":
                continue
        if content and path == content and node.tag in BLOCKS:
            found["content"][rank].append((path, node, True))
        stack.extend((f"{path}/{k.label}" if k.tag in BLOCKS else path, k, inside or node.tag in MAIN, rank) for k in reversed(node.kids) if isinstance(k, Node))
    return found


def _mains(root: Node, content: str, heavy: set[int]) -> list[tuple[str, Node, bool]]:
    """Where the main text is: outermost article elements, else main, else the content path, else all.

    Elements outside of those named as something else come first, then those in a named one that has most of the varying text.
    An article or main element in any other named one counts if there is no other and no content path.
    """
    found = _places(root, content, heavy)
    for kind, rank in (("article", 0), ("article", 1), ("main", 0), ("main", 1), ("content", 0), ("content", 1), ("article", 2), ("main", 2), ("body", 0)):
        if found[kind][rank]:
            return found[kind][rank]
    return [(f"/{root.label}", root, False)]


@lru_cache(maxsize=32)
def _model(html: str) -> _Page:
    return _Page(parse(html))


def _outlines(signed: DataFrame) -> DataFrame:
    """(host, sign, bare, total, texts) of each different page: whether no article or main element is sure to be its main text, the
    length of its text, and the fingerprint and length of each of its texts."""
    names = ["host", "sign", "bare", "total", "texts"]
    texts = pa.list_(pa.struct([("mark", pa.int64()), ("chars", pa.int64())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bare, total, found = [], [], []
            for html in batch["html"].to_pylist():
                root = parse(html)
                places = _places(root, "", set())
                page, chars = _Page(root), Counter()
                for _, item in page.paths:
                    chars[page.marks[id(item)]] += len(item.text)
                bare.append(not (places["article"][0] or places["main"][0]))
                total.append(page.total)
                found.append([{"mark": mark, "chars": k} for mark, k in chars.items()])
            yield pa.RecordBatch.from_arrays(
                [batch["host"], batch["sign"], pa.array(bare, pa.bool_()), pa.array(total, pa.int64()), pa.array(found, texts)], names)

    rows = signed.mapInArrow(read, "host string, sign long, bare boolean, total long, texts array<struct<mark: long, chars: long>>")
    return rows.dropDuplicates(["host", "sign"])


def _models(signed: DataFrame, outlines: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, models): the pages (sign, html) that all pages of the host are aligned to.

    Each text that OFTEN_SHARE of all pages have is on one of them: of the pages with it, one of those with the least share of such
    texts, so that others are not taken for its copies, and of those the shortest.
    """
    each = outlines.select("host", "sign", "total", F.inline("texts"))
    often = staged(each.groupBy("host", "mark").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_PAGES).join(hosts, "host")
                   .filter(F.col("n") >= OFTEN_SHARE * F.col("pages")).select("host", "mark"), "often")
    shared = each.join(often, ["host", "mark"]).groupBy("host", "sign", "total").agg(F.sum("chars").alias("shared"), F.collect_list("mark").alias("marks"))
    # All shares up to a half are as good.
    order = F.struct(F.greatest(F.floor(4 * F.col("shared") / F.col("total")), F.lit(1)), "total", "sign")
    chosen = staged(shared.select("host", order.alias("rank"), F.explode("marks").alias("mark")).groupBy("host", "mark").agg(F.min("rank").alias("rank"))
                    .select("host", "rank.sign").distinct(), "chosen")
    return (signed.join(chosen, ["host", "sign"], "left_semi").dropDuplicates(["host", "sign"])
            .groupBy("host").agg(F.collect_list(F.struct("sign", "html")).alias("models")))


def _templates(signed: DataFrame, models: DataFrame) -> DataFrame:
    """(host, template): fingerprints of the texts that aligned nodes repeat, by the counts of `induce` over all pages of the host."""
    names = ["host", "model", "sign", "same"]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, sign, html, models in zip(*(batch[c].to_pylist() for c in ("host", "sign", "html", "models"))):
                tree = _items(parse(html))
                rows += [(host, m["sign"], sign, _model(m["html"]).repeated(tree)) for m in models if m["sign"] != sign]
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())))], names)

    met = staged(signed.join(models, "host").mapInArrow(align, "host string, model long, sign long, same array<long>")
                 .filter("same IS NOT NULL").dropDuplicates(["host", "model", "sign"]), "met")
    peers = met.groupBy("host", "model").agg(F.count("*").alias("peers"))
    counts = met.select("host", "model", F.explode("same").alias("mark")).groupBy("host", "model", "mark").agg(F.count("*").alias("n"))
    least = F.greatest(F.lit(LEAST_PAGES - 1), TEMPLATE_SHARE * F.col("peers"))
    return (counts.join(peers, ["host", "model"]).filter(F.col("n") >= least)
            .groupBy("host").agg(F.sort_array(F.collect_set("mark")).alias("template")))


def _contents(signed: DataFrame, hosts: DataFrame, templates: DataFrame) -> DataFrame:
    """(host, content): the deepest path that holds most of the varying text of half of all pages, for hosts with `bare` pages."""
    names = ["host", "sign", "pages", "paths"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [_Page(parse(h)).holders(set(t or ())) for h, t in zip(batch["html"].to_pylist(), batch["template"].to_pylist())]
            columns = [*(batch[c] for c in names[:3]), pa.array(paths, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = (signed.join(hosts.filter("bare"), "host").join(templates, "host", "left").select("host", "sign", "pages", "html", "template")
            .mapInArrow(read, "host string, sign long, pages long, paths array<string>"))
    return (rows.dropDuplicates(["host", "sign"]).select("host", "pages", F.explode("paths").alias("path"))
            .groupBy("host", "pages", "path").agg(F.count("*").alias("n")).filter(F.col("n") >= 0.5 * F.col("pages"))
            .groupBy("host").agg(F.max_by("path", F.struct(F.size(F.split("path", "/")), "path")).alias("content")))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of `pages` (page_id, url, html, ...).

    For each host a wrapper is induced from all its different pages: which texts are template and where the content is. Texts are
    counted over all pages; all pages are aligned to a few that have every text that is often there; texts that aligned nodes
    repeat are counted again. Only hashes, lengths and paths shuffle by page, and no group holds the pages of a host. The wrapper is
    then joined to all pages of the host: Spark broadcasts the wrappers below its size threshold and otherwise splits a host with
    very many pages. Pages of a host that has fewer than LEAST_PAGES different pages are read by element kinds, names
    and lengths of text alone. A null url is a host of its own, a null or empty html gives an empty text; repeated rows are answered each. Other
    columns are not read. No rows give no rows.
    """
    text_batches(pages.sparkSession, 256)
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[^:/?#]*:?//([^/?#]*)", 1)), F.lit(""))
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))
    signed = plain.filter(F.length("html") > 0).select("host", "html", F.xxhash64("html").alias("sign"))
    # Staged, the size of what is joined to the pages is known: Spark broadcasts a small table and does not shuffle their html.
    outlines = staged(_outlines(signed), "outlines")
    hosts = staged(outlines.groupBy("host").agg(F.count("*").alias("pages"), F.bool_or("bare").alias("bare")).filter(F.col("pages") >= LEAST_PAGES), "hosts")
    templates = staged(_templates(signed, staged(_models(signed, outlines, hosts), "models")), "templates")
    # The content path is not asked for where every page has an article or main element.
    contents = staged(_contents(signed, hosts, templates), "contents")
    wrappers = staged(templates.join(contents, "host", "full"), "wrappers")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h, set(t or ()), c or "") for h, t, c in
                     zip(batch["html"].to_pylist(), batch["template"].to_pylist(), batch["content"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return (plain.join(wrappers, "host", "left").select("page_id", "url", "html", "template", "content")
            .mapInArrow(read, "page_id long, url string, text string"))
