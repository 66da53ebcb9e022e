"""Main text of web pages by wrappers induced from the pages of a host.

A page's tree is folded: neighbours of one shape become one node, so lists and paragraphs of any length look alike. The
folded trees of a host fall into layouts, each with a reference: the most frequent tree, then the most frequent of those
that resemble no reference so far. Every page's tree is aligned with the reference of its layout by simple tree matching.
A node of the reference whose text is the same on nearly all aligned pages is template, the others are slots; in a slot, an
element's text that stands there on nearly all pages is template too. The main text is what stands in slots outside menus,
notices and the like. Only where a layout has too few pages to tell, it is what stands in the article or main element.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.llm.common import sliced, stored, strings

#: A text on this share of a host's pages, of so many at least, is template.
CONSTANT, LEAST_PAGES = 0.9, 3
#: Trees are of one layout if such shares of the smaller and the larger one are matched.
RESEMBLES, COVERS = 0.8, 0.3
#: Trees of a host that a round looks at, the most frequent ones: at first, and at most, as the number doubles.
FEW, MANY = 16, 1024

# Elements of HTML by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
BESIDE = frozenset("head nav footer aside form script style noscript template iframe svg button select textarea title object canvas audio video dialog menu".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
MAIN = ("article", "main")
CLOSES_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

_MARK = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)>""", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_BESIDE_NAME = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|sponsor(?:ed)?|promo|banner|cookies?|consent|notices?|alert|popup|modal|overlay|menu|nav|navbar|navigation|breadcrumbs?|sidebar|side|footer|masthead|comments?|comment-list|disqus|replies|respond|share|sharing|social|related|recommended|newsletter|subscribe|subscription|signup|login|search|toolbar|widget|pagination|pager|complementary|contentinfo|skip-link)(?:$|[\s_-])", re.I)
_HEAD_NAME = re.compile(r"(?:^|[\s_-])(?:header|site-header|banner)(?:$|[\s_-])", re.I)


class Node:
    """An element: its tag, its class, id and role, and its children, elements or texts."""

    __slots__ = ("tag", "names", "children", "slot")

    def __init__(self, tag: str, names: str = ""):
        self.tag, self.names, self.children, self.slot = tag, names, [], -1


def parse(page: str) -> Node:
    """The tree of a page; missing and stray end tags are mended as browsers do for common elements."""
    root = Node("#page")
    open_, at, n = [root], 0, len(page)
    while at < n:
        m = _MARK.search(page, at)
        if m is None:
            open_[-1].children.append(page[at:])
            break
        if m.start() > at:
            open_[-1].children.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    del open_[k:]
                    break
            continue
        if tag in CLOSES_P:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == "p":
                    del open_[k:]
                    break
                if open_[k].tag not in INLINE:
                    break
        if tag in CLOSES_SAME:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    del open_[k:]
                    break
                if open_[k].tag in CLOSES_SAME[tag]:
                    break
        node = Node(tag, " ".join(a or b or c for _, a, b, c in _NAMES.findall(m[3])) if m[3] else "")
        open_[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID and not m[3].endswith("/"):
            open_.append(node)
    return root


def beside(node: Node, inside: bool) -> bool:
    """Whether an element holds no main text whatever its text; inside: within the article."""
    if node.tag in BESIDE or (node.names and _BESIDE_NAME.search(node.names)):
        return True
    return not inside and (node.tag == "header" or bool(node.names and _HEAD_NAME.search(node.names)))


def _kids(x: Node) -> list[Node]:
    return [c for c in x.children if isinstance(c, Node) and c.tag not in INLINE and c.tag not in RAW]


def fold(node: Node) -> str:
    """The folded tree of block elements, as JSON of its labels and of the sizes of its subtrees, in preorder; gives every
    element in it the number of its folded node. No step depends on the depth of the page."""
    order, work = [], [node]
    while work:
        x = work.pop()
        order.append(x)
        work += _kids(x)
    kinds: dict[tuple[str, tuple[int, ...]], int] = {}  # shapes by label and shapes of the children
    sizes: list[int] = []
    kind_of: dict[int, int] = {}
    for x in reversed(order):  # children come after their parent in order
        below: list[int] = []
        for c in _kids(x):
            if not below or below[-1] != kind_of[id(c)]:
                below.append(kind_of[id(c)])
        key = (f"{x.tag}.{x.names}" if x.names else x.tag, tuple(below))
        if key not in kinds:
            kinds[key] = len(sizes)
            sizes.append(1 + sum(sizes[k] for k in below))
        kind_of[id(x)] = kinds[key]
    node.slot = 0
    for x in order:
        at, last = x.slot + 1, None
        for c in _kids(x):
            kind = kind_of[id(c)]
            if last is not None and kind != last:
                at += sizes[last]
            c.slot, last = at, kind
    labels, spans, shapes = [], [], list(kinds)
    todo = [kind_of[id(node)]]
    while todo:
        k = todo.pop()
        labels.append(shapes[k][0])
        spans.append(sizes[k])
        todo += reversed(shapes[k][1])
    return json.dumps([labels, spans])


@lru_cache(maxsize=4096)
def _tree(shape: str) -> tuple[list[str], list[list[int]]]:
    """Labels and children of the nodes of a folded tree."""
    labels, sizes = json.loads(shape)
    kids: list[list[int]] = [[] for _ in labels]
    for i, size in enumerate(sizes):
        at = i + 1
        while at < i + size:
            kids[i].append(at)
            at += sizes[at]
    return labels, kids


def _best(xs: list[int], ys: list[int], weight: dict[tuple[int, int], int]) -> list[list[int]]:
    """The largest weight of matches that keep order, for each number of first nodes of both lists."""
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i, c in enumerate(xs):
        for j, d in enumerate(ys):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weight.get((c, d), 0))
    return best


@lru_cache(maxsize=4096)
def align(one: str, two: str) -> dict[int, int]:
    """Simple tree matching of two folded trees: number of a node in one -> in two, for the largest set of pairs
    with equal labels that keeps parents and order."""
    (la, ka), (lb, kb) = _tree(one), _tree(two)
    if la[0] != lb[0]:
        return {}
    met, work = [], [(0, 0)]
    while work:
        x, y = work.pop()
        met.append((x, y))
        work += [(c, d) for c in ka[x] for d in kb[y] if la[c] == lb[d]]
    weight: dict[tuple[int, int], int] = {}
    for x, y in sorted(met, reverse=True):  # children have larger numbers
        weight[x, y] = 1 + _best(ka[x], kb[y], weight)[-1][-1]
    found, work = {}, [(0, 0)]
    while work:
        x, y = work.pop()
        found[x] = y
        xs, ys = ka[x], kb[y]
        best = _best(xs, ys, weight)
        i, j = len(xs), len(ys)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                work.append((xs[i], ys[j]))
    return found


def _nodes(shape: str) -> int:
    return len(_tree(shape)[0])


def layout_of(shape: str, references: list[str]) -> tuple[int, dict[int, int]] | None:
    """The first reference that a folded tree resembles, by its place, and the alignment with it; None if there is none."""
    for k, reference in enumerate(references):
        to = align(shape, reference)
        sizes = _nodes(shape), _nodes(reference)
        if len(to) >= RESEMBLES * min(sizes) and len(to) >= COVERS * max(sizes):
            return k, to
    return None


def _spoken(pieces: list[str]) -> str:
    return " ".join(html.unescape("".join(pieces)).split())


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _own(x: Node) -> list[str]:
    """The texts that stand directly in an element, inline elements included."""
    found, work = [], [iter(x.children)]
    while work:
        for c in work[-1]:
            if isinstance(c, str):
                found.append(c)
            elif c.tag not in RAW and c.slot < 0:
                work.append(iter(c.children))
                break
        else:
            work.pop()
    return found


def own_texts(root: Node) -> dict[int, list[str]]:
    """For each folded node the texts of its elements, in page order; elements without a text of their own are left out."""
    found: dict[int, list[str]] = {}
    work = [root]
    while work:
        x = work.pop()
        if (x.slot >= 0) and (t := _spoken(_own(x))):
            found.setdefault(x.slot, []).append(t)
        work += [c for c in reversed(x.children) if isinstance(c, Node) and c.tag not in RAW]
    return found


def _mains(root: Node) -> list[Node]:
    """Outermost articles, or else main elements, that do not stand beside."""
    for tag in MAIN:
        found, work = [], [root]
        while work:
            x = work.pop()
            if x is not root and x.tag == tag:
                found.append(x)
            else:
                work += [c for c in reversed(x.children) if isinstance(c, Node) and not beside(c, False)]
        if found:
            return found
    return []


def blocks(roots: list[Node], inside: bool, template: set[int], texts: frozenset[tuple[int, int]] = frozenset()) -> list[str]:
    """Texts of the blocks below some elements in page order, without elements that stand beside, template nodes and
    elements whose own text is template at their node (texts: pairs of node and hash)."""
    out: list[str] = []
    now: list[str] = []

    def end() -> None:
        if text := _spoken(now):
            out.append(text)
        now.clear()

    def fixed(x: Node) -> bool:
        return x.slot in template or bool(texts) and (x.slot, _hash(_spoken(_own(x)))) in texts

    for root in roots:
        end()
        work = [(iter(root.children), inside, fixed(root), False)]  # children left, inside, silent, a block of its own
        while work:
            left, within, silent, block = work[-1]
            for c in left:
                if isinstance(c, str):
                    if not silent:
                        now.append(c)
                elif c.tag in ("br", "hr", "wbr"):
                    now.append(" " if c.tag == "br" else "")
                    if c.tag == "hr":
                        end()
                elif c.tag in RAW or beside(c, within):
                    if c.tag not in INLINE:
                        end()
                elif c.tag in INLINE:
                    work.append((iter(c.children), within, silent, False))
                    break
                else:
                    end()
                    work.append((iter(c.children), within or c.tag in MAIN, fixed(c) if c.slot >= 0 else silent, True))
                    break
            else:
                work.pop()
                if block:
                    end()
    end()
    return out


def _main(root: Node, references: list[str], templates: list[tuple[set[int], frozenset[tuple[int, int]]] | None]) -> str:
    """The main text of a tree, given its host's references and the template nodes and texts of each, None if unknown."""
    if references and (found := layout_of(fold(root), references)) and (template := templates[found[0]]):
        to, (nodes, texts) = found[1], template
        back = {b: a for a, b in to.items()}
        return "\n\n".join(blocks([root], False, {back[b] for b in nodes if b in back}, frozenset((back[b], t) for b, t in texts if b in back)))
    if mains := _mains(root):
        return "\n\n".join(blocks(mains, True, set()))
    return "\n\n".join(blocks([root], False, set()))


def main_text(page: str, reference: str | None, template: list[int]) -> str:
    """The main text of a page, given its layout's reference tree and which of its nodes are template."""
    return _main(parse(page), [reference] if reference else [], [(set(template), frozenset())])


@lru_cache(maxsize=256)
def _known(layouts: str) -> tuple[list[str], list]:
    """References and templates of a host's layouts as wrappers() writes them."""
    found = json.loads(layouts)
    return [x["reference"] for x in found], [(set(x["nodes"]), frozenset((t["node"], t["text"]) for t in x["texts"])) if x["known"] else None for x in found]


def hosted(pages: DataFrame) -> DataFrame:
    """page_id, url, html, host: what stands between // and the next / of the address, in small letters; empty if null."""
    host = F.lower(F.coalesce(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host"))


def _chosen(table: pa.Table) -> pa.Table:
    """host, layout, reference of one host: of its trees, from the most frequent one on, those that resemble none chosen
    before."""
    rows = sorted(zip(table.column("n").to_pylist(), table.column("shape").to_pylist(), strict=True), reverse=True)
    found: list[str] = []
    for _, shape in rows:
        if layout_of(shape, found) is None:
            found.append(shape)
    hosts = pa.array([table.column("host")[0].as_py()] * len(found), pa.string())
    return pa.table({"host": hosts, "layout": pa.array(range(len(found)), pa.int32()), "reference": pa.array(found, pa.string())})


def _references(shaped: DataFrame, few: int = FEW, many: int = MANY) -> DataFrame:
    """host, references (JSON), for each host: the most frequent tree, then the most frequent of those that resemble no
    reference so far, until each tree resembles one.

    A round settles the `few` most frequent trees of each host, the next one twice as many, and so on up to `many`; what
    resembles the references it gives takes no part in the next.
    """
    kinds = pa.schema([("host", pa.string()), ("shape", pa.string()), ("n", pa.int64())])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            new = [layout_of(s, json.loads(r)) is None for s, r in zip(strings(batch.column(1)), strings(batch.column(3)), strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:3], schema=kinds).filter(pa.array(new, pa.bool_()))

    left, rounds = stored(shaped), []
    by_use = Window.partitionBy("host").orderBy(F.desc("n"), F.desc("shape"))
    while not left.isEmpty():
        head = left.withColumn("place", F.row_number().over(by_use)).where(F.col("place") <= min(many, few << len(rounds))).drop("place")
        top = stored(head.groupBy("host").applyInArrow(_chosen, "host string, layout int, reference string"))
        rounds.append(top.withColumn("round", F.lit(len(rounds))))
        left = stored(left.join(_listed(top), "host").select("host", "shape", "n", "references").mapInArrow(others, "host string, shape string, n long"))
    if not rounds:
        return shaped.select("host", F.col("shape").alias("references"))
    return stored(_listed(reduce(DataFrame.unionByName, rounds)))


def _listed(references: DataFrame) -> DataFrame:
    order = F.struct(*(c for c in ("round", "layout", "reference") if c in references.columns))
    return references.groupBy("host").agg(F.to_json(F.transform(F.sort_array(F.collect_list(order)), lambda x: x["reference"])).alias("references"))


def wrappers(pages: DataFrame, constant: float = CONSTANT, least: int = LEAST_PAGES) -> DataFrame:
    """host, layouts (JSON: reference, known, nodes, texts of each), from all pages of each host (as hosted() makes them).

    nodes are the numbers of those whose text does not vary, texts the pairs of node and hash of an element's text that
    stands there on nearly every page. Pages of the same texts count once. A layout of fewer than least different pages, or
    on which no text varies, is not known.
    """

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fold(parse(t)) for t in strings(batch.column(1))], pa.string())], names=["host", "shape"])

    kinds = pa.schema([("host", pa.string()), ("layout", pa.int32()), ("node", pa.int32()), ("whole", pa.bool_()), ("text", pa.int64()), ("page", pa.int64())])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = []
            for host, page, references in zip(*(strings(c) for c in batch.columns), strict=True):
                root = parse(page)
                if (found := layout_of(fold(root), json.loads(references))) is None:
                    continue
                own = own_texts(root)
                mark = _hash(json.dumps(sorted(own.items())))
                for k, of in own.items():
                    if (node := found[1].get(k)) is not None:
                        rows.append((host, found[0], node, True, _hash(" ".join(of)), mark))
                        rows += [(host, found[0], node, False, t, mark) for t in set(map(_hash, of))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t.type) for t in kinds], schema=kinds)

    shaped = pages.select("host", "html").mapInArrow(shapes, "host string, shape string").groupBy("host", "shape").agg(F.count("*").alias("n"))
    references = _references(shaped)
    once = pages.select("host", "html").join(references, "host").select("host", "html", "references").mapInArrow(texts, "host string, layout int, node int, whole boolean, text long, page long").distinct()
    counts = stored(once.groupBy("host", "layout", "node", "whole", "text").agg(F.count("*").alias("n")))
    nodes = counts.where("whole").groupBy("host", "layout", "node").agg(F.sum("n").alias("pages"), F.max("n").alias("same"))
    nodes = stored(nodes.withColumn("fixed", (F.col("pages") >= least) & (F.col("same") >= constant * F.col("pages"))))
    lines = counts.where(f"not whole and n >= {least}").join(nodes.where("not fixed"), ["host", "layout", "node"]).where(F.col("n") >= constant * F.col("pages"))
    by_text = lines.groupBy("host", "layout").agg(F.collect_list(F.struct("node", "text")).alias("texts"))
    by_node = nodes.groupBy("host", "layout").agg(F.collect_list(F.when(F.col("fixed"), F.col("node"))).alias("nodes"), (F.max(~F.col("fixed")) & (F.max("pages") >= least)).alias("known"))
    found = by_node.join(by_text, ["host", "layout"], "left").withColumn("texts", F.coalesce("texts", F.array().cast("array<struct<node:int,text:bigint>>")))
    each = references.select("host", F.posexplode(F.from_json("references", "array<string>")).alias("layout", "reference")).join(found, ["host", "layout"], "left")
    said = F.struct("layout", "reference", F.coalesce("known", F.lit(False)).alias("known"), F.coalesce("nodes", F.array().cast("array<int>")).alias("nodes"), F.coalesce("texts", F.array().cast("array<struct<node:int,text:bigint>>")).alias("texts"))
    return stored(each.groupBy("host").agg(F.to_json(F.sort_array(F.collect_list(said))).alias("layouts")))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, a row per row of pages (page_id, url, html).

    Null and empty pages have an empty text, as have pages without a block outside what stands beside; pages without an
    address form a host of their own; repeated rows give repeated rows; other columns are not read.
    """
    rows = hosted(pages)
    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [_main(parse(p), *(_known(x) if x else ([], []))) for p, x in zip(strings(batch.column(2)), strings(batch.column(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], schema=kinds)

    full = rows.join(wrappers(rows), "host", "left").select("page_id", "url", "html", "layouts")
    return full.mapInArrow(texts, "page_id long, url string, text string, n_chars long")
