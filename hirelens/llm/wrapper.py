"""Main text of web pages by wrapper induction.

Pages of a host come from the same templates. The element trees of all its pages are
folded into a wrapper by simple tree matching: the largest set of nodes that two trees share in
order, from the root down. Every page of the host is then matched with the wrapper once and gives its
blocks of text, each with the wrapper node it sits in and whether it has the words that the wrapper
has there. Counted over all pages of the host, a node whose words stay the same is template; one
whose words vary is a slot, and slots are content unless their place says otherwise: inside a
navigation, header, footer, sidebar, form, script, or an element named as an advert, a notice, a
menu, comments and the like. Where a page marks its article, only what is inside counts.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import blocks, checkpoints, stored
from hirelens.operators.skew import lookup

NODES = 300  # nodes of a wrapper at most; what does not fit stays unmatched, which reads as a slot
CELLS = 40_000  # child pairs compared exactly; longer lists of children are matched in order
CONSTANT = 0.9  # share of a host's pages that agree on the words of a template node
SEEN = 5  # different pages that must have the node before it counts as template
HELD = 200_000  # wrapper nodes that a task holds at once
SHAPES = 1000  # shapes of folded trees that are remembered per wrapper
DEEP = 200  # open elements below which elements are not matched, only read

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option"}
SELF_CLOSING = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
ASIDE_TAGS = frozenset(
    "nav footer aside form script style noscript template head button select option textarea iframe "
    "object svg canvas menu dialog title".split()
)
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright disclaimer disqus footer gdpr header masthead menu modal nav "
    "navbar navigation newsletter notice notices pagination popup promo promoted promotion related "
    "recommended replies reply respond share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription tags toolbar topbar tracking widget widgets feedback".split()
)
NEUTRAL = frozenset(  # words that may stand beside one of these in a name
    "site page main top bottom left right global primary secondary block box bar area section list "
    "wrapper wrap container reader user panel links inner outer".split()
)
NEVER_ASIDE = frozenset("html body main article".split())  # whatever their names are
ASIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split()
)
TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|"""
    r"""<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>?|<(?:/?[a-zA-Z][^>]*)\Z""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


class Node:
    """An element: its label, its child elements, and the places of its blocks of text."""

    __slots__ = ("label", "tag", "children", "aside", "main", "blocks", "match", "shape", "path")

    def __init__(self, tag: str, label: str, aside: bool, main: bool, above: int = 0):
        self.tag, self.label, self.aside, self.main = tag, label, aside, main
        self.path = xxhash.xxh3_64_intdigest(label, above)  # the labels from the page down
        self.children: list[Node] = []
        self.blocks: list[int] = []
        self.match = -1
        self.shape: int | None = None


def attributes(source: str) -> dict[str, str]:
    return {
        m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(source)
    }


def names_aside(names: str) -> bool:
    """Whether one of the names in ``class`` or ``id`` is that of an aside, as a whole: ``site-footer`` is,
    ``has-sidebar`` or ``entry-header`` is not."""
    for name in names.split():
        words = {w for w in re.split(r"[^a-z]+", name) if w}
        if not ASIDE_NAMES.isdisjoint(words) and words <= ASIDE_NAMES | NEUTRAL:
            return True
    return False


def new_node(tag: str, source: str, parent: Node | None) -> Node:
    """A node; asides and main parts pass on to all below them."""
    found = attributes(source) if "=" in source else {}
    names = f"{found.get('class', '')} {found.get('id', '')}".lower()
    role = found.get("role", "").lower()
    inside = parent is not None and parent.main
    aside = (
        (parent is not None and parent.aside)
        or tag in ASIDE_TAGS
        or (tag == "header" and not inside)
        or (tag not in NEVER_ASIDE and names_aside(names))
        or role in ASIDE_ROLES
        or "hidden" in re.split(r"[\s/]+", ATTRIBUTE.sub("", source).lower())
    )
    main = inside or tag in ("article", "main") or role in ("main", "article")
    label = f"{tag}.{names.strip()}" if names.strip() else tag
    return Node(tag, label, aside, main, parent.path if parent else 0)


def parse(source: str | None) -> tuple[Node, list[str], list[Node]]:
    """Element tree, blocks of text in page order, and the element each block sits in.

    Lenient as browsers are: missing ends are implied, ends without a start are ignored, a page
    that breaks off is read as far as it goes.
    """
    root = Node("#page", "#page", False, False)
    stack, opened = [root], {"#page": 1}
    texts: list[str] = []
    owners: list[Node] = []
    run: list[str] = []

    def flush() -> None:
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            run.clear()
            if text:
                owner = next((n for n in reversed(stack) if n.tag in BLOCK or n.tag == "#page"))
                if stack[-1].aside:
                    owner = stack[-1]
                owner.blocks.append(len(texts))
                texts.append(text)
                owners.append(owner)

    def pop() -> None:
        opened[stack[-1].tag] -= 1
        stack.pop()

    def close(tag: str) -> None:
        if opened.get(tag):
            while stack[-1].tag != tag:
                pop()
            pop()

    at, end = 0, len(source or "")
    while at < end:
        m = TOKEN.search(source, at)
        if m is None:
            run.append(source[at:])
            break
        if m.start() > at:
            run.append(source[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, ends, rest = tag.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in BLOCK:
            flush()
        elif tag == "br":
            run.append(" ")
        if ends:
            if opened.get(tag):
                if stack[-1].aside or tag in ASIDE_TAGS:
                    flush()
                close(tag)
            continue
        if tag in CLOSES_P:
            close("p")
        if tag in SELF_CLOSING:
            closing, limits = SELF_CLOSING[tag]
            for n in range(len(stack) - 1, 0, -1):
                if stack[n].tag in limits:
                    break
                if stack[n].tag in closing:
                    while len(stack) > n:
                        pop()
                    break
        node = new_node(tag, rest, stack[-1])
        if node.aside != stack[-1].aside:
            flush()
        if len(stack) <= DEEP:
            stack[-1].children.append(node)
        if tag in VOID or rest.endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}[\s/>]", re.IGNORECASE).search(source, at)
            at = stop.start() if stop else end
            continue
        if len(stack) > 50 * DEEP:
            continue
        stack.append(node)
        opened[tag] = opened.get(tag, 0) + 1
    flush()
    return root, texts, owners


def shape(node) -> int:
    """A number for the labels of a tree, the same for equal trees within a process."""
    if node.shape is None:
        node.shape = hash((node.label, *map(shape, node.children)))
    return node.shape


def common(x, y, depth: int) -> int:
    """Matched nodes of two trees with equal root labels; remembered by the shapes of both."""
    if not (x.children and y.children):
        return 1
    key = shape(x), shape(y)
    if key not in _common:
        if len(_common) > 200_000:
            _common.clear()
        _common[key] = 1 + aligned(x.children, y.children, depth + 1)[0]
    return _common[key]


_common: dict[tuple[int, int], int] = {}


def aligned(a: list, b: list, depth: int = 0) -> tuple[int, list[tuple]]:
    """Simple tree matching of two lists of children: matched nodes, and the pairs among the lists."""
    if len(a) * len(b) > CELLS or depth > 60:
        pairs, j = [], 0
        for x in a:
            k = next((k for k in range(j, min(j + 50, len(b))) if b[k].label == x.label), None)
            if k is not None:
                pairs.append((x, b[k]))
                j = k + 1
        return len(pairs), pairs
    width = len(b) + 1
    score = [[0] * width for _ in range(len(a) + 1)]
    gains: dict[tuple[int, int], int] = {}
    for i, x in enumerate(a):
        above, row = score[i], score[i + 1]
        for j, y in enumerate(b):
            best = above[j + 1] if above[j + 1] >= row[j] else row[j]
            if x.label == y.label:
                gain = gains[i, j] = common(x, y, depth)
                if above[j] + gain > best:
                    best = above[j] + gain
            row[j + 1] = best
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if (i - 1, j - 1) in gains and score[i][j] == score[i - 1][j - 1] + gains[i - 1, j - 1]:
            i, j = i - 1, j - 1
            pairs.append((a[i], b[j]))
        elif score[i][j] == score[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return score[-1][-1], pairs[::-1]


class Slot:
    """A wrapper node: label, children, and the hash of the words it first had."""

    __slots__ = ("label", "children", "words", "place", "shape")

    def __init__(self, label: str, words: int):
        self.label, self.words = label, words
        self.children: list[Slot] = []
        self.place = -1
        self.shape: int | None = None


def words_of(node: Node, texts: list[str]) -> int:
    """Hash of the text that stands directly in a node, 0 for none."""
    own = "\n".join(texts[b] for b in node.blocks)
    return xxhash.xxh3_64_intdigest(own.encode()) >> 1 if own else 0


def walk(slot: Slot, node: Node, visit) -> None:
    """Match a page with a wrapper from the root down."""
    todo = [(slot, node)]
    while todo:
        s, n = todo.pop()
        pairs = aligned(s.children, n.children)[1]
        visit(s, n, pairs)
        todo.extend(pairs)


class Induction:
    """The wrapper of the pages of a host: its first page, and of each page after it what is new there."""

    __slots__ = ("root", "size", "tie", "folded")

    def __init__(self, tie: int = 0):
        self.root: Slot | None = None
        self.size, self.tie = 1, tie  # nodes; what orders this among others of the host
        self.folded: set[int] = set()  # shapes of trees that bring nothing new any more

    def add(self, tree: Node | Slot, words) -> bool:
        """Fold in the tree of a page, or another wrapper; ``words`` gives the hash of a node's own words.
        Whether it was the first with its labels."""
        if self.root is None:
            self.root = Slot(tree.label, words(tree))
            self.grow(self.root, tree, words)
        elif shape(tree) in self.folded:
            return False
        else:
            before = self.size
            walk(self.root, tree, lambda slot, node, pairs: self.insert(slot, node, pairs, words))
            if self.size > before:
                forget(self.root)
        if len(self.folded) >= SHAPES:
            self.folded.clear()
        self.folded.add(shape(tree))
        return True

    def grow(self, slot: Slot, node: Node | Slot, words) -> None:
        todo = [(slot, node)]
        while todo:
            s, n = todo.pop()
            for child in n.children:
                if self.size >= NODES:
                    return
                self.size += 1
                s.children.append(Slot(child.label, words(child)))
                todo.append((s.children[-1], child))

    def insert(self, slot: Slot, node: Node | Slot, pairs: list, words) -> None:
        met = {id(n): s for s, n in pairs}
        place = 0
        for child in node.children:
            if id(child) in met:
                place = slot.children.index(met[id(child)]) + 1
            elif self.size < NODES and not any(s.label == child.label for s in slot.children):
                self.size += 1
                fresh = Slot(child.label, words(child))
                slot.children.insert(place, fresh)
                place += 1
                self.grow(fresh, child, words)


def induce(pages: Iterable[str | None]) -> Slot:
    """The wrapper of some pages of a host."""
    made = Induction()
    for page in pages:
        tree, texts, _ = parse(page)
        made.add(tree, lambda node: words_of(node, texts))
    return made.root or Slot("#page", 0)


def forget(slot: Slot) -> None:
    """Shapes of a wrapper that has grown are worked out anew."""
    slot.shape = None
    for child in slot.children:
        forget(child)


def to_json(root: Slot) -> str:
    """A wrapper as nested ``[label, words, children]``."""
    return json.dumps(nested(root))


def nested(slot: Slot) -> list:
    return [slot.label, slot.words, [nested(c) for c in slot.children]]


def from_json(text: str) -> Slot:
    """A wrapper with its nodes numbered."""
    count = -1

    def read(item: list) -> Slot:
        nonlocal count
        slot = Slot(item[0], item[1])
        slot.place = count = count + 1
        slot.children = [read(c) for c in item[2]]
        return slot

    return read(json.loads(text))


def page_blocks(page: str | None, wrapper: Slot | None) -> list[dict]:
    """The blocks of a page that may be content: text, wrapper node (-1: none), same words as there, and
    hashes of the path of labels and of path and text.

    The main part stands for the page if it holds half of the text that is not aside.
    """
    tree, texts, owners = parse(page)
    same: dict[int, bool] = {}

    def visit(slot: Slot, node: Node, pairs: list) -> None:
        node.match = slot.place
        same[id(node)] = bool(slot.words) and slot.words == words_of(node, texts)

    if wrapper is not None:
        walk(wrapper, tree, visit)
    sizes = [0, 0]
    for text, owner in zip(texts, owners):
        if not owner.aside:
            sizes[owner.main] += len(text)
    has_main = sizes[True] > 0 and sizes[True] >= sizes[False]
    return [
        {
            "text": text,
            "node": owner.match,
            "same": same.get(id(owner), False),
            "path": owner.path - (1 << 63),
            "sign": xxhash.xxh3_64_intdigest(text, owner.path) - (1 << 63),
        }
        for text, owner in zip(texts, owners)
        if not owner.aside and (owner.main or not has_main)
    ]


def host_of(url: Column) -> Column:
    """Host of an address, in lower case; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(F.length(host) > 0, host)


def wrappers(rows: DataFrame) -> DataFrame:
    """``host, wrapper`` for rows of ``host, html, tie``, from all pages of each host.

    A task folds its pages where they are read, so no page is shuffled, and gives one wrapper per host,
    or more where the wrappers it holds get too many. Those of a host are folded into one in
    the order of the smallest hash of a page.
    """

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Induction] = {}

        def told() -> pa.RecordBatch:
            found = [(host, i.tie, to_json(i.root)) for host, i in held.items()]
            held.clear()
            columns = [list(c) for c in zip(*found)]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                names=["host", "tie", "wrapper"],
            )

        size = 0
        for block in blocks(batches, "html"):
            for host, html, tie in zip(*(block.column(c).to_pylist() for c in ("host", "html", "tie"))):
                made = held.setdefault(host, Induction(tie))
                before = made.size if made.root else 0
                tree, texts, _ = parse(html)
                made.add(tree, lambda node: words_of(node, texts))
                made.tie = min(made.tie, tie)
                size += made.size - before
                if size > HELD:
                    yield told()
                    size = 0
        if held:
            yield told()

    def fold(group: pa.Table) -> pa.Table:
        made = Induction()
        for text in group.sort_by([("tie", "ascending"), ("wrapper", "ascending")]).column("wrapper").to_pylist():
            made.add(from_json(text), lambda slot: slot.words)
        return pa.table({"host": [group.column("host")[0].as_py()], "wrapper": [to_json(made.root)]})

    hosted = rows.filter(F.col("host").isNotNull()).select("host", "html", "tie")
    parts = hosted.mapInArrow(part, "host string, tie bigint, wrapper string")
    return parts.groupBy("host").applyInArrow(fold, "host string, wrapper string")


def main_text(df: DataFrame, url: str, page: str, into: str = "_text") -> DataFrame:
    """All columns of ``df`` but the page, with the main text of each page behind them.

    Blocks are in page order, joined by line ends; character references are decoded and white space
    within a block is one space. A null or empty page, and one without content, gives an empty
    text. A page without a host is read on its own. Repeated rows come back repeated; they count
    once where pages of a host are counted.
    """
    checkpoints(df.sparkSession)
    others = [c for c in df.columns if c != page]  # kept as one column, so that no name clashes
    keyed = df.select(
        F.struct(*others).alias("_row"),
        F.col(page).cast("string").alias("_page"),
        host_of(F.col(url)).alias("_host"),
        F.xxhash64(F.coalesce(page, F.lit(""))).alias("_tie"),
    )
    rows = keyed.select(
        F.col("_host").alias("host"), F.coalesce("_page", F.lit("")).alias("html"), F.col("_tie").alias("tie")
    )
    sizes = rows.groupBy("host").agg(F.count(F.lit(1)).alias("_n"))
    induced = stored(wrappers(rows).join(sizes, "host").toDF("_host", "_wrapper", "_n"), "wrappers")
    joined = lookup(keyed, induced, "_host", "_n")
    shape = T.ArrayType(
        T.StructType(
            [
                T.StructField("text", T.StringType()),
                T.StructField("node", T.IntegerType()),
                T.StructField("same", T.BooleanType()),
                T.StructField("path", T.LongType()),
                T.StructField("sign", T.LongType()),
            ]
        )
    )

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Slot] = {}
        wire = pa.list_(
            pa.struct(
                [("text", pa.string()), ("node", pa.int32()), ("same", pa.bool_()), ("path", pa.int64()), ("sign", pa.int64())]
            )
        )
        for block in blocks(batches, "_page"):
            found = []
            for source, wrapper in zip(*(block.column(c).to_pylist() for c in ("_page", "_wrapper"))):
                if wrapper is not None and wrapper not in known:
                    if len(known) >= 200:
                        known.clear()
                    known[wrapper] = from_json(wrapper)
                found.append(page_blocks(source, known.get(wrapper)))
            out = block.drop_columns(["_page", "_wrapper"])
            yield from out.append_column("_blocks", pa.array(found, wire)).to_batches()

    fields = [f for f in keyed.schema.fields if f.name != "_page"]
    schema = T.StructType([*fields, T.StructField("_blocks", shape)])
    matched = stored(joined.drop("_n").mapInArrow(read, schema), "blocks")
    template = template_nodes(matched)
    marked = lookup(matched, template, "_host", "_n")
    content = F.filter(
        "_blocks",
        lambda b: ~(b["same"] & F.coalesce(F.array_contains("_nodes", b["node"]), F.lit(False)))
        & ~F.coalesce(F.array_contains("_signs", b["sign"]), F.lit(False)),
    )
    text = F.array_join(F.transform(content, lambda b: b["text"]), "\n")
    return marked.select(*[F.col("_row")[c].alias(c) for c in others], text.alias(into))


def template_nodes(matched: DataFrame) -> DataFrame:
    """``_host, _nodes, _signs, _n``: what stays the same, counted over all different pages of a host.

    ``_nodes`` are wrapper nodes with the same words on most pages that have them. ``_signs`` are texts
    that most pages with their path of labels have there, whether the wrapper has the path or not:
    a path that only some pages have is judged on these.
    """
    hosted = matched.filter(F.col("_host").isNotNull())
    pages = hosted.groupBy("_host").agg(F.count(F.lit(1)).alias("_n"))
    found = hosted.select("_host", "_tie", F.explode("_blocks").alias("b"))
    seen = (
        found.filter("b.node >= 0")
        .groupBy("_host", "_tie", F.col("b.node").alias("node"))
        .agg(F.max(F.col("b.same").cast("int")).alias("same"))
    )
    counted = seen.groupBy("_host", "node").agg(
        F.count(F.lit(1)).alias("n"), F.sum("same").alias("same")
    )
    nodes = (
        counted.filter((F.col("n") >= SEEN) & (F.col("same") >= CONSTANT * F.col("n")))
        .groupBy("_host")
        .agg(F.collect_set("node").alias("_nodes"))
    )
    placed = found.select("_host", "_tie", "b.path", "b.sign").distinct()
    texts = placed.groupBy("_host", "path", "sign").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= SEEN)
    paths = placed.select("_host", "_tie", "path").distinct().groupBy("_host", "path").agg(F.count(F.lit(1)).alias("of"))
    signs = (
        texts.join(paths, ["_host", "path"])
        .filter(F.col("n") >= CONSTANT * F.col("of"))
        .groupBy("_host")
        .agg(F.collect_set("sign").alias("_signs"))
    )
    return pages.join(nodes, "_host", "left").join(signs, "_host", "left").filter(
        "_nodes is not null or _signs is not null"
    )
