"""Pages to element tables.

``parse_pages`` is the library's only Python stage. It writes, per page, the text pieces once and
one small index row per element that points into them, so its output is linear in the page size
however deep elements nest. All selection work happens afterwards in Spark expressions.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The reader goes to the workers inside the task, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# FIXED VALUES of HTML: tags without content; tags whose text is not page text; tags in which
# blank text is kept as it is
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
HIDDEN_TAGS = frozenset("script style template rt rp".split())
PREFORMATTED_TAGS = frozenset("pre textarea".split())

ELEMENT = T.StructType(
    [
        T.StructField("ord", T.IntegerType()),  # position in document order
        T.StructField("parent", T.IntegerType()),  # ord of the parent, -1 at the top
        T.StructField("at", T.IntegerType()),  # position among the kept elements, from 0
        T.StructField("below", T.IntegerType()),  # kept descendants; they follow the element
        T.StructField("follower", T.IntegerType()),  # position of a sibling, see parse_pages
        T.StructField("tag", T.StringType()),
        T.StructField("cls", T.StringType()),  # class attribute, single spaces
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("piece", T.IntegerType()),  # first text piece, from 0
        T.StructField("pieces", T.IntegerType()),  # number of text pieces
        T.StructField("chars", T.IntegerType()),  # characters in these pieces
        T.StructField("start", T.IntegerType()),  # offset in the page's markup, from 0
        T.StructField("length", T.IntegerType()),
        T.StructField("raw", T.StringType()),  # content of a script
    ]
)
_ARROW_ELEMENT = pa.struct(
    [
        pa.field(f.name, {"integer": pa.int32(), "string": pa.string()}.get(
            f.dataType.typeName(), pa.map_(pa.string(), pa.string())))
        for f in ELEMENT
    ]
)
_FLUSH_CHARS = 1_000_000  # output rows are sent on after this much page text


class _PageReader(HTMLParser):
    """Collects the elements, text pieces and normalised markup of one page.

    An end tag closes everything up to the nearest open tag of its name and is ignored without
    one; nothing else is closed implicitly, so an unclosed ``<p>`` holds what follows.
    """

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.elements: list[dict] = []
        self.pieces: list[str] = []
        self.chars = 0
        self._open: list[dict] = []
        self._counts: Counter[str] = Counter()  # open elements by tag
        self._hidden = 0
        self._preformatted = 0
        self._text: list[str] = []
        self._markup: list[str] = []
        self._size = 0

    def read(self, page: str) -> None:
        self.feed(page)
        self.close()
        self._end_text()
        while self._open:
            self._close_top()

    @property
    def markup(self) -> str:
        return "".join(self._markup)

    # --- parser events ---------------------------------------------------------------------

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs)
        if tag in VOID_TAGS:
            self._close_top()

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs)
        self._close_top()

    def handle_endtag(self, tag):
        self._end_text()
        if self._counts[tag]:
            while self._close_top() != tag:
                pass

    def handle_data(self, data):
        self._text.append(data)

    def handle_entityref(self, name):
        self._text.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        code = int(name[1:], 16) if name[:1] in "xX" else int(name)
        try:
            char = bytes([code]).decode("windows-1252") if code < 256 else chr(code)
            char.encode("utf-8")
        except (ValueError, OverflowError):
            char = "�"
        self._text.append(char)

    def handle_comment(self, data):
        self._end_text()
        self._write(f"<!--{data}-->")

    def handle_decl(self, decl):
        self._end_text()
        self._write(f"<!{decl}>\n")

    def handle_pi(self, data):
        self._end_text()
        self._write(f"<?{data}>")

    def unknown_decl(self, data):
        self._end_text()
        if data.upper().startswith("CDATA["):
            self._piece(data[6:])
        self._write(f"<![{data}]]>")

    # --- building --------------------------------------------------------------------------

    def _start(self, tag, attrs):
        self._end_text()
        values = {name: value or "" for name, value in attrs}
        if "class" in values:
            values["class"] = " ".join(values["class"].split())
        element = {
            "ord": len(self.elements),
            "parent": self._open[-1]["ord"] if self._open else -1,
            "tag": tag,
            "cls": values.get("class"),
            "attrs": values,
            "piece": len(self.pieces),
            "chars": self.chars,
            "start": self._size,
            "raw": None,
        }
        self.elements.append(element)
        self._open.append(element)
        self._counts[tag] += 1
        self._hidden += tag in HIDDEN_TAGS
        self._preformatted += tag in PREFORMATTED_TAGS
        written = "".join(f" {name}={_quoted(value)}" for name, value in values.items())
        self._write(f"<{tag}{written}{'/' if tag in VOID_TAGS else ''}>")

    def _close_top(self) -> str:
        element = self._open.pop()
        tag = element["tag"]
        if tag not in VOID_TAGS:
            self._write(f"</{tag}>")
        self._counts[tag] -= 1
        self._hidden -= tag in HIDDEN_TAGS
        self._preformatted -= tag in PREFORMATTED_TAGS
        element["last"] = len(self.elements) - 1
        element["pieces"] = len(self.pieces) - element["piece"]
        element["chars"] = self.chars - element["chars"]
        element["length"] = self._size - element["start"]
        return tag

    def _end_text(self):
        if not self._text:
            return
        data = "".join(self._text)
        self._text = []
        top = self._open[-1]["tag"] if self._open else ""
        if top in ("script", "style"):
            self._open[-1]["raw"] = (self._open[-1]["raw"] or "") + data
            self._write(data)
            return
        if not data.strip(" \t\n\r\x0c") and not self._preformatted:
            data = "\n" if "\n" in data else " "
        self._write(_escaped(data))
        self._piece(data)

    def _piece(self, data: str):
        piece = data.strip()
        if piece and not self._hidden:
            self.pieces.append(piece)
            self.chars += len(piece)

    def _write(self, markup: str):
        self._markup.append(markup)
        self._size += len(markup)


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _quoted(value: str) -> str:
    value = _escaped(value)
    if '"' not in value:
        return f'"{value}"'
    return f"'{value}'" if "'" not in value else '"' + value.replace('"', "&quot;") + '"'


def parse_pages(
    pages: DataFrame,
    keys: Sequence[str] = ("page_id",),
    html: str = "html",
    tags: Sequence[str] | None = None,
    attrs: Sequence[str] | None = None,
    bare_tags: Sequence[str] = (),
    markup: bool = True,
    followers: Mapping[str, str] | None = None,
) -> DataFrame:
    """``keys`` plus ``pieces array<string>, elements array<ELEMENT>, markup string``.

    Only ``keys`` and the page go to Python. What comes back can be limited to what the selectors
    need: elements of ``tags`` that have a class or one of ``attrs``, and those of ``bare_tags`` in
    any case. ``markup=False`` leaves the page source out. A null page gives null columns.

    ``followers`` maps a tag to another one: elements of the first have in ``follower`` where the next
    element of the second under the same parent stands among the kept elements, -1 if nowhere.
    """
    keys = list(keys)
    schema = T.StructType(
        [pages.schema[k] for k in keys]
        + [
            T.StructField("pieces", T.ArrayType(T.StringType())),
            T.StructField("elements", T.ArrayType(ELEMENT)),
            T.StructField("markup", T.StringType()),
        ]
    )
    wanted_tags = None if tags is None else frozenset(tags)
    wanted_attrs = None if attrs is None else frozenset(attrs)
    bare = frozenset(bare_tags)
    sought = dict(followers or {})

    def keep(element) -> bool:
        if wanted_tags is None:
            return True
        return element["tag"] in bare or (
            element["tag"] in wanted_tags
            and (element["cls"] is not None or not wanted_attrs.isdisjoint(element["attrs"]))
        )

    def kept_attrs(element) -> list[tuple[str, str]]:
        found = element["attrs"].items()
        if wanted_attrs is None:
            return list(found)
        return [(k, v) for k, v in found if k in wanted_attrs]

    def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, out = 0, 0, []
            for i, page in enumerate(batch.column(len(keys))):
                text = page.as_py()
                found = None
                if text is not None:
                    found = read_page(text)
                    held += len(text)
                out.append(found)
                if held >= _FLUSH_CHARS:
                    yield assemble(batch, first, out)
                    first, held, out = i + 1, 0, []
            if out:
                yield assemble(batch, first, out)
            del batch, out
            pa.default_memory_pool().release_unused()  # the worker is kept for other batches and tasks

    def read_page(text: str) -> tuple[list[str], list[dict], str | None]:
        """What is sent on of a page, so that nothing else of it is held."""
        reader = _PageReader()
        reader.read(text)
        return reader.pieces, kept_elements(reader), reader.markup if markup else None

    def kept_elements(reader) -> list[dict]:
        """Kept elements with their places; one pass over them in each direction."""
        kept = [e for e in reader.elements if keep(e)]
        ords = [e["ord"] for e in kept]
        next_of: dict[tuple[int, str], int] = {}
        for at in range(len(kept) - 1, -1, -1):
            e = kept[at]
            e["at"] = at
            e["below"] = bisect_right(ords, e["last"]) - at - 1
            e["follower"] = next_of.get((e["parent"], sought.get(e["tag"], "")), -1)
            next_of[e["parent"], e["tag"]] = at
        return kept

    def lists(found, part, to_array) -> pa.Array:
        """One list per page (null for a null page) over flat values."""
        offsets, flat = [], []
        for page in found:
            offsets.append(None if page is None else len(flat))
            if page is not None:
                flat.extend(page[part])
        offsets.append(len(flat))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), to_array(flat))

    def element_array(rows) -> pa.Array:
        columns = []
        for f in _ARROW_ELEMENT:
            values = [kept_attrs(e) for e in rows] if f.name == "attrs" else [e[f.name] for e in rows]
            columns.append(pa.array(values, f.type))
        return pa.StructArray.from_arrays(columns, fields=list(_ARROW_ELEMENT))

    def assemble(batch, first, found):
        columns = [batch.column(k).slice(first, len(found)) for k in range(len(keys))]
        columns.append(lists(found, 0, lambda flat: pa.array(flat, pa.string())))
        columns.append(lists(found, 1, element_array))
        columns.append(pa.array([page and page[2] for page in found], pa.string()))
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return pages.select(*keys, html).mapInArrow(read_batches, schema)


def element_text(element: Column, pieces: Column, separator: str = "") -> Column:
    """Text of an element: its stripped pieces, joined."""
    taken = F.slice(pieces, element["piece"] + 1, element["pieces"])
    return F.when(element.isNotNull(), F.array_join(taken, separator))


def element_markup(element: Column, markup: Column) -> Column:
    return F.substring(markup, element["start"] + 1, element["length"])


def html_elements(pages: DataFrame, keys: Sequence[str] = ("page_id",), **options) -> DataFrame:
    """The whole tree as rows: one per element, in document order within its page."""
    e = F.col("e")
    return (
        parse_pages(pages, keys, **options)
        .select(*keys, "pieces", "markup", F.explode("elements").alias("e"))
        .select(
            *keys,
            e["ord"].alias("node"),
            e["parent"].alias("parent"),
            e["tag"].alias("tag"),
            e["attrs"].alias("attrs"),
            element_text(e, F.col("pieces")).alias("text"),
            element_markup(e, F.col("markup")).alias("outer_html"),
        )
    )
