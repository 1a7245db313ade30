"""Fill-in-middle transformation: texts cut at two units into prefix, middle and suffix, reordered.

The units of a text (lines) stand in an indexable skip list. Each link of each lane carries how many
units and how many code points it passes over; going down from the widest lane and adding these up
reaches the place of any unit exactly, in steps that grow with the logarithm of the number of units.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import blocks

FORMS = ("plain", "psm", "spm")


class SkipList:
    """Units in order, by their widths in code points.

    A lane is a row of links; a link is ``(units, width, below)``: how many units and code points it
    passes over, and which link of the lane below starts where it starts. The lowest lane has one
    link per unit; of every lane about half of the nodes, picked by a fixed mixing of their place,
    stand in the next.
    """

    def __init__(self, widths: Iterable[int]):
        links = [(1, width, -1) for width in widths]
        self.units = len(links)
        self.width = sum(link[1] for link in links)
        self.lanes = [links]
        height = 0
        while len(links) > 2:
            above, start, units, width, place = [], 0, 0, 0, 0
            for i, link in enumerate(links):
                if i and mixed(place) >> height & 1:
                    above.append((units, width, start))
                    start, units, width = i, 0, 0
                units += link[0]
                width += link[1]
                place += link[0]
            above.append((units, width, start))
            height += 1
            if len(above) < len(links):
                self.lanes.append(above)
                links = above
            elif height > 60:
                break

    def offset(self, rank: int) -> int:
        """Code points in front of the unit with this rank; the whole width for one past the last."""
        if not 0 <= rank <= self.units:
            raise IndexError(rank)
        at = passed = points = 0
        for depth in range(len(self.lanes) - 1, -1, -1):
            lane = self.lanes[depth]
            while at < len(lane) and passed + lane[at][0] <= rank:
                passed += lane[at][0]
                points += lane[at][1]
                at += 1
            if passed == rank:
                return points
            at = lane[at][2]
        return points


def mixed(place: int) -> int:
    """Bits of a place in a text, evenly spread: the coin flips of the skip list, the same every time."""
    place = (place ^ place >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
    return (place ^ place >> 27) * 0x94D049BB133111EB % (1 << 64) >> 3


def line_widths(text: str) -> list[int]:
    """Code points of each line, its line feed included; what follows the last one is a line too."""
    lines = text.split("\n")
    return [len(line) + 1 for line in lines[:-1]] + ([len(lines[-1])] if lines[-1] else [])


@dataclass(frozen=True)
class Sentinels:
    """The marks in front of the three parts.

    No mark may overlap itself or another one: then a text without marks has, once transformed, each
    of them in one place only, and the parts can be told apart again.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        for i, a in enumerate(self.all()):
            for j, b in enumerate(self.all()):
                longest = min(len(a), len(b)) - (i == j)
                overlap = any(a[-n:] == b[:n] for n in range(1, longest + 1))
                if not a or overlap or (i != j and a in b):
                    raise ValueError("sentinels must not overlap")

    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


@dataclass(frozen=True)
class Draw:
    """What is drawn for a key: four numbers out of the hash of seed and key, and how they are used.

    ``rate`` of 100 texts are transformed, ``spm`` of 100 of these get the suffix in front.
    """

    seed: int = 7
    rate: int = 100
    spm: int = 50

    def numbers(self, key: object) -> tuple[int, int, int, int]:
        """A null key counts as an empty one."""
        digest = hashlib.sha256(f"{self.seed}:{'' if key is None else key}".encode()).digest()
        return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def transform(
    text: str, key: object, draw: Draw, marks: Sentinels, widths: Sequence[int] | None = None
) -> tuple[str, str, int, int | None, int | None]:
    """``output, form, units, prefix and middle in code points`` of one text."""
    units = SkipList(line_widths(text) if widths is None else widths)
    h1, h2, h3, h4 = draw.numbers(key)
    if not text or any(mark in text for mark in marks.all()) or h3 % 100 >= draw.rate:
        return text, "plain", units.units, None, None
    first, second = sorted((h1 % (units.units + 1), h2 % (units.units + 1)))
    a, b = units.offset(first), units.offset(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < draw.spm:
        output = marks.suffix + suffix + marks.prefix + prefix + marks.middle + middle
        return output, "spm", units.units, a, b - a
    output = marks.prefix + prefix + marks.suffix + suffix + marks.middle + middle
    return output, "psm", units.units, a, b - a


def restore(output: str, form: str, marks: Sentinels) -> str:
    """The text an output was made of."""
    if form == "plain":
        return output
    ahead, behind = (marks.prefix, marks.suffix) if form == "psm" else (marks.suffix, marks.prefix)
    if form not in FORMS or not output.startswith(ahead):
        raise ValueError(f"not an output of form {form}")
    first, rest = output[len(ahead) :].split(behind)
    second, middle = rest.split(marks.middle)
    prefix, suffix = (first, second) if form == "psm" else (second, first)
    return prefix + middle + suffix


OUTPUT = "key string, output string, form string, n long, prefix_chars long, middle_chars long"


def fill_in_middle(
    df: DataFrame, key: str, text: str, draw: Draw = Draw(), marks: Sentinels = Sentinels()
) -> DataFrame:
    """``key, output, form, n, prefix_chars, middle_chars`` for every row of ``df``.

    Null texts count as empty. Texts that are empty, hold a mark or are not drawn stay as they are
    (``plain``, no widths). Repeated rows come back repeated, other columns do not matter.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            keys, texts = block.column("name").to_pylist(), block.column("text").to_pylist()
            rows = [transform(t or "", k, draw, marks) for k, t in zip(keys, texts)]
            out = block.select(["key"])
            names = ("output", "form", "n", "prefix_chars", "middle_chars")
            types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            for name, kind_of, values in zip(names, types, zip(*rows)):
                out = out.append_column(name, pa.array(values, kind_of))
            yield from out.to_batches()

    rows = df.select(
        F.col(key).alias("key"),
        F.col(key).cast("string").alias("name"),
        F.col(text).cast("string").alias("text"),
    )
    return rows.mapInArrow(run, OUTPUT.replace("key string", f"key {kind}"))


def restored(df: DataFrame, marks: Sentinels = Sentinels()) -> DataFrame:
    """The rows of ``fill_in_middle`` with the text rebuilt from ``output`` and ``form`` as ``restored``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "output"):
            both = zip(block.column("output").to_pylist(), block.column("form").to_pylist())
            texts = pa.array([restore(o, f, marks) for o, f in both], pa.string())
            yield from block.append_column("restored", texts).to_batches()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{schema}, restored string")


ORACLE = """
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS lines
    FROM documents
), drawn AS (
    SELECT doc_id, text, lines, len(lines) AS n,
        ('0x' || h[1:8])::BIGINT % (len(lines) + 1) AS one, ('0x' || h[9:16])::BIGINT % (len(lines) + 1) AS two,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
            WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
), parts AS (
    SELECT doc_id, text, n, form,
        array_to_string(lines[1:least(one, two)], '') AS prefix,
        array_to_string(lines[least(one, two) + 1:greatest(one, two)], '') AS middle,
        array_to_string(lines[greatest(one, two) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""
