"""Files that hold one JSON array, read by many tasks.

The engine's own reader gives such a file to one task. Here it is read as text that ends at closing
braces, which splits by byte ranges wherever they fall. Whether a range begins within a string, and
how deep in the array, follows from the ranges before it: a first pass counts quotes and brackets of
each range, once for either case, and sums of these give the state at every border. A second pass
cuts the records out. Those that lie across a border come in pieces, which are put together by file.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

ESCAPED = re.compile(r"\\.", re.DOTALL)
BLANK = " \t\r\n\ufeff"
BETWEEN = BLANK + ","  # what may stand between two records
RANGE = "file string, start bigint, parity int, outer bigint, inner bigint, bytes bigint, size bigint, first string"


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, size, value``: the text of each byte range of each file, cut behind every ``}``."""
    lines = spark.read.option("lineSep", "}").option("pathGlobFilter", "*.json").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"),
        "value",
    )


def by_range(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, int, list[str], bool]]:
    """``file, start, size, texts, more`` of successive parts of ranges; ``more``: the part before was of the same."""
    before = None
    for batch in batches:
        starts = batch.column("start").to_pylist()
        files = batch.column("file").to_pylist()
        sizes = batch.column("size").to_pylist()
        values = batch.column("value").to_pylist()
        row = 0
        while row < len(starts):
            here, end = (files[row], starts[row]), row + 1
            while end < len(starts) and starts[end] == here[1] and files[end] == here[0]:
                end += 1
            yield *here, sizes[row], values[row:end], here == before
            before, row = here, end


def count(text: str) -> tuple[int, int, int]:
    """Unescaped quotes of a text, and by how much it goes deeper if it begins outside or inside a string."""
    if "\\" in text:
        text = ESCAPED.sub("", text)
    parts = text.split('"')
    depths = []
    for side in (parts[0::2], parts[1::2]):
        plain = "".join(side)
        depths.append(plain.count("{") + plain.count("[") - plain.count("}") - plain.count("]"))
    return len(parts) - 1, depths[0], depths[1]


def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each byte range does to quotes and depth, and how many bytes it has with all braces."""
    found: list[list] = []
    for file, start, size, texts, more in by_range(batches):
        whole = "}".join([*texts, ""])
        quotes, outer, inner = count(whole)
        first = whole.lstrip(BLANK)[:1]
        if more:
            last = found[-1]
            if last[2]:
                outer, inner = inner, outer
            found[-1] = [
                file, start, (last[2] + quotes) % 2, last[3] + outer, last[4] + inner,
                last[5] + len(whole.encode()), size, last[7] or first,
            ]
        else:
            found.append([file, start, quotes % 2, outer, inner, len(whole.encode()), size, first])
    names = [part.split()[0] for part in RANGE.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.string()]
    columns = list(zip(*found)) or [[]] * len(names)
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def border_states(text: DataFrame) -> dict[tuple[str, int], tuple[bool, int, int, bool]]:
    """For each range: whether it begins in a string, how deep, how deep records lie, and whether the
    text of the file goes on behind its last brace.

    One entry per byte range, as many as the scan has splits, which the driver holds anyway.
    """
    ranges = text.mapInArrow(measure, RANGE)
    states, file, inside, depth, base, total = {}, None, 0, 0, 0, 0
    for r in sorted(ranges.collect(), key=lambda r: (r["file"], r["start"])):
        if r["file"] != file:
            file, inside, depth, total = r["file"], 0, 0, 0
            base = 1 if r["first"] in ("[", "]") else 0
        total += r["bytes"]
        # a last text without a brace behind it makes the sum one more than the file
        states[file, r["start"]] = (bool(inside), depth, base, total > r["size"])
        depth += r["inner"] if inside else r["outer"]
        inside ^= r["parity"]
    return states


PIECE = "file string, start bigint, place int, ends boolean, text string"


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, text``: the elements of the arrays in the JSON files of ``path``, as they stand there.

    A file that holds a single object gives that. What is left over, such as a record that the file
    breaks off in, is a row too, so that a parser can report it; white space is not. Elements that
    are no objects come together with the next object.
    """
    text = read_text(spark, path)
    states = border_states(text)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held: list[str] = []  # texts of a record that has not ended
        here, whole, last = None, True, None

        def close() -> None:
            """Hand on what is left of a range: the begin of a record that goes on behind it."""
            if here is not None:
                left = "}".join([*held, last if last is not None else ""])
                rows.append((*here, 1 if whole else 0, False, left))

        for file, start, _, texts, more in by_range(batches):
            if not more:
                close()
                here, held, last = (file, start), [], None
                inside, depth, base, unclosed = states[here]
                whole = not inside and depth <= base  # begins between records
            if unclosed:  # the last text of the range has no brace behind it: hold it back
                texts = texts if last is None else [last, *texts]
                texts, last = texts[:-1], texts[-1]
            for text in texts:
                quotes, outer, inner = count(text + "}")
                depth += inner if inside else outer
                inside ^= bool(quotes % 2)
                held.append(text)
                if not inside and depth <= base:
                    rows.append((*here, 1 if whole else 0, True, "}".join([*held, ""])))
                    held, whole = [], True
            if len(rows) > 2_000:
                yield pieces(rows)
                rows.clear()
        close()
        yield pieces(rows)

    found = text.mapInArrow(cut, PIECE)
    # a record within one range is whole (place 1, ends); the others are ordered pieces
    inside = found.filter("place = 1 and ends").select("file", "text")
    torn = found.filter("not (place = 1 and ends)")
    begins = F.sum("place").over(Window.partitionBy("file").orderBy("start", "place"))
    numbered = torn.select("*", begins.alias("record"))
    ordered = F.sort_array(F.collect_list(F.struct("start", "place", "text")))
    joined = numbered.groupBy("file", "record").agg(ordered.alias("parts")).select(
        "file", F.array_join(F.col("parts.text"), "").alias("text")
    )
    element = F.btrim("text", F.lit(BETWEEN))
    element = F.when(element.startswith("["), F.ltrim(F.substring(element, 2, 2**31 - 1), F.lit(BETWEEN))).otherwise(
        element
    )
    rows = inside.unionAll(joined).select("file", element.alias("text"))
    return rows.filter("text not in ('', ']')")


def pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    columns = list(zip(*rows)) or [[]] * len(kinds)
    names = [part.split()[0] for part in PIECE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def read_arrays(spark: SparkSession, path: str, schema: T.StructType, corrupt: str) -> DataFrame:
    """``file`` and the columns of ``schema``; a record that is no JSON has its text in ``corrupt``."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    parsed = F.from_json("text", with_corrupt, options)
    return records(spark, path).select("file", parsed.alias("record")).select("file", "record.*")
