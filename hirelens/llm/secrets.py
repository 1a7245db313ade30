"""Secrets in texts: three fixed patterns, and the novelty of other strings to a primed compressor.

The novelty of a candidate is the number of bytes that it adds to a zstandard stream which has a
dictionary of code identifiers and the text around the candidate as its history. Names, words and
anything the surroundings repeat cost little; a random string costs about its length. Candidates
are strings of letters and digits behind a word that announces a secret; those that do not compress
are reported. The announcement holds for whatever follows such a string with only separators between
(the entries of a list, the lines of a key), and for all of a block between BEGIN and END ... KEY.
Other copies of the candidate itself are not history.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import blocks

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGNED = 12  # characters of an assigned value, at least

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=~-]{16,}")
SENSITIVE = re.compile(
    r"pass|pwd|secret|token|key|credential|auth|bearer|session|cookie|signature|salt|license|connection",
    re.IGNORECASE | re.ASCII,
)
REACH = 48  # characters before a candidate, and the separators it stands behind, that may announce it
SENTENCE = re.compile(r"\n|[.!?]\s")  # behind it an announcement further off no longer holds
SEPARATORS = re.compile(r"""[\s"'`,;\\\[\](){}]*""")  # between the parts of one secret or list
KEY_BLOCK = re.compile(r"-{4,}\x20?(BEGIN|END)\x20[A-Z0-9\x20]{0,40}KEY(?:\x20BLOCK)?\x20?-{4,}", re.ASCII)
REST = re.compile(r"\s*([A-Za-z0-9+/=]+)\s*")  # the last line of a key, however short
AROUND = 1024  # characters on each side that are the compressor's history
NOVELTY = 0.95  # added bytes per byte that random characters of the candidate's alphabet need, at least
MOST = 0.75  # added bytes per character that are always enough
ALPHABETS = [  # characters and how many bits a random one of them has; the first that fits counts
    (re.compile("[0-9A-F]+|[0-9a-f]+"), 4.0),
    (re.compile("[0-9A-Fa-f]+"), 4.46),
    (re.compile("[A-Z2-7=]+"), 5.0),
    (re.compile("[A-Z0-9]+|[a-z0-9]+"), 5.17),
    (re.compile("[A-Za-z0-9]+"), 5.95),
    (re.compile("[A-Za-z0-9+/_=~-]+"), 6.0),
]
DOTTED = 6.4  # bits of a character of a string with dots, such as a name of a host
IDENTIFIERS = (
    b"import from return class function public private static const string number boolean value "
    b"config settings environment localhost https://www.example.com/index.html application/json "
    b"username password passphrase secret token access_key private_key api_key client_secret bearer "
    b"authorization credential session cookie signature connection license "
    b"get_ set_ _id _name _path _file _type _list _count _size _index user_ data_ model_ test_ "
    b"request response handler manager service controller repository factory builder "
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 9876543210 1234567890 00000000"
)

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns; the longer patterns of two of them only skip what is too short."""
    spans = [
        ("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGNED
    ]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return spans + [("hex", *m.span()) for m in HEX.finditer(text)]


def added_bytes(value: bytes, history: bytes) -> int:
    """Bytes that ``value`` adds to a stream primed with the identifiers and ``history``."""
    primed = zstandard.ZstdCompressionDict(
        IDENTIFIERS + history, dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    compressor = zstandard.ZstdCompressor(
        level=19,
        dict_data=primed,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )
    return len(compressor.compress(value)) - len(compressor.compress(b""))


def key_blocks(text: str) -> list[tuple[int, int]]:
    """What stands between BEGIN and END ... KEY, by start."""
    found, opened = [], -1
    for m in KEY_BLOCK.finditer(text):
        if m[1] == "BEGIN":
            opened = m.end()
        elif opened >= 0:
            found.append((opened, m.start()))
            opened = -1
    return found


def enough(value: str) -> float:
    """Bytes that a random string with the characters of ``value`` adds at least."""
    bits = next((bits for pattern, bits in ALPHABETS if pattern.fullmatch(value)), DOTTED)
    return min(MOST, NOVELTY * bits / 8) * len(value)


class Before:
    """The last of some matches that ends in front of a place; places are asked for in order."""

    def __init__(self, pattern: re.Pattern, text: str):
        self.left = pattern.finditer(text)
        self.next = next(self.left, None)
        self.start = self.end = -1

    def move(self, place: int) -> None:
        while self.next is not None and self.next.end() <= place:
            self.start, self.end = self.next.span()
            self.next = next(self.left, None)


def announced(text: str, start: int, word: Before, sentence: Before) -> bool:
    """Whether a sensitive word stands in front of a place, in its sentence or line, or shortly before
    it or the separators in front of it."""
    word.move(start)
    sentence.move(start)
    if word.start < 0:
        return False
    if word.start >= sentence.end or word.start >= start - REACH:
        return True
    before = start
    while before > word.end and not text[before - 1].isalnum():
        before -= 1
    return word.start >= before - REACH


def novel_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Incompressible strings in a sensitive context that touch no base span, but for runs of hex digits
    that make up less than half of the string.

    Candidates, base spans, announcements and key blocks are walked side by side, in order of place.
    """
    found = []
    blocks_left = key_blocks(text)[::-1]
    ends = sorted((e for kind, _, e in base if kind != "hex"), reverse=True)
    spans = sorted(((s, e) for kind, s, e in base if kind != "hex"), reverse=True)
    runs = sorted(((s, e) for kind, s, e in base if kind == "hex"), reverse=True)
    covered = 0  # end of the spans of other kinds that begin in front of the candidate's end
    word, sentence = Before(SENSITIVE, text), Before(SENTENCE, text)
    last = -1  # end of the last string in context: what follows it directly is in context too
    for m in CANDIDATE.finditer(text):
        value, (start, end) = m[0], m.span()
        while blocks_left and blocks_left[-1][1] <= start:
            blocks_left.pop()
        while ends and ends[-1] <= start:
            last = max(last, ends.pop())
        while spans and spans[-1][0] < end:
            covered = max(covered, spans.pop()[1])
        digits = 0  # runs of hex digits do not overlap each other and lie within one candidate
        while runs and runs[-1][0] < end:
            run = runs.pop()
            digits += max(0, run[1] - max(run[0], start))
        if not (re.search("[0-9]", value) and re.search("[A-Za-z]", value)) or text[start - 1 : start] == "@":
            continue  # words, numbers, hosts of addresses
        block = blocks_left[-1] if blocks_left and blocks_left[-1][0] <= start else None
        follows = last >= 0 and SEPARATORS.fullmatch(text, last, start)
        last = -1
        if not (block or follows or announced(text, start, word, sentence)):
            continue
        last = end
        if covered > start or 2 * digits >= end - start:
            continue
        history = text[max(0, start - AROUND) : start] + text[end : end + AROUND]
        cost = added_bytes(value.encode(), history.replace(value, "").encode())
        if cost >= enough(value):
            found.append(("novel", start, end))
            rest = block and REST.fullmatch(text, end, block[1])
            if rest and not CANDIDATE.fullmatch(rest[1]):
                found.append(("novel", *rest.span(1)))
    return found


def secret_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a whole text, by start and then kind; places are code points, ends exclusive."""
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + novel_spans(text, base), key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(df: DataFrame, text: str, into: str = "spans") -> DataFrame:
    """All columns of ``df`` with an array of ``kind, start, end`` behind them; empty for null texts.

    Each row is read on its own: repeated rows and null keys make no difference.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wire = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        )
        for block in blocks(batches, text):
            spans = [
                [{"kind": k, "start": s, "end": e} for k, s, e in secret_spans(value)]
                for value in block.column(text).to_pylist()
            ]
            yield from block.append_column(into, pa.array(spans, wire)).to_batches()

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(into, SPANS)]))


def masked(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """A text with each stretch of overlapping or touching spans replaced."""
    parts, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start > at or not parts:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redact(df: DataFrame, text: str, mark: str = "<secret>") -> DataFrame:
    """``df`` with every stretch of secrets in ``text`` replaced by ``mark``; other texts unchanged.

    Found and replaced in one pass: two Python stages in a row would keep two workers per core.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            clean = []
            for value in block.column(text).to_pylist():
                spans = secret_spans(value)
                clean.append(masked(value, spans, mark) if spans else value)
            place = block.schema.get_field_index(text)
            yield from block.set_column(place, text, pa.array(clean, pa.string())).to_batches()

    return df.mapInArrow(run, df.schema)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
