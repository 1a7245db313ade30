import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hirelens.llm import token_files
from hirelens.llm.token_ids import vocabulary
from tokenizers import Tokenizer

WORDS = vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def expected(rows):
    library = Tokenizer.from_str(WORDS)
    order = lambda r: (r[0] is not None, r[0] or 0)
    return [
        (i, np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())
        for i, t in sorted(rows, key=order)
    ]


def test_odd_rows(spark, docs, rows, tmp_path):
    files = token_files.write_files(docs, "doc_id", "text", WORDS, f"file://{tmp_path}/out")
    got = token_files.read_files(spark, files).orderBy("start").collect()
    want = expected([(i, t) for i, t, _ in rows])
    assert [r["key"] for r in got] == [i for i, _ in want]
    assert sorted((r["key"] or 0, bytes(r["ids"])) for r in got) == sorted((i or 0, b) for i, b in want)
    at = 0
    for r in got:
        assert r["start"] == at
        at += len(r["ids"]) // 4


def test_given_documents(spark, some, tmp_path):
    files = token_files.write_files(some, "doc_id", "text", WORDS, f"file://{tmp_path}/out")
    got = token_files.read_files(spark, files).orderBy("start").collect()
    want = expected([(r["doc_id"], r["text"]) for r in some.collect()])
    assert [(r["key"], bytes(r["ids"])) for r in got] == want


@pytest.fixture
def file(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_BYTES", 400)
    writer = token_files.Writer(f"file://{tmp_path}", "x.tok")
    content = [(i if i % 5 else None, np.arange(i * 3, dtype="<u4").tobytes()) for i in range(40)]
    for key, ids in content:
        writer.add(key, ids)
    writer.close()
    return f"file://{tmp_path}/x.tok", tmp_path / "x.tok", content


def test_only_the_frames_asked_for(file, monkeypatch):
    uri, _, content = file
    reader = token_files.Reader(uri)
    assert len(reader.frames) > 10
    read, frame = [], reader.frame
    monkeypatch.setattr(reader, "frame", lambda n: read.append(n) or frame(n))
    found = list(reader.read([7, 31, 7]))
    assert [(p, k, ids) for p, k, _, ids in found] == [(p, *content[p]) for p in (7, 31)]
    assert [start for _, _, start, _ in found] == [sum(len(c) // 4 for _, c in content[:p]) for p in (7, 31)]
    assert len(read) == 2
    assert [(k, ids) for _, k, _, ids in reader.read()] == content


def test_any_zstandard_reader_reads_the_frames(file):
    _, path, content = file
    with path.open("rb") as f:
        plain = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert plain == b"".join(ids for _, ids in content)


def test_damage_is_found(file):
    uri, path, _ = file
    raw = bytearray(path.read_bytes())
    broken = bytearray(raw)
    broken[-40] ^= 1
    path.write_bytes(broken)
    with pytest.raises(ValueError):
        token_files.Reader(uri)
    reader_raw = bytearray(raw)
    reader_raw[12] ^= 255
    path.write_bytes(reader_raw)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.Reader(uri).read([0, 1, 2, 3]))


def test_checksum_of_ids(spark, some, tmp_path):
    from pyspark.sql import functions as F

    files = token_files.write_files(some, "doc_id", "text", WORDS, f"file://{tmp_path}/out")
    rows = token_files.read_files(spark, files).select("ids", F.crc32("ids").alias("c")).collect()
    assert all(zlib.crc32(bytes(r["ids"])) == r["c"] for r in rows)


def test_empty(spark, empty, tmp_path):
    files = token_files.write_files(empty, "doc_id", "text", WORDS, f"file://{tmp_path}/out")
    assert token_files.read_files(spark, files).count() == 0
