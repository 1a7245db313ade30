import hashlib
import re

import pytest
from hirelens.llm import fill_middle
from hirelens.llm.fill_middle import Draw, Sentinels, SkipList


def by_hand(key, text, draw=Draw(), marks=("<P>", "<S>", "<M>")):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{draw.seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in marks) or h[2] % 100 >= draw.rate:
        return key, text, "plain", n, None, None
    p, s, m = marks
    if h[3] % 100 < draw.spm:
        return key, s + suffix + p + prefix + m + middle, "spm", n, len(prefix), len(middle)
    return key, p + prefix + s + suffix + m + middle, "psm", n, len(prefix), len(middle)


def test_odd_rows(docs, rows, empty):
    for draw in (Draw(), Draw(seed=1, rate=50, spm=20)):
        got = fill_middle.fill_in_middle(docs, "doc_id", "text", draw)
        want = sorted((by_hand(i, t, draw) for i, t, _ in rows), key=repr)
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert fill_middle.fill_in_middle(empty, "doc_id", "text").count() == 0


def test_given_documents(some):
    out = fill_middle.fill_in_middle(some, "doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in some.collect()}
    got = fill_middle.restored(out).collect()
    assert {tuple(r)[:6] for r in got} == {by_hand(i, t) for i, t in texts.items()}
    assert {r["key"]: r["restored"] for r in got} == texts
    assert {r["form"] for r in got} >= {"psm", "spm"}


TEXTS = ["\n\n\n", "no feed at the end", "a\r\nb\rc\x0bd e\n", "<\nP>\n<P\n>", "ends <S\n><P", "has <M> within", "é😀\n" * 4000]


@pytest.mark.parametrize("text", TEXTS)
def test_texts(text):
    for key in [None, *range(40)]:
        out = fill_middle.transform(text, key, Draw(), Sentinels())
        assert (key, *out) == by_hand(key, text)
        assert fill_middle.restore(out[0], out[1], Sentinels()) == text


def test_skip_list():
    widths = [i * 7 % 5 for i in range(5000)]
    units = SkipList(widths)
    starts = [sum(widths[:i]) for i in range(0, 5001, 61)]
    assert [units.offset(i) for i in range(0, 5001, 61)] == starts
    assert units.offset(5000) == units.width == sum(widths)
    assert 8 < len(units.lanes) < 20 and len(units.lanes[-1]) <= 2
    for lane in units.lanes:
        assert sum(n for n, _, _ in lane) == 5000 and sum(w for _, w, _ in lane) == units.width
    assert SkipList([]).offset(0) == 0
    with pytest.raises(IndexError):
        units.offset(5001)


def test_descent_is_logarithmic():
    """Far fewer links than units are passed, whatever the rank."""

    class Counting(list):
        passed = 0

        def __getitem__(self, i):
            Counting.passed += 1
            return super().__getitem__(i)

    units = SkipList([1] * 100_000)
    units.lanes = [Counting(lane) for lane in units.lanes]
    for rank in range(0, 100_000, 1013):
        units.offset(rank)
    assert Counting.passed / 99 < 250


def test_marks_must_not_overlap():
    for marks in (("<P>", "<P>", "<M>"), ("<<", "<S>", "<M>"), ("ab", "bc", "x"), ("", "a", "b"), ("a<S>", "<S>", "x")):
        with pytest.raises(ValueError):
            Sentinels(*marks)
    with pytest.raises(ValueError):
        fill_middle.restore("text", "psm", Sentinels())
