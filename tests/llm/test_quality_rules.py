import re

from hirelens.llm import quality_rules
from pyspark.sql import functions as F


def by_hand(text):
    """The five counts, word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def check(result, texts):
    got = sorted(
        (tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")))
        for r in result
    )
    assert got == sorted(map(by_hand, texts))


def test_counts(docs, rows):
    result = quality_rules.judge(docs, "doc_id", "text", "source").collect()
    check(result, [t for _, t, _ in rows])
    for r in result:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_given_documents(some):
    texts = [r["text"] for r in some.select("text").collect()]
    check(quality_rules.judge(some, "doc_id", "text", "source").collect(), texts)


def test_hosts_are_shrunk(spark):
    """A large bad host fails; one bad document does not make a small host fail; no host, no verdict."""
    good = " ".join(f"w{i}" for i in range(40))
    hosts = [("bad", "x", 300), ("bad", good, 20), ("fine", good, 2000), ("fine", "x", 20)]
    hosts += [(f"small{i}", good, 9) for i in range(20)] + [("tiny", "x", 1), ("tiny", good, 1)]
    hosts += [(None, good, 5), (None, "x", 30)]
    values = [(f"{h}-{t[:2]}-{i}", t, h) for h, t, n in hosts for i in range(n)]
    df = spark.createDataFrame(values, "id string, text string, site string")
    found = quality_rules.judge(df, "id", "text", "site")
    failed = {
        r["h"]: r["f"]
        for r in found.groupBy(F.split("id", "-")[0].alias("h")).agg(F.max("host_failed").alias("f")).collect()
    }
    assert failed.pop("bad") and not any(failed.values())
    kept = {r["id"] for r in found.filter("kept").collect()}
    assert f"bad-{good[:2]}-0" not in kept and f"tiny-{good[:2]}-0" in kept
    assert f"None-{good[:2]}-0" in kept and "None-x-0" not in kept


def test_no_python(docs):
    plan = quality_rules.measures(docs, "doc_id", "text", "source")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(empty):
    assert quality_rules.judge(empty, "doc_id", "text", "source").count() == 0
