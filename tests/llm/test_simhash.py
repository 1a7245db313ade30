import numpy as np
import xxhash
from hirelens.llm import simhash


def by_hand(text):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    """Smallest known id over links of at most 2 bits, all pairs looked at."""
    fps = [by_hand(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 2 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (i, _) in zip(group, rows):
        least[g] = min(x for x in (i, least.get(g)) if x is not None) if i is not None else least.get(g)
    return sorted(((i, f"{f:016x}", least[g]) for (i, _), f, g in zip(rows, fps, group)), key=repr)


def test_odd_rows(docs, rows):
    got = simhash.near_duplicates(docs, "doc_id", "text").collect()
    assert sorted(map(tuple, got), key=repr) == components([(i, t) for i, t, _ in rows])


def test_given_documents(some):
    rows = [(r["doc_id"], r["text"]) for r in some.collect()]
    got = simhash.near_duplicates(some, "doc_id", "text").collect()
    assert sorted(map(tuple, got), key=repr) == components(rows)


def test_links_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    seeds = rng.integers(-(2**63), 2**63, 40)
    values = set(seeds.tolist()) | {0, -1, 1, -(2**63)}
    for s in seeds.tolist():
        for _ in range(6):
            flips = rng.choice(64, rng.integers(1, 4), replace=False)
            values.add(int(np.int64(np.uint64(s & (2**64 - 1)) ^ np.uint64(sum(1 << int(f) for f in flips)))))
    values = sorted(values)
    want = {
        (max(a, b), min(a, b))
        for i, a in enumerate(values)
        for b in values[:i]
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    }
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    for segments in (8, 16):
        assert {tuple(r) for r in simhash.links(df, segments=segments).collect()} == want


def test_long_text_is_counted_in_parts(monkeypatch):
    text = " ".join(f"w{i * 7 % 1009}" for i in range(3000))
    monkeypatch.setattr(simhash, "CHUNK", 128)
    assert simhash.fingerprint(text) == by_hand(text)


def test_empty(empty):
    assert simhash.near_duplicates(empty, "doc_id", "text").count() == 0


def test_postings_are_not_broadcast(spark):
    """A fingerprint has up to 33 postings, which Spark does not see in the size of the table."""
    links = simhash.links(spark.range(1000).withColumnRenamed("id", "fp"))
    links.count()
    assert "Broadcast" not in links._jdf.queryExecution().executedPlan().toString()
