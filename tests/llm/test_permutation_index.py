import numpy as np
from hirelens.llm import permutation_index
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, score double, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0.0, "x") for i, v in rows], SCHEMA)


def exact(rows, query, k):
    """The k nearest of ``id -> vector``, ties to the smaller id."""
    q = np.array(rows[query], np.float32).astype(float)
    scored = [(-float((np.array(v, np.float32).astype(float) * q).sum()), i) for i, v in rows.items() if i != query]
    return [(i, -s) for s, i in sorted(scored)[:k]]


def search(df, every=20, k=20, **options):
    found = permutation_index.nearest_neighbours(
        df, "vec_id", "embedding", F.col("vec_id") % every == 0, k, **options
    )
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(rows, found, k):
    hits = [len({i for i, _ in got} & {i for i, _ in exact(rows, q, k)}) for q, got in found.items()]
    return sum(hits) / (k * len(hits))


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {r["vec_id"]: r["embedding"] for r in df.collect()}
    found = search(df)
    assert len(found) == 100 and recall(rows, found, 20) >= 0.9
    for q, got in found.items():
        assert got == sorted(got, key=lambda x: (-x[1], x[0])) and len(got) == 20
        for i, s in got:
            assert abs(s - float(np.dot(np.float64(rows[i]), np.float64(rows[q])))) < 1e-12


def test_vectors_of_any_length(spark):
    rng = np.random.default_rng(3)
    rows = {i: (v * rng.uniform(0.1, 4)).tolist() for i, v in enumerate(rng.normal(size=(1500, 24)))}
    found = search(frame(spark, rows.items()), block=300)
    assert len(found) == 75 and recall(rows, found, 20) >= 0.9


def test_a_third_of_one_vector(spark):
    rng = np.random.default_rng(4)
    rows = {i: ([1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(600)}
    found = search(frame(spark, rows.items()), every=60, block=200)
    for q, got in found.items():
        assert q % 3 == 0 and [i for i, _ in got] == [i for i, _ in exact(rows, q, 20)]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(20, None), (40, [0.0, 0.0]), (60, [1.0, None]), (80, [nan, 1.0]), (100, [inf, 1.0]), (None, [1.0, 1.0]), (120, [])]
    good = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-1.0])]
    assert search(frame(spark, odd + good)) == {0: [(1, 0.5), (2, 0.5), (3, -1.0)]}


def test_empty(spark):
    assert search(frame(spark, [])) == {}
    assert search(frame(spark, [(0, [1.0])])) == {}
