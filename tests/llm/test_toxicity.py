import numpy as np
from hirelens.llm import toxicity
from pyspark.sql import functions as F


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    weights = toxicity.fit(docs, labels, "doc_id", "text", "toxic")
    assert 0 < len(weights.index) < 5000  # sparse
    kept_back = toxicity.score(docs, "text", weights).filter(toxicity.held_out(F.col("doc_id")))
    rows = kept_back.join(labels, "doc_id").select("score", "toxic").collect()
    said, true = (np.array(x) for x in zip(*[(r["score"] >= 0.5, r["toxic"] == 1) for r in rows]))
    assert (said == true).mean() > 0.95
    assert (said & true).sum() / said.sum() > 0.95 and (said & true).sum() / true.sum() > 0.7


def test_held_out_labels_teach_nothing(spark):
    docs = spark.createDataFrame([(i, "bad words" if i % 2 else "good words") for i in range(200)], "id long, text string")
    truth = docs.select("id", (F.col("id") % 2).cast("int").alias("y"))
    flipped = truth.withColumn("y", F.when(toxicity.held_out(F.col("id")), 1 - F.col("y")).otherwise(F.col("y")))
    one, two = (toxicity.fit(docs, x, "id", "text", "y", l1=0.5) for x in (truth, flipped))
    assert one.bias == two.bias and (one.value == two.value).all() and len(one.index)
    scores = {r["text"]: r["score"] for r in toxicity.score(docs, "text", one).collect()}
    assert scores["bad words"] > 0.5 > scores["good words"]


def test_odd_rows(docs, empty, spark):
    labels = spark.createDataFrame(
        [(1, 0, 1), (1, 0, 0), (2, 1, None), (None, 1, 1), (9, 0, 0)], "doc_id long, quality int, toxic int"
    )
    weights = toxicity.fit(docs, labels, "doc_id", "text", "toxic")
    rows = toxicity.score(docs, "text", weights, "_s").collect()
    assert len(rows) == docs.count() and all(0 <= r["_s"] <= 1 for r in rows)
    assert {r["score"] for r in rows} == {"x"}  # the input's own column stays
    none = toxicity.fit(empty, labels, "doc_id", "text", "toxic")
    assert len(none.index) == 0 and none.bias == 0
    assert toxicity.score(empty, "text", none, "_s").count() == 0
    assert {r["_s"] for r in toxicity.score(docs, "text", none, "_s").collect()} == {0.5}


def test_ftrl_is_sparse_and_order_is_fixed():
    rows = [(np.array([i % 7, 10 + i]), int(i % 7 == 0)) for i in range(300)]
    w = toxicity.ftrl(rows, 3, 1.0, 1.0, 3.0, 1.0)
    assert 0 in w.index and not (w.index >= 10).any()
