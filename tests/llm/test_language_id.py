import numpy as np
import pytest
from hirelens.llm import language_id
from hirelens.llm.language_id import Models
from pyspark.sql import functions as F

DOCS = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(DOCS)


@pytest.fixture(scope="module")
def models(given):
    return language_id.fit(given, "doc_id", "text", "lang")


def test_held_out_rows(given, models):
    got = language_id.identify(given, "text", models).withColumn("out", language_id.held_out(F.col("doc_id")))
    out = got.filter("out").collect()
    assert len(out) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in out)
    assert set(models.machines) == {("de", "en"), ("es", "fr")} and models.families == ["germanic", "romance"]


def test_held_out_rows_teach_nothing(given, models):
    """Other labels and texts on held-out rows leave every weight as it is."""
    out = language_id.held_out(F.col("doc_id"))
    other = given.withColumn("lang", F.when(out, F.lit("xx")).otherwise(F.col("lang")))
    other = other.withColumn("text", F.when(out, F.lit("zzz")).otherwise(F.col("text"))).repartition(5)
    again = language_id.fit(other, "doc_id", "text", "lang")
    assert again.families == models.families
    for pair, (weights, bias) in models.machines.items():
        assert np.allclose(again.machines[pair][0], weights, atol=1e-4) and abs(again.machines[pair][1] - bias) < 1e-6
    assert np.allclose(again.logs, models.logs, atol=1e-4)


def test_prediction_uses_the_whole_text_alone(given, models):
    some = given.limit(20).select("text")
    renamed = some.withColumn("lang", F.lit("en")).withColumn("doc_id", F.lit(1)).withColumn("score", F.lit(0))
    a = [tuple(r) for r in language_id.identify(some, "text", models).collect()]
    b = [(r[0], *r[4:]) for r in language_id.identify(renamed, "text", models, ("p", "s")).collect()]
    assert a == b
    texts = {r["lang"]: r["text"] for r in given.filter("length(text) between 2000 and 4000").collect()}
    assert models.predict("12 " * 5000 + texts["fr"])[0] == "fr"
    assert models.predict(texts["en"] + texts["de"] * 20)[0] == "de"


def test_odd_rows(spark, docs, empty, models):
    labelled = docs.withColumn("lang", F.when(F.col("doc_id") > 6, F.lit("en")))
    got = language_id.identify(docs.drop("score"), "text", models).collect()
    assert len(got) == docs.count()
    for r in got:
        nothing = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == nothing and (r["score"] == 0) == nothing
    one = language_id.fit(labelled, "doc_id", "text", "lang")
    assert one.families == ["germanic"] and one.predict("anything")[0] == "en" and one.predict("1 ½ ²")[0] == "und"
    for nobody in (docs.withColumn("lang", F.lit(None).cast("string")), empty.withColumn("lang", F.lit("en"))):
        assert language_id.fit(nobody, "doc_id", "text", "lang").predict("text") == ("und", 0.0)
    assert language_id.identify(empty.drop("score"), "text", models).count() == 0
    null_key = docs.select(language_id.held_out(F.lit(None).cast("long"))).distinct().collect()
    assert [r[0] for r in null_key] == [False]


def test_many_languages(spark):
    """Three languages of a family vote; unlisted ones are families of their own; the sample is bounded."""
    syllables = {"da": "og er jeg ikke det", "nb": "og er jeg ikkje deg", "sv": "och ar jag inte det", "xx": "qq xz", "pt-BR": "nao voce"}
    rng = np.random.default_rng(0)
    rows = []
    for name, words in syllables.items():
        rows += [(len(rows) * 31 + i, " ".join(rng.choice(words.split(), 30)), name) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    for max_rows in (2000, 40):
        models = language_id.fit(df, "doc_id", "text", "lang", max_rows=max_rows)
        assert models.families == ["germanic", "romance", "xx"] and len(models.machines) == 3
        assert all(models.predict(t)[0] == name for _, t, name in rows)


def test_machine_parts_two_sides():
    """The machine reaches the optimum that plain gradient steps on the primal reach."""
    rng = np.random.default_rng(2)
    rows, signs = [], []
    for i in range(60):
        sign = 1 if i % 3 else -1
        index = np.sort(rng.choice(40, 12, replace=False)).astype(np.int32)
        share = rng.random(12) + np.where((index < 20) == (sign > 0), 0.5, 0.0)
        rows.append((index, (share / share.sum()).astype(np.float32)))
        signs.append(sign)
    signs = np.array(signs)
    weights, bias = language_id.machine(rows, signs, epochs=2000)
    dense = np.zeros((60, 41))
    for i, (index, share) in enumerate(rows):
        dense[i, index] = share
    scale = np.append(1 / np.sqrt(dense[:, :40].mean(0) + 1e-5), 1.0)
    dense[:, 40] = 1.0
    x = dense * scale
    cost = 10.0 * 60 / np.where(signs > 0, (signs > 0).sum(), (signs < 0).sum())
    w = np.zeros(41)
    value = lambda w: 0.5 * w @ w + (cost * np.maximum(1 - signs * (x @ w), 0) ** 2).sum()
    step = 1 / (1 + 2 * cost.max() * np.linalg.norm(x, 2) ** 2)
    for _ in range(60_000):
        slack = np.maximum(1 - signs * (x @ w), 0)
        w -= step * (w - 2 * x.T @ (cost * signs * slack))
    found = np.append(weights[:40] / scale[:40], bias)
    assert value(found) <= value(w) * 1.01


def test_empty_models():
    none = Models([], np.empty((0, 1)), np.empty(0), {}, {})
    assert none.predict("some text") == ("und", 0.0)
