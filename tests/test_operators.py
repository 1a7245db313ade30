"""Archive, quality, market, profile and corpus operators on small tables, against brute force."""

import functools
import hashlib
import itertools
import json
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Row

from hirelens import schemas
from hirelens.functions import tokens as tok
from hirelens.operators import corpus, history, market, models, near_dup, postings, profiles, quality, set_join, skew
from hirelens.operators import phrases as phrases_op
from hirelens.operators import text_match
from hirelens.plans import inputs
from hirelens.session import new_path, shared_dir
from hirelens.sources import archive, array_files, run_state, sinks
from hirelens.streaming import arrivals

c = F.col


def pairs(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


# --- skew -------------------------------------------------------------------------------------


def test_lookup_answers_hot_cold_null_and_unknown_keys(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEYS", 1)
    keys = ["hot"] * 30 + ["a", "b", "b", None, "x"]
    df = spark.createDataFrame(list(enumerate(keys)), "i int, k string")
    table = spark.createDataFrame([("hot", 30, 7.0), ("a", 1, 8.0), ("b", 2, 9.0)], "k string, n int, v double")
    got = {r.i: r.v for r in skew.lookup(df, table, "k", "n").collect()}
    want = {"hot": 7.0, "a": 8.0, "b": 9.0}
    assert got == {i: want.get(k) for i, k in enumerate(keys)}


def test_lookup_spreads_a_key_with_a_third_of_the_rows(spark):
    """Every row goes through the shuffled join; no task gets much more than its share."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        key = F.when(c("id") % 3 == 0, "hot").otherwise((c("id") % 20000).cast("string"))
        df = spark.range(120_000).withColumn("k", key)
        table = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("m"))
        joined = skew.lookup(df, table, "k", "n").withColumn("task", F.spark_partition_id())
        tasks = joined.groupBy("task").agg(F.count("m").alias("rows"), F.max("m")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = [r.rows for r in tasks]
    assert sum(sizes) == 120_000 and max(sizes) < 1.5 * 120_000 / len(sizes)


def test_top_k_and_rank_by_score(spark):
    rng = random.Random(1)
    data = [("k" if i % 3 else "z", i, rng.randint(0, 9) / 10) for i in range(60)]
    df = spark.createDataFrame(data, "g string, i int, s double")
    top = skew.top_k(df, ["g"], [F.desc("s"), c("i")], 4)
    want = []
    for g in ("k", "z"):
        ordered = sorted([d for d in data if d[0] == g], key=lambda d: (-d[2], d[1]))
        want += [(g, d[1], n + 1) for n, d in enumerate(ordered[:4])]
    assert pairs(top, "g", "i", "rank") == sorted(want)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    ranked = skew.rank_by_score(df, ["g"], "s")
    assert pairs(ranked, "i", "rank") == sorted(
        (i, 1 + sum(1 for h, _, t in data if h == g and t > s)) for g, i, s in data
    )


# --- history ----------------------------------------------------------------------------------


def test_dedup_jobs_is_deterministic_and_idempotent(spark):
    rows = [("a", 1, 2), ("a", 1, 1), ("b", 0, 5), (None, 3, 1), (None, 3, 2), ("a", 0, 9)]
    df = spark.createDataFrame(rows, "job_id_raw string, page int, position int")
    want = sorted([("a", 0, 9), ("b", 0, 5), (None, 3, 1), (None, 3, 2)], key=str)
    for parts in (1, 5):
        once = history.dedup_jobs(df.repartition(parts))
        assert sorted(map(tuple, once.collect()), key=str) == want
        assert sorted(map(tuple, history.dedup_jobs(once).collect()), key=str) == want


def test_deduplication_sorts_no_whole_rows(spark):
    """Equal rows count once, ties go by the hash of the row, and only keys and places are sorted."""
    rows = [("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), ("b", 2, "z"), (None, 3, "v"), (None, 4, "w")]
    df = spark.createDataFrame(rows, "k string, i int, t string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = history.first_rows(df, ["k"], [c("i")])
        got = sorted(map(tuple, found.collect()), key=str)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [r[:2] for r in got] == [("a", 1), ("b", 2), (None, 3)] and got[0][2] in "xy"
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    sorts = [line for line in plan.splitlines() if "SortAggregate" in line or "Sort [" in line]
    assert sorts and all("t#" not in line.split("output=")[0] for line in sorts)


def test_change_history(spark):
    rows = [("j", "1", "x"), ("j", "2", "x"), ("j", "3", "y"), ("j", "3", "z"), ("k", "2", None)]
    df = spark.createDataFrame(rows, "job string, ts string, h string")
    got = history.change_history(df, "job", "ts", "h")
    assert pairs(got, "job", "ts", "change") == [
        ("j", "1", "new"), ("j", "2", "same"), ("j", "3", "changed"), ("k", "2", "new"),
    ]


def test_skip_seen_and_limit(spark, sf_dir):
    cards = inputs.cards(spark, sf_dir)
    raw = inputs.raw_jobs(spark, sf_dir)
    assert history.skip_seen(cards, raw).count() == 0
    assert history.skip_seen(cards, raw.limit(0)).count() == cards.count()
    first = history.limit_listings(cards, 3).select("doc_id").collect()
    assert [r.doc_id for r in first] == [0, 1, 2]


# --- parsing ----------------------------------------------------------------------------------


def test_kept_and_rejected_rows_add_up(spark, sf_dir):
    p = inputs.postings(spark, sf_dir)
    kept, lost = postings.parse_postings(p), postings.parse_rejects(p)
    assert kept.count() + lost.count() == p.count()
    assert kept.columns[:25] == schemas.PARSED_JOB.names
    assert [f.dataType for f in kept.schema][:25] == [f.dataType for f in schemas.PARSED_JOB]


def test_skill_invariants(spark, sf_dir):
    df = inputs.parsed(spark, sf_dir)
    both = F.array_intersect("skills_required", "skills_optional")
    outside = F.array_except("tools_frameworks", F.array_union("skills_required", "skills_optional"))
    bad = df.filter((F.size(both) > 0) | (F.size(outside) > 0) | (F.size("skills_required") == 0))
    assert bad.count() == 0


def test_parsing_is_one_narrow_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    p = docs.selectExpr(*[f"{sql} AS {n}" for n, sql in inputs.POSTING_COLUMNS.items()])
    plan = postings.parse_postings(p)._jdf.queryExecution().executedPlan().toString()
    assert not any(s in plan for s in ("Exchange", "BatchEvalPython", "ArrowEvalPython", "MapInArrow"))


def test_result_does_not_depend_on_partitions(spark, sf_dir):
    p = inputs.postings(spark, sf_dir)
    lists = ["skills_required", "skills_optional"]
    one = postings.parse_postings(p.coalesce(1)).select("doc_id", "role_type", *lists)
    many = postings.parse_postings(p.repartition(13)).select("doc_id", "role_type", *lists)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


# --- quality ----------------------------------------------------------------------------------


def test_quality_distribution_ignores_unknown_levels(spark):
    df = spark.createDataFrame([("high",), ("high",), ("low",), ("odd",), (None,)], "q string")
    got = quality.quality_distribution(df, c("q")).collect()
    assert [(r.level, r.n, r.pct) for r in got] == [
        ("high", 2, 66.7), ("medium", 0, 0.0), ("low", 1, 33.3),
    ]
    assert [r.pct for r in quality.quality_distribution(df.limit(0), c("q")).collect()] == [None] * 3


def test_schema_report_finds_wrong_types(spark):
    df = spark.createDataFrame([("a", "[x]", ["s"])], "job_id string, title_keywords string, skills_required array<string>")
    (row,) = quality.schema_report(df.withColumn("more", F.lit(1))).collect()
    assert not row.valid and row.extra_columns == ["more"] and row.row_count == 1
    assert row.list_format_issues == {"title_keywords": 1} and "company" in row.missing_columns


def test_leaf_paths():
    paths = schemas.leaf_paths(schemas.RAW_JOB)
    assert len(paths) == 43 and paths[2] == "scrape_metadata.search_keyword"
    assert len(schemas.leaf_paths(schemas.RAW_COMPANY)) == 23
    assert len(schemas.PARSED_JOB) == 25


# --- files ------------------------------------------------------------------------------------


def test_shared_dir_is_read_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_array_files_and_broken_files(spark, tmp_path):
    record = {"job_identity": {"job_id_raw": "h", "job_url": "u"}, "scraper_version": "1.0.0"}
    (tmp_path / "good.json").write_text(json.dumps([record, {"scraper_version": "x"}], indent=1))
    (tmp_path / "bad.json").write_text("{not json")
    (tmp_path / "other.txt").write_text("[]")
    path = str(tmp_path)
    good = archive.scan_raw_jobs(spark, path, array_files=True).collect()
    assert [r.job_identity.job_id_raw for r in good] == ["h"]
    (bad,) = archive.corrupt_rows(spark, path, array_files=True).collect()
    assert bad.file.endswith("bad.json")


def _array_file(n, seed):
    """Records whose texts hold brackets, quotes, escapes and line breaks."""
    rng = random.Random(seed)
    odd = ['}', '{', '"', "\\", "[", "]", ",", "\n", "é", "😀", "}, {", '\\"}', "word ", "\u2028"]
    return [
        {"scraper_version": "".join(rng.choices(odd, k=rng.randrange(40))), "job_identity": {"job_id_raw": f"{i}", "job_url": "}" * (i % 3)}}
        for i in range(n)
    ]


@pytest.mark.parametrize("indent", [None, 2])
def test_array_file_is_read_by_many_tasks(spark, tmp_path, indent):
    """Ranges of 300 bytes: within strings, escapes and records, across several ranges."""
    files = {f"f{k}.json": _array_file(n, k) for k, n in enumerate([300, 1, 0, 40])}
    files["long.json"] = [{"scraper_version": "x}" * 2000, "job_identity": {"job_id_raw": "long", "job_url": "u"}}] * 3
    for name, rows in files.items():
        (tmp_path / name).write_text(json.dumps(rows, indent=indent, ensure_ascii=indent is None))
    (tmp_path / "one.json").write_text(json.dumps(files["f1.json"][0], indent=indent))
    (tmp_path / "torn.json").write_text(json.dumps(files["f3.json"], indent=indent)[:-8])
    (tmp_path / "blank.json").write_text(" \n")
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = archive.scan_raw_jobs(spark, str(tmp_path), array_files=True)
        got = sorted((r.job_identity.job_id_raw, r.scraper_version, r.job_identity.job_url) for r in df.collect())
        bad = archive.corrupt_rows(spark, str(tmp_path), array_files=True).collect()
        tasks = array_files.read_text(spark, str(tmp_path)).rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    rows = [r for rows in files.values() for r in rows] + files["f1.json"] + files["f3.json"][:-1]
    assert got == sorted((r["job_identity"]["job_id_raw"], r["scraper_version"], r["job_identity"]["job_url"]) for r in rows)
    assert [r.file.rsplit("/", 1)[1] for r in bad] == ["torn.json"] and tasks > 50


def test_dedup_of_rows_with_maps(spark):
    """Maps, also within other types, are kept as they are; equal rows leave one."""
    schema = "id string, ts int, m map<string,string>, deep array<struct<x:map<string,int>>>"
    rows = [("a", 1, {"k": "1"}, [({"y": 1},)]), ("a", 1, {"k": "1"}, [({"y": 1},)]), ("a", 2, {"k": "2"}, None), ("b", 1, None, []), (None, 5, {}, None)]
    df = spark.createDataFrame(rows, schema)
    first = history.first_rows(df, ["id"], [c("ts")]).collect()
    assert sorted(((r.id, r.ts, r.m) for r in first), key=repr) == [("a", 1, {"k": "1"}), ("b", 1, None), (None, 5, {})]
    assert {(r.id, r.ts) for r in history.dedup_by_id(df, "id", "ts").collect()} == {("a", 2), ("b", 1), (None, 5)}


@pytest.mark.parametrize("least", [0.05, 0.3])
def test_text_matches_against_all_pairs(spark, least):
    rng = random.Random(31)
    words = [f"w{i}" for i in range(80)]
    some = lambda n: rng.choices(words[:20], k=n) + rng.choices(words, k=n)
    left = [(i, ["hot", *some(rng.randrange(0, 9))]) for i in range(60)] + [(60, []), (61, None), (62, ["hot"])]
    right = [(f"p{i}", ["hot", *some(rng.randrange(0, 6))]) for i in range(25)] + [("none", [])]
    a, b = (spark.createDataFrame(rows, f"{k}, ts array<string>") for rows, k in ((left, "l int"), (right, "r string")))
    rows = [(("l", k), ts or []) for k, ts in left] + [(("r", k), ts or []) for k, ts in right]
    seen = Counter(t for _, ts in rows for t in set(ts))
    unit = {}
    for k, ts in rows:
        w = {t: n * math.log(len(rows) / seen[t]) for t, n in Counter(ts).items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        unit[k] = {t: x / norm for t, x in w.items() if x} if norm else {}
    want = []
    for i, _ in left:
        scores = [(round(sum(x * unit["r", j].get(t, 0) for t, x in unit["l", i].items()), 9), j) for j, _ in right]
        best = sorted(((-s, j) for s, j in scores if s >= least))[:3]
        want += [(i, j, pytest.approx(-s), n + 1) for n, (s, j) in enumerate(best)]
    got = pairs(text_match.text_matches(a, b, "l", "r", c("ts"), 3, least), "l", "r", "score", "rank")
    assert len(want) > 20 and got == sorted(want, key=lambda r: r[:2])
    va, vb = text_match.vectors_of(a, b, "l", "r", c("ts"))
    made = text_match.candidates(va, vb, "l", "r", least).count()
    everything = sum(bool(set(unit["l", i]) & set(unit["r", j])) for i, _ in left for j, _ in right)
    assert made < everything * (0.9 if least == 0.3 else 1.01)


def test_phrases_against_the_substring_rule(spark):
    """100,000 phrases of one to four words; hits overlap, a hot phrase is in every text."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(300)]
    phrases = {" ".join(rng.choices(words, k=rng.randrange(1, 5))) for _ in range(150_000)} | {"hot", "hot hot", "w1 w1 w1"}
    texts = [" ".join(["hot", "hot", "hot", *rng.choices(words, k=rng.randrange(0, 60))]) for _ in range(60)] + ["w1 w1 w1 w1 w1", "", None, "xhot hotx"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3)
    table = spark.createDataFrame([(p,) for p in [*phrases, "", "hot"]], "phrase string")
    got = pairs(phrases_op.phrase_hits(df, "id", F.filter(F.split("t", " "), lambda w: w != ""), table), "id", "phrase", "place")
    want = []
    for i, t in enumerate(texts):
        ts = (t or "").split()
        for at in range(len(ts)):
            want += [(i, " ".join(ts[at : at + n]), at) for n in range(1, 5) if at + n <= len(ts) and " ".join(ts[at : at + n]) in phrases]
    assert len(phrases) > 100_000 and got == sorted(want)
    for i, p, _ in got[:200]:
        assert f" {p} " in f" {texts[i]} "
    none = table.limit(0)
    assert phrases_op.phrase_hits(df, "id", F.split("t", " "), none).count() == 0


def test_state_carried_over_five_runs(spark, tmp_path):
    """The same as the window over all runs, also for runs worked over and from a new session's catalog."""
    rng = random.Random(8)
    rows = [(None if i % 17 == 0 else f"k{rng.randrange(12)}", f"2026-0{1 + rng.randrange(5)}", f"h{rng.randrange(3)}") for i in range(200)]
    df = spark.createDataFrame(rows, "k string, run string, h string").repartition(3)
    want = pairs(history.change_history(df, "k", "run", "h").na.fill("-"), "k", "run", "h", "previous_hash", "run_no", "change")
    path, told = str(tmp_path), {}
    runs_in_order = [f"2026-0{i}" for i in range(1, 6)]
    for run in [*runs_in_order, "2026-03", "2026-04", "2026-05"]:
        told[run] = run_state.advance(df.filter(c("run") == run), path, run, "k", "h", buckets=4)
        for t in spark.catalog.listTables():
            if t.name.startswith("state_"):
                spark.sql(f"DROP TABLE {t.name}")  # the files stay
    got = functools.reduce(lambda a, b: a.unionByName(b), told.values())
    assert sorted(pairs(got.na.fill("-"), "k", "run", "h", "previous_hash", "run_no", "change")) == want
    state = run_state.state_before(spark, path)
    assert {r.key: r.runs for r in state.collect()} == {k: len({r[1] for r in rows if r[0] == k}) for k, _, _ in rows if k}
    cards = spark.createDataFrame([("k1",), ("other",), (None,)], "k string")
    assert sorted(r.k or "" for r in run_state.unseen(cards, path, "k").collect()) == ["", "other"]
    assert run_state.unseen(cards, f"{path}/nothing", "k").count() == 3


def test_state_is_not_shuffled(spark, tmp_path):
    path = str(tmp_path)
    old = spark.range(5000).select(c("id").cast("string").alias("k"), F.lit("h").alias("h"))
    run_state.advance(old, path, "r1", "k", "h", buckets=8)
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = run_state.advance(old.filter("k < 200"), path, "r2", "k", "h", buckets=8)
        plan = told._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    at = plan.index("Bucketed: true")
    scan = plan[plan.rindex("\n", 0, at) : at]
    before = plan[: plan.rindex("\n", 0, at)].splitlines()
    assert "FileScan parquet" in scan and not any("Exchange" in line for line in before[-3:])


def test_sinks_replace_a_run(spark, tmp_path):
    """Writing a run again replaces it in every sink, other runs stay, an empty run empties its own."""
    def raw(run, n):
        meta = Row(search_keyword="Data Scientist", search_location="x", scrape_timestamp=run, user_agent_used="a")
        rows = [(meta, Row(job_id_raw=f"{run}{i}", job_url="u")) for i in range(n)]
        df = spark.createDataFrame(rows, "scrape_metadata struct<search_keyword string, search_location string, scrape_timestamp string, user_agent_used string>, job_identity struct<job_id_raw string, job_url string>")
        return schemas.conform(df, schemas.RAW_JOB)

    for fmt in ("json", "parquet"):
        path = f"{tmp_path}/jobs-{fmt}"
        for run, n in (("2026-02-01T10:00:00", 5), (None, 2), ("2026-02-02T10:00:00", 4), ("2026-02-01T10:00:00", 3)):
            sinks.write_raw_jobs(raw(run, n), path, fmt)
        got = archive.scan_raw_jobs(spark, path, fmt).groupBy("scrape_metadata.scrape_timestamp").count().collect()
        assert {tuple(r) for r in got} == {("2026-02-01T10:00:00", 3), ("2026-02-02T10:00:00", 4), (None, 2)}
    cards = schemas.conform(spark.createDataFrame([("t",), ("s",)], "raw_title string"), schemas.CARD)
    for df, run in ((cards, ""), (cards, "r1"), (cards.limit(1), "r1"), (cards, "r2"), (cards.limit(0), "r2")):
        sinks.write_raw_listings(df, f"{tmp_path}/cards", run)
    assert archive.scan_listings(spark, f"{tmp_path}/cards").count() == 3
    parsed = schemas.conform(spark.createDataFrame([("t", "2026-02-01")], "raw_title string, scrape_timestamp string"), schemas.PARSED_JOB)
    for _ in range(2):
        sinks.write_parsed(parsed, f"{tmp_path}/parsed")
    assert archive.scan_parsed(spark, f"{tmp_path}/parsed").collect() == parsed.collect()
    report = spark.createDataFrame([("now", 1)], "timestamp string, n int")
    for n in (1, 2):
        sinks.write_report(report.withColumn("n", F.lit(n)), f"{tmp_path}/report")
    assert [r.n for r in archive.scan_reports(spark, f"{tmp_path}/report", report.schema).collect()] == [2]


def test_a_write_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    """Tasks that fail midway, and a driver that ends between data and commit: readers see the run before."""
    whole = schemas.conform(spark.range(8).select(F.lit("v1").alias("scrape_timestamp"), c("id").cast("string").alias("raw_title")), schemas.PARSED_JOB)
    path = str(tmp_path)
    version = {"dataset_version": F.lit("1")}
    paths = sinks.write_dataset(whole.withColumns(version), path, "r1")

    def seen():
        return archive.scan_dataset(spark, paths["parquet"]).count(), archive.scan_latest(spark, paths["parquet"]).count()

    assert seen() == (8, 8)
    broken = whole.withColumns(version).repartition(4).withColumn(
        "raw_title", F.when(c("raw_title") == "7", F.raise_error(F.lit("lost"))).otherwise(c("raw_title"))
    )
    for run in ("r1", "r2"):
        with pytest.raises(Exception, match="lost"):
            sinks.write_dataset(broken, path, run)
        assert seen() == (8, 8)
    with monkeypatch.context() as patch:
        patch.setattr(sinks.runs, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            sinks.write_dataset(whole.withColumns(version).limit(2), path, "r1")
    assert seen() == (8, 8) and spark.read.parquet(paths["parquet_latest"]).count() == 8
    sinks.write_dataset(whole.withColumns(version).limit(3), path, "r1")
    assert seen() == (3, 3)
    assert spark.read.parquet(paths["parquet_latest"]).count() == 8  # a reader of the older state goes on


def test_nested_pruning_from_parquet(spark, sf_dir):
    path = new_path(spark, "pruned")
    sinks.write_raw_jobs(inputs.raw_jobs(spark, sf_dir), path, "parquet")
    df = archive.scan_raw_jobs(spark, path, "parquet").select("job_identity.job_url")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<job_identity:struct<job_id_raw:string,job_url:string>>" in plan


def test_dataset_runs_add_up_and_latest_is_replaced(spark, sf_dir):
    df = inputs.parsed(spark, sf_dir).select(*schemas.PARSED_JOB.names)
    path = new_path(spark, "runs")
    sinks.write_dataset(df, path, "r1")
    paths = sinks.write_dataset(df.limit(5), path, "r2")
    versions = archive.scan_dataset(spark, paths["parquet"])
    assert versions.count() == df.count() + 5
    assert versions.filter("run_ts = 'r2'").count() == 5
    assert spark.read.parquet(paths["parquet_latest"]).count() == 5


def test_stream_keeps_each_job_once(spark, sf_dir):
    folder, out = new_path(spark, "arrivals"), new_path(spark, "stream")
    raw = inputs.raw_jobs(spark, sf_dir)
    sinks.write_raw_jobs(raw, folder)
    fresh = arrivals.new_jobs(arrivals.stream_raw_jobs(spark, folder))
    query = (
        arrivals.parsed_stream(fresh).writeStream.format("parquet").option("path", f"{out}/data")
        .option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination(300)
    got = spark.read.parquet(f"{out}/data")
    jobs = raw.select("job_identity.job_id_raw").distinct().count()
    assert 0 < got.count() == got.select("job_url").distinct().count() <= jobs


# --- market and profiles ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def tiny(spark):
    rows = [
        Row(job=1, role_type="R", seniority_level="Senior", skills_required=["A", "B"], skills_optional=["C"]),
        Row(job=2, role_type="R", seniority_level="Senior", skills_required=["A"], skills_optional=[]),
        Row(job=3, role_type="R", seniority_level="Mid", skills_required=["B", "C"], skills_optional=["A"]),
        Row(job=4, role_type="S", seniority_level="Mid", skills_required=["B"], skills_optional=[]),
    ]
    return spark.createDataFrame(rows)


def test_cooccurrence(tiny):
    got = pairs(market.skill_cooccurrence(tiny), "a", "b", "n", "support", "lift")
    assert got == [
        ("A", "B", 2, 0.5, 2 * 4 / 9), ("A", "C", 2, 0.5, 2 * 4 / 6), ("B", "C", 2, 0.5, 2 * 4 / 6),
    ]


def test_frequency(tiny):
    got = pairs(market.skill_frequency(tiny, ["role_type"]), "role_type", "skill", "n", "postings")
    assert got == [("R", "A", 3, 3), ("R", "B", 2, 3), ("R", "C", 2, 3), ("S", "B", 1, 1)]
    assert pairs(market.skill_frequency(tiny, []), "skill", "share") == [
        ("A", 0.75), ("B", 0.75), ("C", 0.5),
    ]


def test_motifs(tiny):
    got = market.skill_motifs(tiny, 0.5)
    assert sorted((tuple(r["items"]), r["n"]) for r in got.collect()) == [
        (("A", "B"), 2), (("A", "B", "C"), 2), (("A", "C"), 2), (("B", "C"), 2),
    ]


def test_scores(spark):
    weights = F.create_map(*[F.lit(x) for x in ("A", 1.0, "B", 2.0, "C", 2.0)])
    held = F.array(F.lit("A"), F.lit("B"))
    wanted = F.array(F.lit("B"), F.lit("C"), F.lit("Z"))
    row = spark.range(1).select(
        profiles.skills_coverage(wanted, held, weights).alias("coverage"),
        profiles.match_score(wanted, held, weights).alias("match"),
        profiles.match_score(F.array(), held, weights).alias("empty"),
        profiles.seniority_fit(F.lit(1), F.lit("Staff/Lead")).alias("far"),
        profiles.seniority_fit(F.lit(6), F.lit("Senior")).alias("near"),
    ).first()
    assert row.coverage == 0.5
    assert row.match == pytest.approx(4 / math.sqrt(8 * 5))
    assert (row.empty, row.far, row.near) == (0.0, 0.0, 1.0)


def test_ranking_metrics(spark):
    data = [("q", 1, 0.9, 0), ("q", 2, 0.8, 1), ("q", 3, 0.8, 1), ("q", 4, 0.1, 0), ("n", 5, 0.3, 0)]
    df = spark.createDataFrame(data, "q string, item int, s double, rel int")
    got = {r.q: r for r in profiles.ranking_metrics(df, "q", "item", "s", "rel", 3).collect()}
    dcg = 1 / math.log2(3) + 1 / math.log2(4)
    assert got["q"].ndcg == pytest.approx(dcg / (1 + 1 / math.log2(3)))
    assert (got["q"].reciprocal_rank, got["q"].items) == (0.5, 4)
    assert (got["n"].ndcg, got["n"].reciprocal_rank) == (None, 0.0)


def _deciles(rows, bins):
    """Bin of each row: how many tenths of the rows lie below its value. Then pooling of neighbours."""
    found = {}
    for p, y in rows:
        below = sum(q < p for q, _ in rows)
        found.setdefault(bins * below // len(rows), []).append((p, y))
    blocks = [[[b], sum(y for _, y in found[b]), len(found[b])] for b in sorted(found)]
    i = 0
    while i + 1 < len(blocks):
        if blocks[i][1] / blocks[i][2] > blocks[i + 1][1] / blocks[i + 1][2]:
            nxt = blocks.pop(i + 1)
            blocks[i] = [blocks[i][0] + nxt[0], blocks[i][1] + nxt[1], blocks[i][2] + nxt[2]]
            i = max(i - 1, 0)
        else:
            i += 1
    smooth = {b: y / n for names, y, n in blocks for b in names}
    return {
        b: (len(v), sum(p for p, _ in v) / len(v), sum(y for _, y in v) / len(v), smooth[b]) for b, v in found.items()
    }


@pytest.mark.parametrize("n, values, bins", [(400, 1000, 10), (300, 7, 10), (5, 3, 10), (200, 1, 10), (97, 50, 4)])
def test_calibration_by_deciles(spark, n, values, bins):
    rng = random.Random(n)
    rows = [(rng.randrange(values) / values, rng.randrange(2)) for _ in range(n)]
    df = spark.createDataFrame([*rows, (None, 1), (0.5, None)], "p double, y int")
    got = {r.bin: (r.n, r.predicted, r.observed, r.calibrated) for r in profiles.calibration(df, c("p"), c("y"), bins).collect()}
    want = _deciles(rows, bins)
    assert set(got) == set(want)
    for b, r in want.items():
        assert got[b] == pytest.approx(r)
    smooth = [got[b][3] for b in sorted(got)]
    assert smooth == sorted(smooth)
    if values == 1000:
        assert len(got) == bins and max(v[0] for v in got.values()) <= n // bins + 5


def test_calibration_without_rows(spark):
    df = spark.createDataFrame([(None, 1)], "p double, y int")
    assert profiles.calibration(df, c("p"), c("y")).count() == 0


def test_skill_trend_counts_empty_months(spark):
    rows = [("2026-01-05", ["A"]), ("2026-01-30", ["A", "B"]), ("2026-05-01", ["A"]), (None, ["A"])]
    df = spark.createDataFrame(rows, "d string, skills_required array<string>").select(
        c("d").cast("date").alias("date_posted_normalized"), "skills_required", F.array().cast("array<string>").alias("skills_optional")
    )
    got = {(r.skill, str(r.month)[:7]): (r.n, r.previous, r.growth, r.slope) for r in market.skill_trend(df).collect()}
    months = [f"2026-0{m}" for m in range(1, 6)]
    for skill, counts in (("A", [2, 0, 0, 0, 1]), ("B", [1, 0, 0, 0, 0])):
        mean = sum(counts) / 5
        slope = sum((i - 2) * (n - mean) for i, n in enumerate(counts)) / 10
        for i, month in enumerate(months):
            before = counts[i - 1] if i else None
            growth = counts[i] / before - 1 if before else None
            assert got[skill, month] == (counts[i], before, growth, pytest.approx(slope))
    assert len(got) == 10
    one = market.skill_trend(df.limit(1)).collect()
    assert [(r.n, r.previous, r.slope) for r in one] == [(1, None, None)] and market.skill_trend(df.limit(0)).count() == 0


# --- corpus -----------------------------------------------------------------------------------


def test_tfidf(spark):
    df = spark.createDataFrame([(1, "a a b"), (2, "b c"), (3, "b")], "id int, t string")
    got = pairs(corpus.tfidf(df, "id", tok.tokenize(c("t"))), "id", "term", "tf", "df", "weight")
    ln = math.log(3)
    assert got == [
        (1, "a", 2, 1, pytest.approx(2 * ln)), (1, "b", 1, 3, 0.0), (2, "b", 1, 3, 0.0),
        (2, "c", 1, 1, pytest.approx(ln)), (3, "b", 1, 3, 0.0),
    ]


def test_pii_and_pay(spark):
    df = spark.createDataFrame(
        [("mail a.b@c.org or 10.0.0.1, call +1 555-123-4567 or (555) 123-4567",)], "t string"
    )
    masked = df.select(tok.pii_mask(c("t"))).first()[0]
    assert masked == "mail [EMAIL] or [IP], call [PHONE] or [PHONE]"
    pay = spark.createDataFrame([("$100k-120k per year",), ("competitive",), (None,)], "t string")
    got = [tuple(r.p) for r in pay.select(tok.pay(c("t")).alias("p")).collect()]
    assert got == [(100000.0, 120000.0, "USD", "year"), (None,) * 4, (None,) * 4]


def test_language_agrees_with_the_label(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = corpus.language_filter(docs, keep=("en", "fr", "de", "es", "unknown"))
    right = found.filter(c("language") == c("lang")).count()
    assert right >= 0.95 * docs.count()


def test_connected_groups_on_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(300, j) for j in range(301, 340)]
    edges += [(rng.randint(500, 560), rng.randint(500, 560)) for _ in range(40)]
    edges = [(a, b) for a, b in edges if a != b]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    got = {r.node: r.group for r in near_dup.connected_groups(df).collect()}
    assert got == {n: root(n) for n in parent}


def _jaccard(a, b):
    def grams(text):
        ts = re.findall(r"[^\W_]+", text.lower())
        return {tuple(ts[i : i + 3]) for i in range(len(ts) - 2)} or ({tuple(ts)} if ts else set())

    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x | y else 0.0


def test_near_dup_against_all_pairs(spark):
    """Groups are the connected parts of "alike enough", found here pair by pair."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(12)]
    texts += [t + " extra" for t in texts[:5]] + [texts[0], texts[0], "Data Scientist", "", "data scientist!", "!!", "?"]
    for _ in range(30):  # about 0.4 alike: stay apart
        a = rng.choices(words, k=70)
        texts += [" ".join(a), " ".join(a[:40] + rng.choices(words, k=30))]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string")
    group = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if (texts[a] == texts[b] or _jaccard(texts[a], texts[b]) >= 0.8) and group[a] != group[b]:
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = [new if g == old else g for g in group]
    got = {r.id: r.group for r in near_dup.near_dup(df, "id", c("t")).collect()}
    assert got == dict(enumerate(group))
    assert group[12] == 0 and group[17] == 0 and group[21] == 19


def _groups(texts, similarity=0.8):
    """Smallest place over links, all pairs looked at; ``None`` stands for null."""
    group = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        same = texts[a] == texts[b] or (None not in (texts[a], texts[b]) and _jaccard(texts[a], texts[b]) >= similarity)
        if same and group[a] != group[b]:
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = [new if g == old else g for g in group]
    return dict(enumerate(group))


def _near_dup(spark, texts, **settings):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string").repartition(3)
    return {r.id: r.group for r in near_dup.near_dup(df, "id", c("t"), **settings).collect()}


def _star(n, whole=400, cut=20, own=50):
    """An original, last, and copies that are alike only to it: each lacks one part and has words of its own."""
    words = [f"w{i}" for i in range(whole)]
    copies = []
    for i in range(n):
        at = cut * i
        copies.append(" ".join(words[:at] + words[at + cut :] + [f"own{i}x{j}" for j in range(own)]))
    return [*copies, " ".join(words), "something else entirely"]


def test_near_dup_star_with_the_largest_centre(spark):
    texts = _star(12)
    assert _groups(texts) == {**dict.fromkeys(range(13), 0), 13: 13}
    assert all(_jaccard(a, b) < 0.8 for a, b in itertools.combinations(texts[:12], 2))
    assert _near_dup(spark, texts) == _groups(texts)


@pytest.mark.parametrize("seed, bands, block", [(1, 8, 50_000), (2, 1, 50_000), (3, 4, 4), (4, 8, 4)])
def test_near_dup_around_the_bound(spark, monkeypatch, seed, bands, block):
    """Families of texts with similarities on both sides of the bound, few hubs, lists in blocks."""
    monkeypatch.setattr(set_join, "BLOCK", block)
    rng = random.Random(seed)
    texts = [None, "", "one", "One!", "one two", None, "?", "?"]
    for family in range(6):
        frame = [f"f{rng.randrange(60)}" for _ in range(50)]
        for _ in range(14):
            words = list(frame)
            for _ in range(rng.randrange(6)):
                words[rng.randrange(len(words))] = f"f{rng.randrange(60)}"
            texts.append(" ".join(words[: rng.randrange(44, 51)]))
    rng.shuffle(texts)
    assert _near_dup(spark, texts, bands=bands, rows=2) == _groups(texts)


def test_near_dup_odd_tables(spark):
    schema = "id string, t string, key int, group int, text int"
    rows = [("a", "x y z", 1, 1, 1), ("a", "x y z", 1, 1, 1), ("b", "x y z", 2, 2, 2), (None, "x y z", 3, 3, 3), (None, None, 4, 4, 4)]
    got = near_dup.near_dup(spark.createDataFrame(rows, schema), "id", c("t")).collect()
    assert sorted(map(tuple, got), key=repr) == [("a", "a"), ("a", "a"), ("b", "a"), (None, None), (None, None)]
    assert near_dup.near_dup(spark.createDataFrame([], schema), "id", c("t")).count() == 0


def test_postings_of_one_hub_are_left_out(spark):
    schema = "key long, hub long, size int, tokens array<long>, blocks array<int>"
    rows = [(1, 1, 3, [7, 8, 9], None), (2, 1, 3, [7, 8], None), (5, 5, 3, [8], None), (6, 6, 2, [4, 7], [0, -1])]
    got = set_join.postings(spark.createDataFrame(rows, schema)).select("token", "block", "key", "hub", "size", "place")
    assert sorted(map(tuple, got.collect())) == [
        (4, 0, 6, 6, 2, 0), (7, -1, 1, 1, 3, 0), (7, -1, 2, 1, 3, 0), (7, -1, 6, 6, 2, 1),
        (8, -1, 1, 1, 3, 1), (8, -1, 2, 1, 3, 1), (8, -1, 5, 5, 3, 0),
    ]
    alone = spark.createDataFrame(rows[:2], schema)
    assert set_join.postings(alone).count() == 0


def test_near_dup_joins_texts_with_their_firsts_and_not_postings(spark, monkeypatch):
    """Shared postings outgrow the texts, so what is known of a text is joined while it is one row."""
    seen, as_first = [], near_dup.as_first
    monkeypatch.setattr(near_dup, "as_first", lambda df, firsts: seen.append(df.columns) or as_first(df, firsts))
    texts = ["a b c d e f g h i j", "a b c d e f g h i k", "z y x w v u", "a b c d e f g h i j"]
    assert _near_dup(spark, texts) == _groups(texts)
    assert seen and not any("token" in columns for columns in seen)


def test_connected_groups_of_stars_take_no_round(spark, monkeypatch):
    looked_up, lookup = [], near_dup.lookup
    monkeypatch.setattr(near_dup, "lookup", lambda *a: looked_up.append(a) or lookup(*a))
    stars = spark.createDataFrame([(1, 5), (6, 1), (3, 2), (7, 7)], "src long, dst long")
    got = {r.node: r.group for r in near_dup.connected_groups(stars).collect()}
    assert got == {1: 1, 5: 1, 6: 1, 2: 2, 3: 2} and not looked_up
    chain = spark.createDataFrame([(i + 1, i) for i in range(40)], "src long, dst long")
    got = {r.node: r.group for r in near_dup.connected_groups(chain).collect()}
    assert got == dict.fromkeys(range(41), 0) and looked_up


def test_near_dup_steps_do_not_grow_with_unlike_members(spark):
    """A common frame puts all texts in common buckets and lists; only connecting links takes rounds."""
    frame = " ".join(f"w{i}" for i in range(30))
    sizes = []
    for n in (4, 32):
        texts = [f"{frame} " + " ".join(f"own{i}x{j}" for j in range(15)) for i in range(n)]
        assert _jaccard(texts[0], texts[1]) < 0.7
        df = spark.createDataFrame(list(enumerate(texts)), "key bigint, text string").repartition(2)
        none = spark.createDataFrame([], "key bigint, first bigint")
        name = f"near-dup-{n}"
        spark.sparkContext.setJobGroup(name, name)
        assert near_dup.alike(df, 0.8, 3, 8, 1, none).count() == 0
        sizes.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sizes[1] <= sizes[0] + 2


def test_prefix_keeps_every_alike_pair():
    """Whatever the order of the shingles, alike sets share one in their prefixes, at fitting places."""
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        a = rng.choice(60, n, replace=False)
        b = np.unique(np.append(rng.choice(a, max(1, n - int(rng.integers(0, 4))), replace=False), rng.choice(60, int(rng.integers(0, 3)))))
        same = len(np.intersect1d(a, b))
        if same / (len(a) + len(b) - same) < 0.8:
            continue
        order = rng.permutation(60)
        a, b = (sorted(x, key=lambda v: order[v]) for x in (a, b))
        heads = [x[: set_join.prefix_length(len(x), 0.8)] for x in (a, b)]
        places = [(i, heads[1].index(v)) for i, v in enumerate(heads[0]) if v in heads[1]]
        fits = [min(i, j) + min(len(a) - i, len(b) - j) >= 0.8 / 1.8 * (len(a) + len(b)) - 1e-6 for i, j in places]
        assert fits and all(fits)


def test_archetypes_by_hand(spark, sf_dir):
    """Each posting is in the cluster of its nearest centre, centres are the means of their clusters."""
    df = inputs.parsed_table(spark, sf_dir)
    df = df.select("doc_id", tok.tokenize(c("job_description_raw")).alias("tokens")).limit(60).checkpoint()
    centres, clusters = models.archetypes(df, "doc_id", c("tokens"), k=3, rounds=2)
    docs = {r.doc_id: r.tokens for r in df.collect()}
    seen = Counter(t for ts in docs.values() for t in set(ts))
    vectors = {}
    for key, ts in docs.items():
        w = {t: n * math.log(len(docs) / seen[t]) for t, n in Counter(ts).items() if seen[t] < len(docs)}
        norm = math.sqrt(sum(x * x for x in w.values()))
        vectors[key] = {t: x / norm for t, x in w.items()}
    order = sorted(vectors, key=lambda k: hashlib.md5(str(k).encode()).hexdigest())
    cluster = {k: i for i, k in enumerate(order[:3])}
    for _ in range(3):
        centre = []
        for i in range(3):
            total = Counter()
            for k in [k for k, v in cluster.items() if v == i]:
                total.update(vectors[k])
            norm = math.sqrt(sum(x * x for x in total.values()))
            centre.append({t: x / norm for t, x in total.items()})
        cluster = {
            k: max(range(3), key=lambda i: (round(sum(x * centre[i].get(t, 0) for t, x in v.items()), 9), -i))
            for k, v in vectors.items()
        }
    assert {r.doc_id: r.cluster for r in clusters.collect()} == cluster and len(set(cluster.values())) > 1
    for r in centres.collect():
        assert r.weight == pytest.approx(centre[r.cluster][r.term])
    # rows without a telling term, and no rows at all
    odd = spark.createDataFrame([(1, ["a"]), (2, ["a", "b"]), (3, []), (4, None)], "id int, ts array<string>")
    assert pairs(models.archetypes(odd, "id", c("ts"), k=2)[1].na.fill(-1), "id", "cluster") == [(1, 0), (2, 1), (3, -1), (4, -1)]
    assert models.archetypes(odd.limit(0), "id", c("ts"))[1].count() == 0


def test_roles_of_rows_kept_from_training(spark):
    df = inputs.parsed_table(spark, "/root/testdata/sf0.01")
    df = df.select("doc_id", "role_type", tok.tokenize(c("job_description_raw")).alias("tokens"))
    kept = df.filter(models.held_out(c("doc_id")))
    model = models.role_classifier(df.filter(~models.held_out(c("doc_id"))), "doc_id", c("tokens"))
    right = models.predict_role(model, kept, "doc_id", c("tokens")).join(kept, "doc_id").filter("role_type = predicted_role").count()
    most = max(r["count"] for r in kept.groupBy("role_type").count().collect())
    assert right > most  # better than naming the most frequent role


def test_roles_by_hand(spark):
    rows = [(1, "x", ["a", "a", "b"]), (2, "y", ["b", "c"]), (3, "x", []), (4, None, ["c", "c"]), (5, "y", None)]
    df = spark.createDataFrame(rows, "id int, role string, ts array<string>")
    model = models.role_classifier(df, "id", c("ts"), "role")
    ask = spark.createDataFrame([(1, ["a"]), (2, ["c", "c"]), (3, ["unknown"]), (4, []), (5, None), (6, ["b"])], "id int, ts array<string>")
    counts = {"x": Counter("aab"), "y": Counter("bc")}

    def score(role, ts):  # two rows of each role, three terms
        total = sum(counts[role].values()) + 3
        return math.log(2 / 4) + sum(math.log((counts[role][t] + 1) / total) for t in ts or [])

    want = [(r.id, min("xy", key=lambda role: (-round(score(role, r.ts), 9), role))) for r in ask.collect()]
    assert pairs(models.predict_role(model, ask, "id", c("ts")), "id", "predicted_role") == want
    nobody = models.role_classifier(df.filter("role is null"), "id", c("ts"), "role")
    assert pairs(models.predict_role(nobody, ask.limit(1), "id", c("ts")), "id", "predicted_role") == [(1, None)]


def test_lemmatize_spreads_equal_rows(spark):
    """Rows that are nothing but the token, nine of ten the same."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        token = F.when(c("id") % 10 != 0, "jobs").otherwise((c("id") % 5000).cast("string"))
        rows = spark.range(200_000).select(token.alias("token"))
        lemmas = spark.createDataFrame([("jobs", "job")], "token string, lemma string")
        found = corpus.lemmatize(rows, lemmas).withColumn("task", F.spark_partition_id())
        tasks = found.groupBy("task").agg(F.count(F.lit(1)).alias("n")).collect()
        counts = {r.lemma: r.n for r in corpus.lemma_counts(rows, lemmas).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = [r.n for r in tasks]
    assert sum(sizes) == 200_000 and max(sizes) < 2 * 200_000 / len(sizes)
    assert counts["job"] == 180_000 and found.filter("lemma = 'job'").count() == 180_000


def test_job_company_spreads_jobs_without_a_company(spark, sf_dir):
    companies = inputs.raw_companies(spark, sf_dir).transform(history.dedup_companies)
    some = companies.select("company_identity.company_id_hash").first()[0]
    jobs = spark.range(20_000).select(
        "id", F.struct(F.when(c("id") % 10 == 0, some).alias("company_id_hash")).alias("company_info")
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        joined = history.job_company(jobs, companies).withColumn("task", F.spark_partition_id())
        tasks = joined.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.count("company_name").alias("named")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r.n for r in tasks]
    assert sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / len(sizes)
    assert sum(r.named for r in tasks) == 2000


def test_rows_without_a_key_stay(spark):
    df = spark.createDataFrame([(None, "1", "x"), (None, "1", "x"), ("a", "1", "x"), ("a", "2", "y")], "k string, ts string, h string")
    latest = sorted(map(tuple, history.dedup_by_id(df, "k", "ts").collect()), key=str)
    assert latest == sorted([(None, "1", "x"), (None, "1", "x"), ("a", "2", "y")], key=str)
    changes = sorted(((r.k, r.ts, r.change) for r in history.change_history(df, "k", "ts", "h").collect()), key=str)
    assert changes == sorted([(None, "1", "new")] * 2 + [("a", "1", "new"), ("a", "2", "changed")], key=str)


def test_writing_a_run_again_replaces_it(spark, sf_dir, tmp_path):
    from hirelens.sources import archive, sinks

    df = inputs.parsed(spark, sf_dir).select(*schemas.PARSED_JOB.names).limit(30).checkpoint()
    for run in ("r1", "r2", "r1"):
        paths = sinks.write_dataset(df, str(tmp_path), run)
    assert archive.scan_dataset(spark, paths["parquet"]).count() == 60
    assert spark.read.parquet(paths["parquet_latest"]).count() == 30


def test_ranks_follow_the_whole_score(spark):
    df = spark.createDataFrame([("k", 1, 0.71234), ("k", 2, 0.71231), ("k", 3, 0.71234), ("k", 4, 1.0), (None, 5, 0.5)], "g string, i int, s double")
    assert pairs(skew.rank_by_score(df, ["g"], "s"), "i", "rank") == [(1, 2), (2, 4), (3, 2), (4, 1), (5, 1)]


def test_texts_of_a_batch_are_not_all_objects_at_once():
    import tracemalloc

    batch = pa.RecordBatch.from_pydict({"key": range(4000), "text": [f"{i} " * 1500 for i in range(4000)]})
    want = batch.column(1).to_pylist()
    tracemalloc.start()
    places = [key for key, text in set_join.texts([batch], once=True) if text == want[key]]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert places == list(range(4000)) and peak < 10_000_000


def test_lookup_shuffles_rows_without_a_second_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, word string")
    table = spark.createDataFrame([("a", 5, 1)], "word string, value int, count int")
    plan = skew.lookup(df, table, "word", "count")._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    assert "_probe" not in text
    left = re.findall(r"Project \[(.*)\]", text)[1]  # what the shuffled join gets of a row
    assert len(re.findall(r"word#", left)) == 1 and not re.search(r"\b_hot#", left)


def test_scores_add_up_hot_terms_by_key_before_they_are_shuffled(spark):
    vectors = spark.createDataFrame([(k, t, 0.5) for k in range(20) for t in "abcdef"], "k long, term string, w double")
    weights = spark.createDataFrame(
        [(n, t, 20, 1.0) for n in (0, 1) for t in "abcdef"], "cluster int, term string, df long, weight double"
    )
    found = models.scores(vectors, "k", weights, "cluster", "w")
    assert {(r.k, r.cluster, r.score) for r in found.collect()} == {(k, n, 3.0) for k in range(20) for n in (0, 1)}
    assert re.search(r"xxhash64\(k#\d+L?, 42\)", found._jdf.queryExecution().optimizedPlan().toString())


def test_unit_vectors_have_length_one_and_leave_out_null_keys(spark):
    df = spark.createDataFrame([(1, "a b b"), (2, "b c"), (2, "c d"), (None, "x")], "k int, t string")
    found = models.unit_vectors(df, "k", F.split("t", " ")).collect()
    lengths = Counter()
    for r in found:
        lengths[r.k] += r.w * r.w
    assert set(lengths) == {1, 2} and all(abs(v - 1) < 1e-9 for v in lengths.values())


def test_a_table_of_one_row_group_is_dealt_to_all_tasks(spark, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    rows.coalesce(1).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        counts = inputs.table(spark, str(tmp_path), "documents").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sum(r["count"] for r in counts) == 4000
    assert max(r["count"] for r in counts) < 1000


def test_tables_that_grow_are_not_broadcast(spark):
    """Pairs, sets and lists are far larger as rows than what Spark takes them for, so no size decides."""
    keys = spark.range(50).withColumnRenamed("id", "key")
    sets = keys.withColumn("shingles", F.array("key", F.lit(-1).cast("bigint")))
    pairs = keys.select((c("key") + 1).alias("src"), c("key").alias("dst")).filter("src < 50")
    posted = keys.selectExpr("key % 7 as token", "key", "key as hub", "3 as size", "0 as place")
    groups = pairs.toDF("node", "group")
    table = keys.withColumn("n", F.lit(1))
    for df in (
        set_join.distances(pairs, sets),
        set_join.prefix_pairs(posted, "key", 0.8),
        near_dup.as_first(keys, pairs.toDF("key", "first")),
        near_dup.apart_still(pairs, groups),
    ):
        df.count()
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    joins = lambda grows: skew.lookup(keys, table, "key", "n", grows=grows)._jdf.queryExecution().executedPlan().toString()
    assert joins(True).count("SortMergeJoin") == 1 and joins(True).count("BroadcastHashJoin") == 1  # the hot keys
    assert sorted(skew.lookup(keys, table, "key", "n", grows=True).collect()) == [(i, 1) for i in range(50)]


def test_products_of_text_matches_are_not_shuffled(spark):
    """The weights of a small second table come to the pairs whatever Spark takes its size for."""
    a = spark.createDataFrame([(i, [f"w{i % 7}", f"w{i % 5}", "x"]) for i in range(40)], "l int, ts array<string>")
    b = spark.createDataFrame([(f"p{i}", [f"w{i}", "x"]) for i in range(9)], "r string, ts array<string>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = text_match.text_matches(a, b, "l", "r", c("ts"), 3, 0.1)
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows and re.search(r"BroadcastHashJoin \[r#\d+, term#\d+\]", plan)


def test_terms_counted_in_their_rows(spark):
    """Rows with a key of their own, a repeated key and no key; null terms and no terms; more repeated keys than few."""
    rows = [(1, ["b", "a", "b"]), (2, ["c"]), (2, ["c", "d"]), (None, ["a"]), (None, ["a", "e"]), (3, []), (4, None), (5, ["f", None, "f"])]
    df = spark.createDataFrame(rows, "k int, ts array<string>")
    want = {(1, "a", 1), (1, "b", 2), (2, "c", 2), (2, "d", 1), (None, "a", 2), (None, "e", 1), (5, "f", 2)}
    for few in (1000, 0):
        corpus.FEW_REPEATED, before = few, corpus.FEW_REPEATED
        try:
            got = [tuple(r) for r in corpus.counts_by_row(df, "k", c("ts")).collect()]
        finally:
            corpus.FEW_REPEATED = before
        assert len(got) == len(want) and set(got) == want


def test_only_rare_keys_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(skew, "FREQUENT", 2)
    df = spark.createDataFrame([(i, "abcx"[i % 4]) for i in range(40)] + [(99, None)], "i int, t string")
    table = spark.createDataFrame([("a", 10, 1.0), ("b", 10, 2.0), ("c", 9, 3.0), ("d", 1, 4.0)], "t string, n int, v double")
    found = skew.meet(df, table, "t", "n")
    assert sorted((r.i, r.v) for r in found.collect()) == [(i, float(i % 4 + 1)) for i in range(40) if i % 4 < 3]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 1 and "BroadcastHashJoin" in plan


def test_role_scores_are_added_up_by_key_before_they_are_shuffled(spark):
    rows = [(i, "xyz"[i % 3], [f"w{i % 3}", "all"]) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, role string, ts array<string>")
    model = models.role_classifier(df, "id", c("ts"), "role")
    found = models.predict_role(model, df, "id", c("ts"))
    got = {r.id: r.predicted_role for r in found.collect()}
    assert got == {i: role for i, role, _ in rows}
    assert "hashpartitioning(id#" in found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(id#\d+, term#", found._jdf.queryExecution().executedPlan().toString())
