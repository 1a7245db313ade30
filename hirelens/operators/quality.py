"""Quality levels, coverage, failure and schema reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import rules, schemas


def quality_level(*critical: Column) -> Column:
    """``high`` with all critical fields present, ``medium`` with some, ``low`` with none."""
    found = reduce(add, [c.isNotNull().cast("int") for c in critical])
    return F.when(found >= len(critical), "high").when(found >= 1, "medium").otherwise("low")


def percent(part: Column, whole: Column) -> Column:
    return F.round(100.0 * part / whole, 1)


def quality_distribution(df: DataFrame, level: Column) -> DataFrame:
    """Rows and percent per known level, best first. Levels without rows are listed with 0.

    One global aggregate: three counters, whatever the number of rows.
    """
    known = rules.QUALITY_LEVELS
    counts = df.agg(*[F.count_if(level == name).alias(name) for name in known])
    total = reduce(add, [F.col(name) for name in known])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("level"), F.col(name).alias("n"), total.alias("total"))
            for name in known
        ]
    )
    return counts.select(F.inline(rows)).select(
        "level", "n", F.when(F.col("total") > 0, percent(F.col("n"), F.col("total"))).alias("pct")
    )


def field_coverage(df: DataFrame, name_has: tuple[str, ...] = ("raw", "hash")) -> DataFrame:
    """Non-null count and percent of every leaf field whose path names ``raw`` or ``hash``.

    One pass and one aggregate; turning it into rows happens on a single row.
    """
    paths = [p for p in schemas.leaf_paths(df.schema) if any(n in p for n in name_has)]
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(F.col(p)).alias(p) for p in paths]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(p).alias("field"),
                F.col(f"`{p}`").alias("non_null"),
                F.col("rows"),
            )
            for i, p in enumerate(paths)
        ]
    )
    return counted.select(F.inline(rows)).select(
        "position",
        "field",
        "non_null",
        "rows",
        F.when(F.col("rows") > 0, percent(F.col("non_null"), F.col("rows"))).alias("pct"),
    )


def first_row(df: DataFrame, order: Sequence[Column], keys: int = 10) -> DataFrame:
    """``position, field, non_null`` for the first top-level fields of the first row by ``order``:
    how many of the field's own leaves that row has set."""
    fields = [f for f in df.schema.fields[:keys]]
    counts = []
    for f in fields:
        nested = isinstance(f.dataType, T.StructType)
        leaves = schemas.leaf_paths(f.dataType, f.name + ".") if nested else [f.name]
        counts.append(reduce(add, [F.col(p).isNotNull().cast("bigint") for p in leaves]))
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("field"), n.alias("non_null"))
        for i, (f, n) in enumerate(zip(fields, counts))
    ]
    return df.orderBy(*order).limit(1).select(F.inline(F.array(*rows)))


def failure_report(rejects: DataFrame) -> DataFrame:
    """Failures per reason, most frequent first, with their total.

    The total is summed over the per-reason counts, so only those meet in one place.
    """
    reasons = rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    total = reasons.agg(F.sum("n").alias("total_failures"))
    return reasons.withColumn("total_failures", total.scalar()).orderBy(F.desc("n"), "reason")


def report(rejects: DataFrame, schema_validation: DataFrame, created: Column) -> DataFrame:
    """One-row report: failure counts by reason and the result of the schema check."""
    failures = (
        rejects.groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_failures"),
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "n")))).alias(
                "failure_reasons"
            ),
        )
    )
    return failures.select(
        created.cast("string").alias("timestamp"),
        F.lit(rules.PARSED_SCHEMA_VERSION).alias("schema_version"),
        F.lit(rules.DATASET_VERSION).alias("dataset_version"),
        F.struct("total_failures", "failure_reasons").alias("scrape_report"),
        schema_validation.select(F.struct("*")).scalar().alias("schema_validation"),
    )


def column_sets(df: DataFrame, expected: T.StructType) -> tuple[list[str], list[str]]:
    """Columns that are missing and columns that are extra. Names only; no data is read."""
    missing = [f.name for f in expected if f.name not in df.columns]
    extra = [c for c in df.columns if c not in expected.names]
    return missing, extra


def schema_report(df: DataFrame, expected: T.StructType = schemas.PARSED_JOB) -> DataFrame:
    """One row: missing and extra columns, cells of list columns that are no list, row count.

    A list column of another type has every cell wrong; of the right type, its nulls.
    """
    missing, extra = column_sets(df, expected)
    lists = [
        f.name for f in expected if isinstance(f.dataType, T.ArrayType) and f.name in df.columns
    ]

    def wrong(name: str) -> Column:
        right_type = isinstance(df.schema[name].dataType, T.ArrayType)
        return F.count_if(F.col(name).isNull()) if right_type else F.count(F.lit(1))

    counted = df.agg(F.count(F.lit(1)).alias("row_count"), *[wrong(n).alias(n) for n in lists])
    issues = reduce(add, [F.col(n) for n in lists], F.lit(0))

    def names(values: list[str]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    return counted.select(
        ((issues == 0) & F.lit(not missing)).alias("valid"),
        names(missing).alias("missing_columns"),
        names(extra).alias("extra_columns"),
        F.map_filter(
            F.create_map(*[c for n in lists for c in (F.lit(n), F.col(n))]).cast(
                "map<string, bigint>"
            ),
            lambda _, n: n > 0,
        ).alias("list_format_issues"),
        "row_count",
        F.lit(rules.PARSED_SCHEMA_VERSION).alias("schema_version"),
    )


def run_summary(kept: DataFrame, rejects: DataFrame, run: str, reject_run: str) -> DataFrame:
    """Records and failures per run. Both sides are counted before they meet."""
    records = kept.groupBy(F.col(run).alias("run_ts")).agg(F.count(F.lit(1)).alias("records"))
    failures = rejects.groupBy(F.col(reject_run).alias("run_ts")).agg(
        F.count(F.lit(1)).alias("failures")
    )
    return records.join(failures, "run_ts", "full").na.fill(0, ["records", "failures"])
