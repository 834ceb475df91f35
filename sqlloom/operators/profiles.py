"""Profiles, funnels and run summaries as long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sqlloom.functions.validity import valid_sqlite
from sqlloom.sources.sinks import SPLITS


def _counters(df: DataFrame, counters: dict[str, Column], name: str = "metric") -> DataFrame:
    """Several conditional totals in one pass, turned into (metric, value) rows."""
    pairs = [
        F.struct(F.lit(metric).alias(name), F.coalesce(value, F.lit(0)).cast("bigint").alias("value"))
        for metric, value in counters.items()
    ]
    return df.agg(F.array(*pairs).alias("rows")).selectExpr("inline(rows)")


def corpus_profile(df: DataFrame) -> DataFrame:
    """(metric, name, n): row count and the value counts of two columns, in one pass.

    Pairs are counted first, so the grouping sets triple a small table and not the source.
    """
    pairs = df.groupBy("sql_task_type", "sql_complexity").agg(F.count(F.lit(1)).alias("pair_n"))
    counts = pairs.groupingSets(
        [[], ["sql_task_type"], ["sql_complexity"]], "sql_task_type", "sql_complexity"
    ).agg(
        F.sum("pair_n").alias("n"),
        F.grouping("sql_task_type").alias("no_task"),
        F.grouping("sql_complexity").alias("no_complexity"),
    )
    metric = (
        F.when(F.col("no_task") == 0, F.lit("task_type_counts"))
        .when(F.col("no_complexity") == 0, F.lit("sql_complexity_counts"))
        .otherwise(F.lit("row_count"))
    )
    return counts.select(metric.alias("metric"), F.coalesce("sql_task_type", "sql_complexity").alias("name"), "n").orderBy(
        "metric", F.desc("n"), "name"
    )


def examples_profile(df: DataFrame) -> DataFrame:
    """(metric, name, n): rows, databases, invalid SQL, and the ten largest databases.

    Databases are grouped first, with partial counts before the shuffle; all figures come from
    that small table.
    """
    valid = valid_sqlite(F.coalesce("query", F.lit("")))
    per_db = (
        df.select("db_id", valid.alias("valid"))
        .groupBy("db_id")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("valid")).alias("invalid"))
    )
    totals = per_db.agg(
        F.array(
            *(
                F.struct(F.lit(metric).alias("metric"), F.lit(None).cast("string").alias("name"), value.alias("n"))
                for metric, value in (
                    ("row_count", F.coalesce(F.sum("n"), F.lit(0))),
                    ("database_count", F.count("db_id")),
                    ("sqlite_parse_failures", F.coalesce(F.sum("invalid"), F.lit(0))),
                )
            )
        ).alias("rows")
    ).selectExpr("inline(rows)")
    largest = per_db.orderBy(F.desc("n"), F.col("db_id")).limit(10)
    return totals.unionByName(
        largest.select(F.lit("top_databases").alias("metric"), F.col("db_id").alias("name"), "n")
    )


def first_example(df: DataFrame, columns: tuple[str, ...], ordinal: str) -> DataFrame:
    """The first row as (metric, name, value) text rows, columns by name."""
    fields = [
        F.struct(
            F.lit("example").alias("metric"),
            F.lit(c).alias("name"),
            F.col(c).cast("string").alias("value"),
        )
        for c in sorted(columns)
    ]
    first = df.select(ordinal, *columns).orderBy(ordinal).limit(1)
    return first.select(F.array(*fields).alias("rows")).selectExpr("inline(rows)")


def inspect_report(df: DataFrame, profile: DataFrame, columns: tuple[str, ...], ordinal: str) -> DataFrame:
    """Columns, profile and first example; writes nothing."""
    listed = F.array(*(F.struct(F.lit(c).alias("name"), F.lit(str(i)).alias("value")) for i, c in enumerate(df.columns)))
    # One row per column, carried by the one-row aggregate that also proves the table is readable.
    names = (
        df.agg(F.count(F.lit(1)).alias("n"))
        .select(F.explode(listed).alias("c"))
        .select(F.lit("columns").alias("metric"), "c.name", "c.value")
    )
    counted = profile.select("metric", "name", F.col("n").cast("string").alias("value"))
    return names.unionByName(counted).unionByName(first_example(df, columns, ordinal))


def curate_funnel(classified: DataFrame, reasons: tuple[str, ...]) -> DataFrame:
    """(metric, value) over ``drop_reason`` and ``dedupe_key`` (null on dropped rows).

    Grouping by both first leaves one row per distinct key, so duplicates are counted without
    ever bringing the copies of one key together.
    """
    groups = classified.groupBy("drop_reason", "dedupe_key").agg(F.count(F.lit(1)).alias("n"))
    alive = F.col("drop_reason").isNull()
    counters = {"seen": F.sum("n")}
    for reason in reasons:
        counters[reason] = F.sum(F.when(F.col("drop_reason") == reason, F.col("n")))
    counters["kept_before_dedupe"] = F.sum(F.when(alive, F.col("n")))
    counters["drop_duplicate"] = F.sum(F.when(alive, F.col("n") - 1))
    counters["kept_after_dedupe"] = F.count_if(alive)
    return _counters(groups, counters)


def prepare_funnel(classified: DataFrame) -> DataFrame:
    """(metric, value) over ``drop_reason`` and ``sql_valid``; invalid SQL is counted but kept."""
    alive = F.col("drop_reason").isNull()
    return _counters(
        classified,
        {
            "seen": F.count(F.lit(1)),
            "drop_missing_fields": F.count_if(F.col("drop_reason") == "drop_missing_fields"),
            "drop_missing_schema": F.count_if(F.col("drop_reason") == "drop_missing_schema"),
            "sqlite_parse_failed": F.count_if(alive & ~F.col("sql_valid")),
            "kept": F.count_if(alive),
        },
    )


def split_sizes(df: DataFrame) -> DataFrame:
    """(metric, value) per split; an empty split shows 0."""
    return _counters(df, {name: F.count_if(F.col("split") == name) for name in SPLITS})


def run_summary(
    dataset: str,
    columns: list[str],
    profile: DataFrame,
    funnel: DataFrame,
    curated: DataFrame,
    seed: int,
    texts: dict[str, str] | None = None,
) -> DataFrame:
    """Everything about one run as (section, metric, value, text): numbers have a value, the facts in
    ``texts`` a text."""
    sizes = split_sizes(curated)
    fixed = [("seed", "seed", F.lit(int(seed)))]
    fixed += [("columns", c, F.lit(i)) for i, c in enumerate(columns)]
    facts = F.array(
        *(
            F.struct(F.lit(s).alias("section"), F.lit(m).alias("metric"), v.cast("bigint").alias("value"))
            for s, m, v in fixed
        )
    )
    total = sizes.agg(F.sum("value").alias("value"))
    before = F.when(F.col("name").isNull(), F.col("metric")).otherwise(
        F.concat_ws("/", "metric", "name")
    )
    told = F.array(
        *(F.struct(F.lit("facts").alias("section"), F.lit(k).alias("metric"), F.lit(None).cast("bigint").alias("value"), F.lit(v).alias("text")) for k, v in (texts or {}).items())
    )
    numbers = (
        profile.select(F.lit("profile_before").alias("section"), before.alias("metric"), F.col("n").alias("value"))
        .unionByName(funnel.select(F.lit("funnel").alias("section"), "metric", "value"))
        .unionByName(sizes.select(F.lit("split_sizes").alias("section"), "metric", "value"))
        .unionByName(total.select(F.lit("sample_size").alias("section"), F.lit(dataset).alias("metric"), "value"))
        .unionByName(total.select(F.explode(facts).alias("f")).select("f.*"))
    ).withColumn("text", F.lit(None).cast("string"))
    return numbers.unionByName(total.select(F.explode(told).alias("f")).select("f.*")) if texts else numbers
