"""Steps whose tasks must not grow with the table."""

import re

from pyspark.sql import functions as F

from sqlloom.checks.training import exploded
from sqlloom.functions import tokens
from sqlloom.operators.catalog import normalize_catalog
from sqlloom.plans import jobs, views
from sqlloom.sources import spread as spreading

CATALOG = (
    "db_id string, table_names_original array<string>, column_names_original array<array<string>>,"
    " column_types array<string>, primary_keys array<int>, foreign_keys array<array<int>>, ordinal long"
)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_catalog_entries_are_dealt_out_before_they_are_sorted(spark):
    rows = [(f"d{i % 3}" if i % 4 else None, [f"t{i}"], [["0", "c"]], ["text"], None, None, i) for i in range(60)]
    last = normalize_catalog(spark.createDataFrame(rows, CATALOG).coalesce(1))
    assert re.search(r"Repartition\w* \[db_id#\d+, ordinal#\d+L?\]", plan(last))
    wanted = {r[0]: r[1] for r in sorted(rows, key=lambda r: r[-1])}
    assert {r.db_id: r.tables for r in last.collect()} == wanted


def test_catalog_sorts_are_cut_by_size_and_not_merged_again(spark, monkeypatch):
    rows = [(f"d{i % 40}" if i % 4 else None, [f"t{i}"], [["0", "c" * 50]], ["text"], None, None, i) for i in range(400)]
    # One database has an entry without an ordinal, which never wins, another has only such an entry.
    rows += [("d1", ["never"], None, None, None, None, None), ("unplaced", ["lost"], None, None, None, None, None)]
    monkeypatch.setattr(spreading, "SORTED_BYTES", 1000, raising=False)
    last = normalize_catalog(spark.createDataFrame(rows, CATALOG).coalesce(1))
    assert last.rdd.getNumPartitions() > 30 > 2 * spark.sparkContext.defaultParallelism
    wanted = {r[0]: r[1] for r in sorted(rows[:400], key=lambda r: r[-1])}
    got = last.collect()
    assert {r.db_id: r.tables for r in got if r.tables} == wanted
    assert sum(r.tables is None for r in got) == 1


def test_exploding_messages_builds_them_once(spark):
    rows = spark.range(3).select(F.col("id").alias("example_id"), F.col("id").cast("string").alias("text"))
    chat = F.concat(*(F.array(F.struct(F.lit(r).alias("role"), F.repeat("text", i).alias("content"))) for i, r in enumerate("abc", 1)))
    out = exploded(rows.repartition(2).select("example_id", chat.alias("messages")))
    assert "Filter" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, out.where("example_id = 1").collect())) == [(1, 0, "a", "1"), (1, 1, "b", "11"), (1, 2, "c", "111")]


def test_spread_makes_more_tasks_of_larger_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    spark.range(100_000).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert spreading.spread(df, "id").rdd.getNumPartitions() == cores
    monkeypatch.setattr(spreading, "TASK_BYTES", 10_000)
    wide = spreading.spread(df, "id")
    assert wide.rdd.getNumPartitions() > 2 * cores
    assert wide.agg(F.count("id"), F.sum("id")).first() == (100_000, 4_999_950_000)


def test_limited_ids_are_those_of_the_expression(spark):
    texts = [None, "", " ", "".join(map(chr, range(128))), "a<|im_start|>b1 2c_<|im_en<|im_end|>\n", "é1 x", "x" * 500 + " ½²Ⅷ 漢字  y", "\x85a"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for limit in (0, 3, 1000):
        # Nulls come as empty texts here; tokenize() never passes one.
        row = df.select(F.coalesce("text", F.lit("")).alias("text")).select(
            tokens.limited_ids(F.col("text"), limit).alias("got"), tokens.hashed(F.col("text"), limit).alias("want")
        )
        assert all(r.got == r.want for r in row.collect())


def test_tokenizer_over_the_validity_check_in_one_plan(spark, sf):
    classified = jobs.classify_examples(views.examples(spark, sf), views.raw_catalog(spark, sf))
    rows = jobs.with_messages(jobs.prepared_rows(classified))
    assert jobs.supervised_rows(rows).count() == rows.count() > 0


def test_prepared_rows_are_dealt_by_size_before_they_are_sorted_by_split(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(spreading, "SORTED_BYTES", 10_000, raising=False)
    jobs.run_prepare(views.examples(spark, sf).limit(1000), views.raw_catalog(spark, sf).limit(200), str(tmp_path / "p"))
    assert len(list((tmp_path / "p" / "all_cleaned" / "split=train").glob("part-*"))) > 2 * spark.sparkContext.defaultParallelism
