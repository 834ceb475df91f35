"""Joins, dedupe, ranks and splits: brute force, hot keys, repartitioning."""

import json
import math
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from sqlloom.checks import training  # noqa: F401  (registration)
from sqlloom.checks.registry import QUERIES
from sqlloom.operators import catalog, dedupe, leaks, profiles, ranking
from sqlloom.operators.joins import fits_broadcast, hot_keys, lookup, measured_size, salt_of
from sqlloom.options import JoinOptions, SplitRatios

LARGE = JoinOptions(broadcast_max_rows=0, broadcast_max_bytes=0, salts=8)


@pytest.fixture(scope="module")
def hot(spark):
    """30,000 rows; one key holds a third of them."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(30_000).select("id", key.alias("key"))


def test_lookup_small_and_large_agree(spark, hot):
    table = hot.select("key").distinct().where("key <> 'k7'").withColumn("v", F.length("key"))
    small = lookup(hot, table, "key", "id").orderBy("id").collect()
    large = lookup(hot, table, "key", "id", LARGE).orderBy("id").collect()
    assert small == large
    assert len(small) == 30_000
    assert Counter(r.v is None for r in small)[True] == hot.where("key = 'k7'").count()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_lookup_spreads_a_hot_key(spark, hot):
    few = replace(LARGE, hot_share=0.1)
    assert [r.key for r in hot_keys(hot, "key", few).collect()] == ["hot"]
    is_hot = F.col("key") == "hot"
    salted = hot.select("key", salt_of("key", "id", LARGE.salts, is_hot).alias("salt"))
    sizes = [r["count"] for r in salted.where(is_hot).groupBy("salt").count().collect()]
    assert len(sizes) == LARGE.salts and max(sizes) < 2 * 10_000 / LARGE.salts
    assert salted.where(~is_hot).select("salt").distinct().count() == 1
    table = hot.select("key").distinct().withColumn("v", F.length("key"))
    got = lookup(hot, table, "key", "id", few)
    assert got.where("v = length(key)").count() == got.count() == 30_000


def test_large_lookup_is_never_broadcast(spark, hot):
    """A table that is large by its rows but small in its files."""
    table = hot.select("key").distinct().withColumn("v", F.repeat(F.lit("x"), 50_000))
    plan = plan_of(lookup(hot, table, "key", "id", JoinOptions(broadcast_max_bytes=1 << 20)))
    joins = [x for x in plan.splitlines() if "Join" in x and "__salt" in x]
    assert joins and all("ShuffledHashJoin" in x for x in joins)


def test_leak_flags_by_a_large_list_move_wide_rows_once(spark):
    rows = spark.range(3_000).selectExpr("id", "concat('q', id % 700) AS q", "concat('select ', id % 900) AS s", "repeat('w', 50) AS wide")
    listed = spark.range(50).selectExpr("concat('q', id) AS question", "CAST(NULL AS STRING) AS prompt", "concat('select ', id + 100) AS sql", "CAST(NULL AS STRING) AS query")
    flags = [leaks.flag_leaks(rows, listed, F.col("q"), F.col("s"), "id", o) for o in (JoinOptions(), LARGE)]
    exchanges = [x for x in plan_of(flags[1]).splitlines() if "Exchange" in x]
    small, large = (sorted(map(tuple, f.collect())) for f in flags)
    assert small == large and sum(r[-1] for r in small) == sum(i % 700 < 50 or 100 <= i % 900 < 150 for i in range(3_000))
    assert sum("hashpartitioning(id" in x for x in exchanges) <= 2  # the rows, and the ids found


def test_large_lookup_spreads_rows_without_a_key(spark, hot):
    gaps = hot.withColumn("key", F.when(F.col("key") != "hot", F.col("key")))
    table = hot.select("key").distinct().withColumn("v", F.lit(1))
    joined = lookup(gaps, table, "key", "id", LARGE)
    assert joined.count() == 30_000 and joined.where("v IS NULL").count() == 10_000
    lost = gaps.where("key IS NULL").withColumn("salt", salt_of("key", "id", LARGE.salts, F.lit(False)))
    per_task = lost.repartition(50, "key", "salt").groupBy(F.spark_partition_id()).count()
    sizes = [r["count"] for r in per_task.collect()]
    assert len(sizes) == 50 and max(sizes) < 2 * 10_000 / 50


def test_size_check_counts_rows_and_bytes(spark):
    df = spark.createDataFrame([("a", "x" * 1000), ("b", None)], "k string, v string")
    rows, size = measured_size(df)
    assert (rows, size) == (2, 1002)
    assert fits_broadcast(rows, size, JoinOptions(broadcast_max_rows=2, broadcast_max_bytes=2000))
    assert not fits_broadcast(rows, size, JoinOptions(broadcast_max_rows=1))
    assert not fits_broadcast(rows, size, JoinOptions(broadcast_max_bytes=500))
    assert measured_size(df.where("k = 'z'")) == (0, 0)


def test_keep_first_hot_key(spark, hot):
    first = dedupe.keep_first(hot.repartition(16, "id"), ["key"], "id")
    # One row per key and task goes into the shuffle.
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    expected = {}
    for row in hot.orderBy("id").collect():
        expected.setdefault(row.key, row.id)
    assert {r.key: r.id for r in first.collect()} == expected


def test_dedupe_digest_does_not_mix_fields(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("a1", "b"), (None, "abc"), ("A ", "bc;")], "q string, sql string")
    digests = [r.d for r in df.select(dedupe.dedupe_digest(("q", "sql")).alias("d")).collect()]
    assert len(set(digests)) == 4 and digests[0] == digests[4]


@pytest.mark.parametrize("n", [0, 1, 2, 19, 20, 21, 1000, 70_001])
def test_split_sizes_are_exact(spark, n):
    ratios = SplitRatios(0.90, 0.05, 0.05)
    sizes = {r.metric: r.value for r in profiles.split_sizes(ranking.split(spark.range(n), "id", ratios, 7)).collect()}
    train, val = int(n * 0.90), int(n * 0.05)
    assert sizes == {"train": train, "val": val, "test": n - train - val}


def test_leftovers_go_to_test_at_ratio_zero(spark):
    labelled = ranking.split(spark.range(7), "id", SplitRatios(0.95, 0.05, 0.0), 1)
    sizes = {r.metric: r.value for r in profiles.split_sizes(labelled).collect()}
    assert sizes == {"train": 6, "val": 0, "test": 1}


def test_split_ignores_partitioning_and_depends_on_seed(spark):
    def labels(df, seed):
        return sorted(tuple(r) for r in ranking.split(df, "id", SplitRatios(), seed).collect())

    ids = spark.range(5_000)
    assert labels(ids, 1) == labels(ids.repartition(13), 1)
    assert labels(ids, 1) != labels(ids, 2)


def test_sample(spark):
    ids = spark.range(2_000)
    got = {r.id for r in ranking.sample(ids, "id", 100, 5).collect()}
    keyed = ids.select("id", ranking.order_key("id", 5, "sample").alias("k"))
    assert got == {r.id for r in keyed.orderBy("k").limit(100).collect()}
    assert ranking.sample(ids, "id", 5_000, 5).count() == 2_000
    assert ranking.sample(ids, "id", None, 5) is ids and ranking.sample(ids, "id", 0, 5) is ids


def test_rank_within_hot_group(spark, hot):
    ranked = ranking.rank_within(hot, "key", "id", 3, "batch").collect()
    sizes = Counter(r.key for r in ranked)
    seen = Counter()
    for key, size in sizes.items():
        ranks = sorted(r["rank"] for r in ranked if r.key == key)
        assert ranks == list(range(size))
        seen[key] = size
    assert seen["hot"] == 10_000
    by_key = {r.id: r.k for r in hot.select("id", ranking.order_key("id", 3, "batch").alias("k")).collect()}
    in_order = [r.id for r in sorted((r for r in ranked if r.key == "hot"), key=lambda r: r["rank"])]
    assert in_order == sorted(in_order, key=by_key.get)


def test_catalog_rendering(spark):
    raw = spark.createDataFrame(
        [
            ("d", ["old"], [["-1", "*"], ["0", "x"]], ["text", "text"], [], [], 1),
            (
                "d",
                ["a", "b c"],
                [["-1", "*"], ["0", "id"], ["0", "q\"x"], ["1", "l"], ["1", "r"]],
                ["text", "number", "Boolean", "time", None],
                [1, 3, 4],
                [[3, 1], [4, 1]],
                2,
            ),
            ("e", ["only"], [["-1", "*"], ["0", "x"]], ["text", "others"], None, None, 3),
        ],
        "db_id string, table_names_original array<string>, column_names_original array<array<string>>,"
        " column_types array<string>, primary_keys array<int>, foreign_keys array<array<int>>, ordinal int",
    )
    rendered = {r.db_id: r.schema_ddl for r in catalog.rendered_schemas(catalog.normalize_catalog(raw)).collect()}
    assert rendered["e"] == 'CREATE TABLE "only" (\n  "x" TEXT\n);'
    assert rendered["d"] == (
        'CREATE TABLE "a" (\n  "id" REAL PRIMARY KEY,\n  "q""x" INTEGER\n);\n'
        'CREATE TABLE "b c" (\n  "l" TEXT,\n  "r" TEXT,\n  PRIMARY KEY ("l", "r"),\n'
        '  FOREIGN KEY ("l") REFERENCES "a" ("id"),\n  FOREIGN KEY ("r") REFERENCES "a" ("id")\n);'
    )


def test_blocklist_aliases_and_empty_keys(spark):
    rows = [("Q  one", None, None, None), ("", "Q Two", "", "select  A;"), (None, None, "SELECT a", None), ("", None, None, "")]
    blocklist = spark.createDataFrame(rows, "question string, prompt string, sql string, query string")
    assert sorted(r[0] for r in leaks.blocked_question_keys(blocklist).collect()) == ["q one", "q two"]
    assert [r[0] for r in leaks.blocked_sql_keys(blocklist).collect()] == ["select a"]


def test_bucket_arithmetic_matches_python():
    for n in (0, 1, 19, 999, 150_000, 10**9 + 7):
        for ratio in (0.9, 0.05, 0.95, 0.8, 0.2):
            assert int(n * ratio) == math.floor(float(n) * ratio)


def test_every_row_is_in_a_padded_batch(spark, tmp_path):
    """No token limit of a check drops most rows or cuts the others."""
    orders = spark.range(1, 61).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "'O' AS o_orderstatus")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    rows = QUERIES["k4_padded_batches"](spark, str(tmp_path)).collect()
    assert sorted(r.example_id for r in rows) == list(range(1, 61))
    for r in rows:
        ids, mask, labels = (json.loads(v) for v in (r.input_ids, r.attention_mask, r.labels))
        assert len(ids) == len(mask) == len(labels) == r.pad_to > 0
        # The end of the answer is there: one more token than the prompt at least, and not cut.
        assert 0 < sum(v != -100 for v in labels) < sum(mask)
    assert max(sum(json.loads(r.attention_mask)) for r in rows) > 95
