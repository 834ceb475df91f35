"""Whole jobs, sources and sinks."""

import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from sqlloom.functions import tokens
from sqlloom.operators import messages, profiles
from sqlloom.options import CurateOptions, PromptOptions, TokenOptions, benchmark_run, five_thousand_run, smoke_run
from sqlloom.plans import jobs, views
from sqlloom.sources import contracts, readers, scratch, sinks
from sqlloom.sources.spread import _bytes, spread

CURATED_SCHEMA = T.StructType(
    [
        T.StructField("example_id", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in jobs.CURATED_COLUMNS),
        T.StructField("messages", readers.MESSAGES),
        T.StructField("split", T.StringType()),
    ]
)


def test_run_curate_writes_splits_and_summary(spark, sf, tmp_path):
    out = str(tmp_path / "out")
    summary = jobs.run_curate(views.corpus(spark, sf), out, views.blocklist(spark, sf), five_thousand_run())
    values = {(r.section, r.metric): r.value for r in summary.collect()}
    rows = sinks.read_splits(spark, f"{out}/all_cleaned", CURATED_SCHEMA)
    counted = {r.split: r["count"] for r in rows.groupBy("split").count().collect()}
    kept = values["funnel", "kept_after_dedupe"]
    assert values["sample_size", "corpus"] == kept == rows.count()
    for split in sinks.SPLITS:
        assert values["split_sizes", split] == counted[split]
        assert sinks.read_split(spark, f"{out}/all_cleaned", CURATED_SCHEMA, split).count() == counted[split]
    first = rows.first()
    assert [m.role for m in first.messages] == ["system", "user", "assistant"]
    assert first.messages[2].content == first.sql
    line = next((tmp_path / "out" / "all_cleaned" / "split=train").glob("*.json")).read_text().splitlines()[0]
    assert set(json.loads(line)) == {"example_id", *jobs.CURATED_COLUMNS, "messages"}


def test_smoke_run_keeps_sixteen_and_four(spark, sf):
    rows = jobs.curated_rows(views.corpus(spark, sf), None, smoke_run())
    sizes = {r.metric: r.value for r in profiles.split_sizes(rows).collect()}
    assert sizes == {"train": 16, "val": 4, "test": 0}


def test_curate_does_not_depend_on_partitioning(spark, sf):
    source = views.corpus(spark, sf)
    columns = ["example_id", "sql", "split"]
    one = jobs.curated_rows(source).select(columns)
    two = jobs.curated_rows(source.repartition(11, "sql")).select(columns)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_splits_are_disjoint_and_complete(spark, sf):
    rows = jobs.prepared_splits(views.examples(spark, sf), views.raw_catalog(spark, sf), benchmark_run())
    ids = rows.select("example_id", "split")
    assert ids.select("example_id").distinct().count() == ids.count()
    parts = [ids.where(F.col("split") == s).select("example_id") for s in sinks.SPLITS]
    assert ids.select("example_id").exceptAll(parts[0].union(parts[1]).union(parts[2])).count() == 0


def test_run_prepare_summary(spark, sf, tmp_path):
    summary = jobs.run_prepare(views.examples(spark, sf), views.raw_catalog(spark, sf), str(tmp_path / "p"), benchmark_run())
    values = {(r.section, r.metric): r.value for r in summary.collect()}
    n = views.examples(spark, sf).count()
    assert values["funnel", "seen"] == n
    assert values["funnel", "sqlite_parse_failed"] == n // 10
    assert values["funnel", "kept"] == sum(values["split_sizes", s] for s in sinks.SPLITS)


def test_optional_rules_can_be_switched(spark, sf):
    from dataclasses import replace

    options = CurateOptions()
    loose = replace(options, filters=replace(options.filters, require_schema_context=False, keep_create_view=True))
    classified = jobs.classify_corpus(views.corpus(spark, sf), None, loose)
    kept = classified.where("drop_reason IS NULL")
    assert kept.where("schema_ddl = ''").count() > 0
    assert kept.where("schema_ddl LIKE '%CREATE VIEW v AS SELECT id FROM orders;%'").count() > 0


def test_explanations_go_into_the_answer(spark, sf):
    from dataclasses import replace

    options = replace(CurateOptions(), prompt=PromptOptions(include_explanation=True))
    answers = {bool(r.sql_explanation): r.messages[2].content for r in jobs.curated_rows(views.corpus(spark, sf), None, options).collect()}
    assert answers[True].startswith("Reasoning:\nSums totals for customer")
    assert "\n\nFinal SQL:\nSELECT" in answers[True]
    assert answers[False].startswith(("SELECT", "WITH"))


def test_user_message_does_not_expand_braces(spark):
    df = spark.createDataFrame([(" {schema} {x} ", "{question}\n")], "q string, s string")
    text = df.select(messages.user_message(F.col("q"), F.col("s"), "S: {schema} {{lit}} Q: {question} ").alias("m")).first().m
    assert text == "S: {question} {lit} Q: {schema} {x}"


def test_supervision_masks_only_the_prompt(spark):
    rows = spark.createDataFrame([(1, "how many?", "CREATE TABLE t (a);", "SELECT 1", None), (2, "q " * 400, "", "SELECT 2", None)], "example_id long, sql_prompt string, schema_ddl string, sql string, sql_explanation string")
    chat = jobs.with_messages(rows)
    kept = jobs.supervised_rows(chat, TokenOptions(max_seq_length=200)).collect()
    assert [r.example_id for r in kept] == [1]
    row = kept[0]
    answer = spark.range(1).select(tokens.hashed(F.lit("SELECT 1<|im_end|>"), 99).alias("ids")).first().ids
    assert [i for i in row.labels if i != -100] == answer
    assert row.input_ids[-len(answer):] == answer and row.labels[: -len(answer)] == [-100] * (len(row.labels) - len(answer))
    assert row.attention_mask == [1] * len(row.input_ids)


def test_plugged_tokenizer(spark, sf):
    def bytes_encoder():
        return lambda texts: [list(t.encode()) for t in texts]

    chat = jobs.with_messages(jobs.prepared_rows(jobs.classify_examples(views.examples(spark, sf), views.raw_catalog(spark, sf))))
    options = TokenOptions(max_seq_length=1024, batch_size=3)
    padded = jobs.padded_batches(chat, 1, options, tokens.plugged(bytes_encoder)).collect()
    by_batch = {}
    for r in padded:
        assert len(r.input_ids) == len(r.attention_mask) == len(r.labels) == r.pad_to
        by_batch.setdefault((r.length_bucket, r.batch_no), []).append(r)
    assert all(len(b) <= 3 and len({r.pad_to for r in b}) == 1 for b in by_batch.values())
    assert all(r.pad_to == max(sum(x.attention_mask) for x in b) for b in by_batch.values() for r in b)
    sample = padded[0]
    assert bytes(sample.input_ids[: sum(sample.attention_mask)]).decode().startswith("<|im_start|>system\n")


def test_run_supervision_counts(spark, sf, tmp_path):
    rows = jobs.prepared_splits(views.examples(spark, sf), views.raw_catalog(spark, sf), benchmark_run())
    train, evaluation = rows.where("split = 'train'"), rows.where("split = 'val'")
    counts = jobs.run_supervision(train, evaluation, str(tmp_path / "sup"), benchmark_run())
    assert {r.part: r.rows for r in counts.collect()} == {"train": train.count(), "eval": evaluation.count()}


def test_contract(spark):
    df = spark.createDataFrame([("a", "b")], "sql string, domain string")
    with pytest.raises(ValueError, match="lacks required columns: \\['domain_description', 'sql_complexity'"):
        contracts.require_columns(df)
    wrong = spark.createDataFrame([(1,)], "sql int")
    with pytest.raises(ValueError, match="another type than string: \\['sql'\\]"):
        contracts.require_columns(wrong, ("sql",))
    report = {r.name: (r.present, r.non_null_rows) for r in contracts.contract_report(df).collect()}
    assert report["sql"] == (True, 1) and report["sql_prompt"] == (False, 0)


def test_json_array_sources(spark, tmp_path):
    catalog_file = tmp_path / "tables.json"
    catalog_file.write_text(json.dumps([
        {"db_id": "d", "table_names_original": ["t"], "column_names_original": [[-1, "*"], [0, "a"]], "column_types": ["text", "number"], "primary_keys": [1], "foreign_keys": [], "extra": 1},
        {"db_id": "d", "table_names_original": ["u"], "column_names_original": [[-1, "*"], [0, "b"]], "column_types": ["text", "text"], "primary_keys": [], "foreign_keys": []},
    ], indent=1))
    examples_file = tmp_path / "train.json"
    examples_file.write_text(json.dumps([{"db_id": "d", "question": "q?", "query": "select b from u", "toks": [1]}, {"db_id": "x"}], indent=1))
    catalog = readers.read_catalog(spark, str(catalog_file))
    examples = readers.read_examples(spark, str(examples_file)).withColumn("example_id", F.monotonically_increasing_id())
    rows = jobs.classify_examples(examples, catalog).orderBy("example_id").collect()
    assert rows[0].schema_ddl == 'CREATE TABLE "u" (\n  "b" TEXT\n);' and rows[0].sql == "SELECT b FROM u"
    assert rows[1].drop_reason == "drop_missing_fields"
    blocklist_file = tmp_path / "block.json"
    blocklist_file.write_text(json.dumps([{"prompt": "a"}, {"query": "b", "question": ""}]))
    assert readers.read_blocklist(spark, str(blocklist_file)).count() == 2
    assert readers.read_blocklist(spark, None).count() == 0


def test_validation_table_wins_over_fallback(spark):
    train, other = spark.range(20).toDF("example_id"), spark.range(3).toDF("example_id")
    assert readers.load_splits(train, other, "example_id")[1].count() == 3
    assert [r.example_id for r in readers.load_splits(train, None, "example_id")[1].collect()] == list(range(8))


def test_empty_split_reads_as_empty(spark, tmp_path):
    path = str(tmp_path / "s")
    sinks.write_splits(spark.createDataFrame([(1, "é", None, "train")], "example_id long, sql string, n string, split string"), path)
    schema = T.StructType([T.StructField("example_id", T.LongType()), T.StructField("sql", T.StringType()), T.StructField("n", T.StringType())])
    assert sinks.read_split(spark, path, schema, "test").count() == 0
    assert sinks.read_split(spark, path, schema, "train").first().sql == "é"
    line = next((tmp_path / "s" / "split=train").glob("*.json")).read_text()
    assert line.isascii() and json.loads(line) == {"example_id": 1, "sql": "é", "n": None}
    with pytest.raises(ValueError):
        sinks.read_split(spark, path, schema, "dev")


def test_parquet_ordinal_is_stable(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(1000).repartition(3).write.parquet(path)
    one = readers.add_file_ordinal(spark.read.parquet(path)).collect()
    two = readers.add_file_ordinal(spark.read.parquet(path)).repartition(5).collect()
    assert sorted((r.example_id, r.id) for r in one) == sorted((r.example_id, r.id) for r in two)
    assert len({r.example_id for r in one}) == 1000


def test_scratch_follows_the_session(spark):
    root = scratch.scratch_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_path(spark, "x").startswith(f"{root}/sqlloom/x-")


def test_scratch_without_a_named_folder(monkeypatch):
    class Session:
        def __init__(self, **conf):
            self.conf = conf

    monkeypatch.setattr(scratch, "_private_roots", [])
    local = Session(**{"spark.master": "local[2]"})
    assert scratch.scratch_root(local) == scratch.scratch_root(local)
    with pytest.raises(RuntimeError, match="shared folder"):
        scratch.scratch_root(Session(**{"spark.master": "yarn"}))
    assert scratch.scratch_root(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://x/c/"})) == "hdfs://x/c"


def test_runs_delete_their_own_tables_only(spark, sf, tmp_path):
    other = scratch.materialize(spark.range(5), "other-run")
    root = scratch.scratch_root(spark).removeprefix("file://") + "/sqlloom"
    before = set(os.listdir(root))
    jobs.run_curate(views.corpus(spark, sf), str(tmp_path / "c"), views.blocklist(spark, sf), smoke_run())
    jobs.run_prepare(views.examples(spark, sf), views.raw_catalog(spark, sf), str(tmp_path / "p"), benchmark_run())
    chat = jobs.with_messages(spark.createDataFrame([(1, "q", "s", "SELECT 1", None)], "example_id long, sql_prompt string, schema_ddl string, sql string, sql_explanation string"))
    assert jobs.run_supervision(chat, chat, str(tmp_path / "s")).count() == 2
    assert set(os.listdir(root)) == before and other.count() == 5


def test_a_failed_run_leaves_nothing(spark, sf, tmp_path):
    root = scratch.scratch_root(spark).removeprefix("file://") + "/sqlloom"
    before = set(os.listdir(root))
    (tmp_path / "all_cleaned").mkdir()
    with pytest.raises(Exception, match="already exists"):
        jobs.run_curate(views.corpus(spark, sf), str(tmp_path), None, smoke_run())
    assert set(os.listdir(root)) == before


def test_missing_validation_file(spark, sf, tmp_path):
    rows = jobs.prepared_splits(views.examples(spark, sf), views.raw_catalog(spark, sf), benchmark_run())
    train, val = str(tmp_path / "train"), str(tmp_path / "val")
    sinks.write_jsonl(rows.where("split = 'train'").select("example_id", "messages"), train)
    sinks.write_jsonl(rows.where("split = 'val'").select("example_id", "messages"), val)
    sizes = [{r.part: r.rows for r in jobs.run_supervision_files(spark, train, v, str(tmp_path / f"out{i}"), benchmark_run()).collect()} for i, v in enumerate((val, str(tmp_path / "none"), None))]
    n = rows.groupBy("split").count().collect()
    n = {r.split: r["count"] for r in n}
    assert sizes[0] == {"train": n["train"], "eval": n["val"]}
    assert sizes[1] == sizes[2] == {"train": n["train"], "eval": 8}


def test_sample_needs_no_shuffle_of_wide_rows(spark, sf):
    rows = jobs.curated_rows(views.corpus(spark, sf), None, five_thousand_run())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan and "BroadcastHashJoin" in plan


def test_catalog_files_in_order_of_their_paths(spark, tmp_path):
    def entry(table, n):
        return "".join(json.dumps({"db_id": "d" if i == n - 1 else f"x{i}", "table_names_original": [table], "column_names_original": [[-1, "*"], [0, "c"]], "column_types": ["text", "text"], "primary_keys": [], "foreign_keys": []}) + "\n" for i in range(n))

    (tmp_path / "a.json").write_text(entry("early", 1))
    (tmp_path / "b.json").write_text(entry("late", 400))
    from sqlloom.operators.catalog import normalize_catalog

    for paths in (str(tmp_path), [str(tmp_path / "b.json"), str(tmp_path / "a.json")]):
        rows = normalize_catalog(readers.read_catalog(spark, paths, lines=True)).where("db_id = 'd'").collect()
        assert [r.tables for r in rows] == [["late"]]


def test_spread_leaves_wide_scans_alone(spark, tmp_path):
    path = str(tmp_path / "w")
    spark.range(1000).repartition(16).write.parquet(path)
    df = spark.read.parquet(path)
    assert spread(df, "id") is df
    spark.range(10).coalesce(1).write.parquet(path + "1")
    assert spread(spark.read.parquet(path + "1"), "id") is not df
    assert (_bytes("128MB"), _bytes("134217728b"), _bytes("2g"), _bytes("77")) == (2**27, 2**27, 2**31, 77)


def test_dataset_without_a_key_gets_an_ordinal(spark, sf, tmp_path):
    path = str(tmp_path / "d")
    keyless = views.corpus(spark, sf).drop("example_id").withColumn("split", F.lit("train"))
    keyless.repartition(4).write.partitionBy("split").parquet(path)
    source = readers.add_file_ordinal(readers.read_dataset(spark, path))
    assert source.select("example_id").distinct().count() == keyless.count()
    rows = jobs.curated_rows(source, None, smoke_run())
    assert rows.count() == 20
