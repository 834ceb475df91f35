"""Sources, profiles, joins, dedupe, funnels, sampling, splits (sections 2.1, 2.2, 2.5 to 2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from sqlloom.checks import duck as D
from sqlloom.checks.registry import check
from sqlloom.checks.scalar import documents
from sqlloom.functions.text import sql_key, text_key
from sqlloom.functions.sqltext import canonical_sql
from sqlloom.operators import catalog, dedupe, filters, leaks, profiles, ranking
from sqlloom.operators.joins import lookup
from sqlloom.options import DEFAULT_SEED, CurateOptions, JoinOptions, benchmark_run
from sqlloom.plans import jobs, views
from sqlloom.sources import contracts, quarantine, readers
from sqlloom.sources.scratch import materialize, scratch_path
from sqlloom.sources.spread import spread

OPTIONS = CurateOptions()
BENCHMARK = benchmark_run()
LARGE = JoinOptions(broadcast_max_rows=0, broadcast_max_bytes=0)

CORPUS_TEXT = "domain, domain_description, sql_complexity, sql_task_type, sql_prompt, sql_context, sql, sql_explanation"


@check("s1_load_dataset", D.with_(D.view("corpus"), select=f"SELECT example_id, {CORPUS_TEXT} FROM corpus WHERE sql_complexity <> 'basic SQL'"))
def _(spark, sf):
    path = scratch_path(spark, "dataset")
    held_out = F.when(F.col("sql_complexity") == "basic SQL", "test").otherwise("train")
    views.corpus(spark, sf).withColumn("split", held_out).write.partitionBy("split").parquet(path)
    loaded = readers.read_dataset(spark, path, "train", readers.with_ordinal(readers.CORPUS))
    return loaded.selectExpr("example_id", *CORPUS_TEXT.split(", "))


@check("s2_load_examples", D.with_(D.view("examples"), select="SELECT db_id, question, query FROM examples"))
def _(spark, sf):
    path = scratch_path(spark, "examples")
    views.examples(spark, sf).select("db_id", "question", "query").write.json(path)
    return readers.read_examples(spark, path, lines=True)


#: A file of the examples with one good line, one broken line and one cut off, beside the clean files.
DAMAGED = '{"db_id": "d", "question": "q", "query": "SELECT 1"}\n{"db_id": "d", "question": \n{"db_id": "d", "quest'


@check(
    "s7_quarantine_report",
    D.with_(
        D.view("examples"),
        select="SELECT 'clean' AS kind, count(*) AS rows_read, CAST(0 AS BIGINT) AS bad_rows, count(*) AS good_rows FROM examples"
        " UNION ALL SELECT 'damaged', CAST(3 AS BIGINT), CAST(2 AS BIGINT), CAST(1 AS BIGINT)",
    ),
)
def _(spark, sf):
    """Examples written as JSON lines, plus a damaged file: rows, bad rows and good rows by kind of
    file, read with a share of 1 allowed (so nothing raises)."""
    path = scratch_path(spark, "examples-damaged")
    views.examples(spark, sf).select("db_id", "question", "query").write.json(f"{path}/clean")
    spark.createDataFrame([(DAMAGED,)], "value string").coalesce(1).write.text(f"{path}/damaged")
    read = quarantine.read_json_checked(spark, [f"{path}/clean", f"{path}/damaged"], readers.EXAMPLES, policy=quarantine.MalformedPolicy(max_bad_share=1.0))
    kind = F.when(F.col(quarantine.FILE).contains("/damaged/"), "damaged").otherwise("clean")
    counts = read.counts.groupBy(kind.alias("kind")).agg(F.sum("rows").alias("rows_read"), F.sum("bad_rows").alias("bad_rows"))
    return counts.withColumn("good_rows", F.col("rows_read") - F.col("bad_rows"))


@check(
    "s3_load_catalog",
    D.with_(
        D.view("catalog_cols"),
        select="SELECT db_id, table_idx, table_name, column_idx, column_name, column_type FROM catalog_cols"
        " UNION ALL SELECT DISTINCT db_id, -1, NULL, 0, '*', 'text' FROM catalog_cols",
    ),
)
def _(spark, sf):
    path = scratch_path(spark, "catalog")
    raw = views.raw_catalog(spark, sf)
    # Earlier entries in the first, smaller files: the later files' entries must win.
    for name, last in (("a", 0), ("b", 1)):
        raw.where(F.col("ordinal") == last).drop("ordinal").write.json(f"{path}/{name}")
    raw = readers.read_catalog(spark, [f"{path}/a", f"{path}/b"], lines=True)
    return catalog.catalog_columns(catalog.normalize_catalog(raw))


@check("s4_load_blocklist", D.with_(D.view("blocklist"), D.BLOCK_KEYS, select="SELECT kind, key FROM block_keys"))
def _(spark, sf):
    path = scratch_path(spark, "blocklist")
    views.blocklist(spark, sf).write.json(path)
    loaded = readers.read_blocklist(spark, path, lines=True)
    questions = leaks.blocked_question_keys(loaded).select(F.lit("question").alias("kind"), F.col("question_key").alias("key"))
    statements = leaks.blocked_sql_keys(loaded).select(F.lit("sql").alias("kind"), F.col("sql_key").alias("key"))
    return questions.unionByName(statements)


@check(
    "s5_load_splits",
    D.with_(
        D.view("corpus"),
        select="SELECT 'train' AS part, example_id, sql_prompt FROM corpus"
        " UNION ALL SELECT 'eval', example_id, sql_prompt FROM (SELECT * FROM corpus ORDER BY example_id LIMIT 8)",
    ),
)
def _(spark, sf):
    path = scratch_path(spark, "train")
    views.corpus(spark, sf).write.option("ignoreNullFields", False).json(path)
    stored = readers.read_json_lines(spark, path, readers.with_ordinal(readers.CORPUS))
    train, evaluation = readers.load_splits(stored, None, "example_id")
    columns = ["part", "example_id", "sql_prompt"]
    return train.withColumn("part", F.lit("train")).select(columns).unionByName(
        evaluation.withColumn("part", F.lit("eval")).select(columns)
    )


@check(
    "s6_column_contract",
    D.with_(
        D.view("corpus"),
        select=" UNION ALL ".join(
            f"SELECT '{c}' AS name, true AS present, count({c}) AS non_null_rows FROM corpus" for c in contracts.REQUIRED_COLUMNS
        ),
    ),
)
def _(spark, sf):
    return contracts.contract_report(contracts.require_columns(views.corpus(spark, sf)))


CORPUS_PROFILE = """
profile AS (SELECT 'row_count' AS metric, CAST(NULL AS VARCHAR) AS name, count(*) AS n FROM corpus
 UNION ALL SELECT 'task_type_counts', sql_task_type, count(*) FROM corpus GROUP BY sql_task_type
 UNION ALL SELECT 'sql_complexity_counts', sql_complexity, count(*) FROM corpus GROUP BY sql_complexity)"""

# Truth by construction: class 6 of 10 does not parse.
EXAMPLES_PROFILE = """
profile AS (SELECT 'row_count' AS metric, CAST(NULL AS VARCHAR) AS name, count(*) AS n FROM examples
 UNION ALL SELECT 'database_count', NULL, count(DISTINCT db_id) FROM examples
 UNION ALL SELECT 'sqlite_parse_failures', NULL, count(*) FROM examples WHERE example_id % 10 = 6
 UNION ALL SELECT * FROM (SELECT 'top_databases', db_id, count(*) AS k FROM examples GROUP BY db_id ORDER BY k DESC, db_id LIMIT 10))"""


@check("p1_corpus_profile", D.with_(D.view("corpus"), CORPUS_PROFILE, select="SELECT * FROM profile"))
def _(spark, sf):
    return profiles.corpus_profile(views.corpus(spark, sf))


@check("p2_examples_profile", D.with_(D.view("examples"), EXAMPLES_PROFILE, select="SELECT * FROM profile"))
def _(spark, sf):
    return profiles.examples_profile(spread(views.examples(spark, sf), "example_id"))


def inspect_oracle(source: str, profile: str, columns: tuple[str, ...], listed: tuple[str, ...]) -> str:
    names = " UNION ALL ".join(f"SELECT 'columns' AS metric, '{c}' AS name, '{i}' AS value" for i, c in enumerate(listed))
    first = " UNION ALL ".join(f"SELECT 'example', '{c}', {c} FROM first" for c in columns)
    return D.with_(
        D.view(source),
        profile,
        f"first AS (SELECT * FROM {source} ORDER BY example_id LIMIT 1)",
        select=f"{names} UNION ALL SELECT metric, name, CAST(n AS VARCHAR) FROM profile UNION ALL {first}",
    )


EXAMPLE_COLUMNS = ("db_id", "question", "query")


@check(
    "p3_inspect_corpus",
    inspect_oracle("corpus", CORPUS_PROFILE, contracts.REQUIRED_COLUMNS, ("example_id", *CORPUS_TEXT.split(", "))),
)
def _(spark, sf):
    df = views.corpus(spark, sf)
    return profiles.inspect_report(df, profiles.corpus_profile(df), contracts.REQUIRED_COLUMNS, "example_id")


@check(
    "p3_inspect_examples",
    inspect_oracle("examples", EXAMPLES_PROFILE, EXAMPLE_COLUMNS, ("example_id", *EXAMPLE_COLUMNS)),
)
def _(spark, sf):
    df = views.examples(spark, sf)
    return profiles.inspect_report(df, profiles.examples_profile(df), EXAMPLE_COLUMNS, "example_id")


JOINED = D.with_(
    *D.EXAMPLE_STEPS[:3], select="SELECT e.example_id, e.db_id, s.schema_ddl FROM examples e LEFT JOIN schemas s USING (db_id)"
)


def schema_lookup(spark, sf, options):
    schemas = catalog.rendered_schemas(catalog.normalize_catalog(views.raw_catalog(spark, sf)))
    examples = views.examples(spark, sf).select("example_id", "db_id")
    return catalog.attach_schema(examples, schemas, "example_id", options)


@check("j1_schema_lookup", JOINED)
def _(spark, sf):
    return schema_lookup(spark, sf, OPTIONS.joins)


@check("j1_schema_lookup_large", JOINED)
def _(spark, sf):
    return schema_lookup(spark, sf, LARGE)


LEAKED = D.with_(
    D.view("corpus"),
    D.view("blocklist"),
    D.BLOCK_KEYS,
    f"tokens AS (SELECT example_id, sql_prompt, {D.sql_tokens('sql')} AS tk FROM corpus)",
    select=f"""SELECT example_id, {D.text_key('sql_prompt')} IN (SELECT key FROM block_keys WHERE kind = 'question')
 OR {D.sql_key(D.canonical('tk'))} IN (SELECT key FROM block_keys WHERE kind = 'sql') AS leaked FROM tokens""",
)


def leak_flags(spark, sf, options):
    flagged = leaks.flag_leaks(
        spread(views.corpus(spark, sf), "example_id").select("example_id", "sql_prompt", "sql"),
        views.blocklist(spark, sf),
        text_key("sql_prompt"),
        sql_key(canonical_sql("sql")),
        "example_id",
        options,
    )
    return flagged.select("example_id", "leaked")


@check("j2_leak_flags", LEAKED)
def _(spark, sf):
    return leak_flags(spark, sf, OPTIONS.joins)


@check("j2_leak_flags_large", LEAKED)
def _(spark, sf):
    return leak_flags(spark, sf, LARGE)


@check(
    "j2_documents_benchmark",
    f"SELECT doc_id FROM documents WHERE {D.text_key('text')} NOT IN (SELECT {D.text_key('text')} FROM benchmark UNION ALL SELECT {D.text_key('text')} FROM documents WHERE source = 'src0')",
)
def _(spark, sf):
    # No whole document is a benchmark item, so one source is held for an evaluation set as well.
    held = views.table(spark, sf, "documents").where("source = 'src0'").select("text")
    texts = views.table(spark, sf, "benchmark").select("text").unionByName(held)
    listed = texts.select(text_key("text").alias("question_key")).distinct()
    keyed = documents(spark, sf).select("doc_id", text_key("text").alias("question_key"))
    found = lookup(keyed, listed.withColumn("hit", F.lit(True)), "question_key", "doc_id")
    return found.where(F.col("hit").isNull()).select("doc_id")


@check(
    "j3_foreign_keys",
    D.with_(
        D.view("catalog_cols"),
        select="""SELECT s.db_id, 0 AS fk_idx, s.table_name AS source_table, s.column_name AS source_column, t.table_name AS target_table, t.column_name AS target_column
 FROM catalog_cols s JOIN catalog_cols t ON s.db_id = t.db_id AND s.fk_target_idx = t.column_idx""",
    ),
)
def _(spark, sf):
    return catalog.foreign_keys(catalog.normalize_catalog(views.raw_catalog(spark, sf)))


@check("b1_render_ddl", D.with_(D.view("catalog_cols"), D.SCHEMAS, select="SELECT db_id, schema_ddl FROM schemas"))
def _(spark, sf):
    return catalog.rendered_schemas(catalog.normalize_catalog(views.raw_catalog(spark, sf)))


FUNNEL_ROWS = (
    "SELECT 'seen' AS metric, count(*) AS value FROM judged"
    + "".join(f" UNION ALL SELECT '{r}', count(*) FROM judged WHERE drop_reason = '{r}'" for r in filters.CORPUS_REASONS)
    + " UNION ALL SELECT 'kept_before_dedupe', count(*) FROM alive"
    " UNION ALL SELECT 'drop_duplicate', count(*) FROM ranked WHERE rn > 1"
    " UNION ALL SELECT 'kept_after_dedupe', count(*) FROM deduped"
)


def classified_corpus(spark, sf):
    return jobs.classify_corpus(views.corpus(spark, sf), views.blocklist(spark, sf))


@check("a1_curate_funnel", D.with_(*D.CORPUS_STEPS, select=FUNNEL_ROWS))
def _(spark, sf):
    classified = classified_corpus(spark, sf)
    return profiles.curate_funnel(classified, filters.CORPUS_REASONS)


PREPARE_ROWS = (
    "SELECT 'seen' AS metric, count(*) AS value FROM ex_judged"
    + "".join(f" UNION ALL SELECT '{r}', count(*) FROM ex_judged WHERE drop_reason = '{r}'" for r in filters.EXAMPLE_REASONS)
    + " UNION ALL SELECT 'sqlite_parse_failed', count(*) FROM prepared WHERE NOT sql_valid"
    " UNION ALL SELECT 'kept', count(*) FROM prepared"
)


@check("a2_prepare_funnel", D.with_(*D.EXAMPLE_STEPS, select=PREPARE_ROWS))
def _(spark, sf):
    return profiles.prepare_funnel(
        jobs.classify_examples(views.examples(spark, sf), views.raw_catalog(spark, sf))
    )


def digest(*keys: str) -> str:
    return "sha256(" + " || ".join(f"length({k}) || ':' || {k}" for k in keys) + ")"


@check(
    "a3_dedupe_key",
    D.with_(
        D.view("corpus"),
        select=f"SELECT example_id, {D.text_key('sql_prompt')} AS sql_prompt_key, {D.sql_key('sql')} AS sql_key, {digest(D.text_key('sql_prompt'), D.sql_key('sql'))} AS digest FROM corpus",
    ),
)
def _(spark, sf):
    fields = ("sql_prompt", "sql")
    return views.corpus(spark, sf).select(
        "example_id", *dedupe.dedupe_keys(fields), dedupe.dedupe_digest(fields).alias("digest")
    )


@check(
    "a4_keep_first",
    D.with_(
        D.view("corpus"),
        select=f"SELECT min(example_id) AS example_id, {D.text_key('sql_prompt')} AS sql_prompt_key, {D.sql_key('sql')} AS sql_key FROM corpus GROUP BY ALL",
    ),
)
def _(spark, sf):
    keyed = views.corpus(spark, sf).select("example_id", *dedupe.dedupe_keys(("sql_prompt", "sql")))
    return dedupe.keep_first(keyed, ["sql_prompt_key", "sql_key"], "example_id")


@check(
    "a4_documents",
    f"SELECT doc_id, lang, source, text FROM (SELECT *, row_number() OVER (PARTITION BY {D.text_key('text')} ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1",
)
def _(spark, sf):
    keyed = documents(spark, sf).withColumn("key", dedupe.dedupe_digest(("text",)))
    return dedupe.keep_first(keyed, ["key"], "doc_id").select("doc_id", "lang", "source", "text")


def labelled_ids(spark, sf, options=OPTIONS):
    ids = views.corpus(spark, sf).select("example_id")
    return ranking.split(ids, "example_id", options.ratios, options.seed)


@check("a5_split_sizes", D.with_(D.view("corpus"), D.split_step("corpus", BENCHMARK), select=" UNION ALL ".join(f"SELECT '{s}' AS metric, count(*) AS value FROM labelled WHERE split = '{s}'" for s in ("train", "val", "test"))))
def _(spark, sf):
    return profiles.split_sizes(labelled_ids(spark, sf, BENCHMARK))


def summary_select(dataset: str, listed: tuple[str, ...], funnel: str) -> str:
    facts = [f"SELECT 'seed', 'seed', CAST({DEFAULT_SEED} AS BIGINT)"]
    facts += [f"SELECT 'columns', '{c}', {i}" for i, c in enumerate(listed)]
    sizes = " UNION ALL ".join(f"SELECT 'split_sizes', '{s}', count(*) FROM labelled WHERE split = '{s}'" for s in ("train", "val", "test"))
    return (
        "SELECT 'profile_before' AS section, metric || coalesce('/' || name, '') AS metric, n AS value FROM profile"
        f" UNION ALL SELECT 'funnel', metric, value FROM ({funnel}) UNION ALL {sizes}"
        f" UNION ALL SELECT 'sample_size', '{dataset}', count(*) FROM labelled UNION ALL " + " UNION ALL ".join(facts)
    )


def with_texts(numbers: str, texts: dict[str, str]) -> str:
    """The summary's numbers, and its texts as rows of their own."""
    rows = " UNION ALL ".join(f"SELECT 'facts', '{k}', CAST(NULL AS BIGINT), '{v}'" for k, v in texts.items())
    return f"SELECT section, metric, value, CAST(NULL AS VARCHAR) AS text FROM ({numbers}) UNION ALL {rows}"


CORPUS_FACTS = {"dataset": "corpus", "split": "train"}
BENCHMARK_FACTS = {"source_root": "benchmark", "tables_file": "tables.json", "train_file": "train.json"}
CORPUS_SUMMARY = D.with_(
    *D.CORPUS_STEPS,
    CORPUS_PROFILE,
    D.split_step("deduped", OPTIONS),
    select=with_texts(summary_select("corpus", ("example_id", *CORPUS_TEXT.split(", ")), FUNNEL_ROWS), CORPUS_FACTS),
)


@check("a6_run_summary", CORPUS_SUMMARY)
def _(spark, sf):
    source = views.corpus(spark, sf)
    classified = materialize(classified_corpus(spark, sf), "classified")
    ids = materialize(jobs.deduped_ids(classified), "ids")
    return profiles.run_summary(
        "corpus",
        source.columns,
        profiles.corpus_profile(source),
        profiles.curate_funnel(classified, filters.CORPUS_REASONS),
        jobs.sample_and_split(ids, ids),
        OPTIONS.seed,
        CORPUS_FACTS,
    )


@check(
    "a6_prepare_summary",
    D.with_(
        *D.EXAMPLE_STEPS,
        EXAMPLES_PROFILE,
        D.split_step("prepared", BENCHMARK),
        select=with_texts(summary_select("benchmark", ("example_id", *EXAMPLE_COLUMNS), PREPARE_ROWS), {"dataset": "benchmark", **BENCHMARK_FACTS}),
    ),
)
def _(spark, sf):
    out = scratch_path(spark, "prepared")
    return jobs.run_prepare(
        spread(views.examples(spark, sf), "example_id"), views.raw_catalog(spark, sf), out, BENCHMARK, facts=BENCHMARK_FACTS
    )


SAMPLE = 5000


@check(
    "r1_sample",
    D.with_(
        D.view("corpus"),
        select=f"SELECT example_id, sql_prompt FROM corpus ORDER BY {D.order_key('example_id', DEFAULT_SEED, 'sample')} LIMIT {SAMPLE}",
    ),
)
def _(spark, sf):
    rows = views.corpus(spark, sf).select("example_id", "sql_prompt")
    return ranking.sample(rows, "example_id", SAMPLE, DEFAULT_SEED)


@check("r2_split", D.with_(D.view("corpus"), D.split_step("corpus", OPTIONS), select="SELECT example_id, split FROM labelled"))
def _(spark, sf):
    return labelled_ids(spark, sf)


@check("r2_split_no_test", D.with_(D.view("corpus"), D.split_step("corpus", BENCHMARK), select="SELECT example_id, split FROM labelled"))
def _(spark, sf):
    return labelled_ids(spark, sf, BENCHMARK)


@check("r4_top_databases", D.with_(D.view("examples"), select="SELECT db_id, count(*) AS n FROM examples GROUP BY db_id ORDER BY n DESC, db_id LIMIT 10"))
def _(spark, sf):
    return ranking.top_k(views.examples(spark, sf), "db_id")
