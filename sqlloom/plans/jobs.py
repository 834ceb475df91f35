"""The three jobs: curate a corpus, prepare a benchmark source, build supervision tables.

``screen`` and ``with_messages`` only compose expressions. All else may write: lookups are written
and measured where the plan is built, and ``run_*`` ends lineage at Parquet tables in the shared
scratch folder, so counters, splits and sinks read a finished table instead of repeating the work
above it. ``run_*`` deletes the tables of its run when it is done; plans that are handed back still
read theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sqlloom.functions import tokens
from sqlloom.functions.sqltext import (
    canonical_script,
    canonical_sql,
    schema_statements,
    target_sql,
)
from sqlloom.functions.text import normalize_whitespace, sql_key, strip, text_key, text_or_empty
from sqlloom.functions.validity import valid_sqlite
from sqlloom.operators import filters, profiles, ranking, supervision
from sqlloom.operators.catalog import attach_schema, normalize_catalog, rendered_schemas
from sqlloom.operators.dedupe import dedupe_digest, keep_first
from sqlloom.operators.joins import fits_broadcast, measured_size
from sqlloom.operators.leaks import flag_leaks
from sqlloom.operators.answers import exact_match
from sqlloom.operators.messages import prompt_messages, render_chat, training_messages
from sqlloom.options import CurateOptions, TokenOptions
from sqlloom.sources.contracts import require_columns
from sqlloom.sources.readers import MESSAGES, load_split_files, read_json_lines
from sqlloom.sources.scratch import materialize, run_scratch
from sqlloom.sources.spread import sorting_tasks, spread
from sqlloom.sources.sinks import write_splits, write_summary

ORDINAL = "example_id"

# The output tables' column names.
CURATED_COLUMNS = (
    "domain",
    "domain_description",
    "sql_complexity",
    "sql_task_type",
    "sql_prompt",
    "sql_context_raw",
    "schema_ddl",
    "sql",
    "sql_explanation",
)
PREPARED_COLUMNS = ("db_id", "sql_prompt", "schema_ddl", "sql")


def _if_kept(value: Column) -> Column:
    return F.when(F.col("drop_reason").isNull(), value)


def screen(source: DataFrame, options: CurateOptions = CurateOptions()) -> DataFrame:
    """Rules up to schema presence, row by row (also usable on a stream).

    Dropped rows lose their payload before the Python step, so it and everything after it carry
    only their id and reason.
    """
    rules = options.filters
    texts = spread(require_columns(source), ORDINAL).select(
        ORDINAL,
        "domain",
        "domain_description",
        "sql_complexity",
        text_or_empty("sql_task_type").alias("sql_task_type"),
        normalize_whitespace("sql_prompt").alias("sql_prompt"),
        text_or_empty("sql_context").alias("sql_context"),
        normalize_whitespace("sql").alias("sql"),
        F.col("sql_explanation"),
    )
    cheap = filters.first_reason(
        *filters.cheap_rules(F.col("sql_prompt"), F.col("sql"), F.col("sql_task_type"), rules)
    )
    payload = [c for c in texts.columns if c != ORDINAL]
    screened = texts.withColumn("drop_reason", cheap).withColumns(
        {c: _if_kept(F.col(c)) for c in payload}
    )
    checked = screened.withColumn("sql_valid", valid_sqlite("sql"))
    parsed = checked.withColumn(
        "drop_reason", F.when(~F.col("sql_valid"), F.lit(filters.PARSE_FAILED)).otherwise(F.col("drop_reason"))
    )
    with_ddl = parsed.withColumn(
        "ddl", _if_kept(schema_statements("sql_context", rules.keep_create_view))
    )
    if rules.require_schema_context:
        no_ddl = F.size("ddl") == 0
        with_ddl = with_ddl.withColumn(
            "drop_reason", F.when(no_ddl, F.lit(filters.MISSING_DDL)).otherwise(F.col("drop_reason"))
        )
    return with_ddl.drop("sql_valid")


def classify_corpus(
    source: DataFrame, blocklist: DataFrame | None = None, options: CurateOptions = CurateOptions()
) -> DataFrame:
    """Every source row with its drop_reason; kept rows with their curated columns and
    dedupe_key, dropped rows with nulls."""
    rows = screen(source, options)
    rows = rows.withColumns(
        {
            "sql": _if_kept(canonical_sql("sql")),
            "schema_ddl": _if_kept(canonical_script(F.col("ddl"))),
            "sql_context_raw": _if_kept(strip("sql_context")),
            "sql_explanation": _if_kept(normalize_whitespace("sql_explanation")),
        }
    )
    if blocklist is not None:
        rows = flag_leaks(
            rows,
            blocklist,
            _if_kept(text_key("sql_prompt")),
            _if_kept(sql_key("sql")),
            ORDINAL,
            options.joins,
        )
        leaked = F.col("drop_reason").isNull() & F.col("leaked")
        rows = rows.withColumn(
            "drop_reason", F.when(leaked, F.lit(filters.LEAKED)).otherwise(F.col("drop_reason"))
        )
    return rows.select(
        ORDINAL,
        *(_if_kept(F.col(c)).alias(c) for c in CURATED_COLUMNS),
        "drop_reason",
    ).withColumn("dedupe_key", _if_kept(dedupe_digest(options.dedupe_on)))


def deduped_rows(classified: DataFrame) -> DataFrame:
    """``classified`` should be a written table: in one plan with the rules, the filter would sink
    below them and evaluate them again."""
    kept = classified.where(F.col("drop_reason").isNull())
    return keep_first(kept, ["dedupe_key"], ORDINAL).select(ORDINAL, *CURATED_COLUMNS)


def deduped_ids(classified: DataFrame) -> DataFrame:
    """Ids of deduped_rows from two narrow columns, by hash aggregation."""
    kept = classified.where(F.col("drop_reason").isNull())
    return kept.groupBy("dedupe_key").agg(F.min(ORDINAL).alias(ORDINAL)).select(ORDINAL)


def with_messages(rows: DataFrame, options: CurateOptions = CurateOptions()) -> DataFrame:
    """Messages repeat other columns, so they are added last and never shuffled."""
    explanation = F.col("sql_explanation") if "sql_explanation" in rows.columns else None
    return rows.withColumn(
        "messages",
        training_messages(
            F.col("sql_prompt"), F.col("schema_ddl"), F.col("sql"), options.prompt, explanation
        ),
    )


def labelled_rows(
    classified: DataFrame, ids: DataFrame, options: CurateOptions = CurateOptions()
) -> DataFrame:
    """The surviving rows that are sampled, with their split. Sample and split are decided on the
    ids; the wide rows meet the labelled ids in one join, without a shuffle when those are few."""
    labels = materialize(sample_and_split(ids, ids, options).select(ORDINAL, "split"), "labels")
    side = F.broadcast(labels) if fits_broadcast(*measured_size(labels), options.joins) else labels.hint("shuffle_hash")
    return classified.join(side, ORDINAL).select(ORDINAL, *CURATED_COLUMNS, "split")


def sample_and_split(
    rows: DataFrame, ids: DataFrame, options: CurateOptions = CurateOptions()
) -> DataFrame:
    """Ranks come from ``ids``, a written table with the ids of ``rows``, so the rows themselves
    are only passed through."""
    edges = ids.select(ORDINAL)
    sampled = ranking.sample(rows, ORDINAL, options.sample_size, options.seed, edges)
    sampled_ids = ranking.sample(edges, ORDINAL, options.sample_size, options.seed)
    return ranking.split(sampled, ORDINAL, options.ratios, options.seed, sampled_ids)


def curated_rows(
    source: DataFrame, blocklist: DataFrame | None = None, options: CurateOptions = CurateOptions()
) -> DataFrame:
    """Curated corpus with split and messages."""
    classified = materialize(classify_corpus(source, blocklist, options), "classified")
    ids = materialize(deduped_ids(classified), "ids")
    return with_messages(labelled_rows(classified, ids, options), options)


def run_curate(
    source: DataFrame,
    out: str,
    blocklist: DataFrame | None = None,
    options: CurateOptions = CurateOptions(),
    dataset: str = "corpus",
    split: str = "train",
) -> DataFrame:
    """Curate ``source``, a split of a dataset, into ``out``: splits as JSON lines, and summary.
    Gives the summary as written."""
    with run_scratch(source.sparkSession, "curate"):
        return _run_curate(source, out, blocklist, options, dataset, split)


def _run_curate(
    source: DataFrame, out: str, blocklist: DataFrame | None, options: CurateOptions, dataset: str, split: str
) -> DataFrame:
    classified = materialize(classify_corpus(source, blocklist, options), "classified")
    ids = materialize(deduped_ids(classified), "ids")
    labelled = labelled_rows(classified, ids, options)
    write_splits(with_messages(labelled, options), f"{out}/all_cleaned")
    summary = profiles.run_summary(
        dataset,
        source.columns,
        profiles.corpus_profile(source),
        profiles.curate_funnel(classified, filters.CORPUS_REASONS),
        sample_and_split(ids, ids, options),
        options.seed,
        {"dataset": dataset, "split": split},
    )
    write_summary(summary, f"{out}/summary")
    return read_json_lines(summary.sparkSession, f"{out}/summary", summary.schema)


def classify_examples(
    examples: DataFrame, catalog: DataFrame, options: CurateOptions = CurateOptions()
) -> DataFrame:
    """Every example with drop_reason, sql_valid and its prepared columns. Duplicates and
    invalid SQL stay in, and this source is never sampled."""
    texts = spread(examples, ORDINAL).select(
        ORDINAL,
        text_or_empty("db_id").alias("db_id"),
        normalize_whitespace("question").alias("sql_prompt"),
        normalize_whitespace("query").alias("sql"),
    )
    incomplete = filters.missing_fields(F.col("sql_prompt"), F.col("sql"), F.col("db_id"))
    screened = texts.withColumn(
        "drop_reason", filters.first_reason((filters.MISSING_FIELDS, incomplete))
    )
    schemas = rendered_schemas(normalize_catalog(catalog))
    found = attach_schema(screened, schemas, ORDINAL, options.joins)
    unknown = F.col("drop_reason").isNull() & F.col("schema_ddl").isNull()
    found = found.withColumn(
        "drop_reason", F.when(unknown, F.lit(filters.MISSING_SCHEMA)).otherwise(F.col("drop_reason"))
    )
    checked = found.withColumn("sql_valid", valid_sqlite(_if_kept(F.col("sql"))))
    text = F.when(F.col("sql_valid"), canonical_sql("sql")).otherwise(target_sql("sql"))
    return checked.select(
        ORDINAL,
        "drop_reason",
        "sql_valid",
        *(_if_kept(text if c == "sql" else F.col(c)).alias(c) for c in PREPARED_COLUMNS),
    )


def prepared_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("drop_reason").isNull()).select(ORDINAL, *PREPARED_COLUMNS)


def prepared_splits(
    examples: DataFrame, catalog: DataFrame, options: CurateOptions = CurateOptions()
) -> DataFrame:
    classified = materialize(classify_examples(examples, catalog, options), "classified")
    kept = prepared_rows(classified)
    labelled = ranking.split(kept, ORDINAL, options.ratios, options.seed)
    # A write by split sorts whole rows.
    return with_messages(labelled.repartition(sorting_tasks(classified), ORDINAL), options)


def run_prepare(
    examples: DataFrame,
    catalog: DataFrame,
    out: str,
    options: CurateOptions = CurateOptions(),
    dataset: str = "benchmark",
    facts: dict[str, str] | None = None,
) -> DataFrame:
    """Prepare a benchmark source into ``out``. ``facts`` are texts for the summary, such as the
    source's root and file names. Gives the summary as written."""
    with run_scratch(examples.sparkSession, "prepare"):
        return _run_prepare(examples, catalog, out, options, dataset, facts or {})


def _run_prepare(
    examples: DataFrame, catalog: DataFrame, out: str, options: CurateOptions, dataset: str, facts: dict[str, str]
) -> DataFrame:
    classified = materialize(classify_examples(examples, catalog, options), "classified")
    kept = prepared_rows(classified)
    labelled = ranking.split(kept, ORDINAL, options.ratios, options.seed)
    # The write sorts whole rows by split.
    dealt = labelled.repartition(sorting_tasks(classified), ORDINAL)
    write_splits(with_messages(dealt, options), f"{out}/all_cleaned")
    summary = profiles.run_summary(
        dataset,
        examples.columns,
        profiles.examples_profile(examples),
        profiles.prepare_funnel(classified),
        labelled,
        options.seed,
        {"dataset": dataset, **facts},
    )
    write_summary(summary, f"{out}/summary")
    return read_json_lines(summary.sparkSession, f"{out}/summary", summary.schema)


def tokenized_rows(
    rows: DataFrame,
    options: TokenOptions = TokenOptions(),
    encoder: tokens.Encoder | None = None,
) -> DataFrame:
    """Written table (example_id, full_ids, prompt_len) of rows with messages.

    It is written because rows are dropped by it: in one plan that filter would sink below the
    tokenizer and run it again. Masks and labels follow from it and are not stored.
    """
    # Spark cannot plan one Python function over array expressions over another one, which is what a
    # tokenizer on top of the validity check would be.
    chat = materialize(rows.select(ORDINAL, "messages"), "messages")
    tokenized = supervision.tokenize(chat, "messages", options, encoder).drop("messages")
    return materialize(tokenized, "tokens")


def supervised_rows(
    rows: DataFrame,
    options: TokenOptions = TokenOptions(),
    encoder: tokens.Encoder | None = None,
) -> DataFrame:
    """(example_id, input_ids, attention_mask, labels), rows without room for an answer left out."""
    masked = supervision.mask_labels(tokenized_rows(rows, options, encoder))
    return supervision.drop_skipped(masked)


def padded_batches(
    rows: DataFrame,
    seed: int,
    options: TokenOptions = TokenOptions(),
    encoder: tokens.Encoder | None = None,
) -> DataFrame:
    """Supervision table in length-grouped, right-padded batches.

    Planning reads ids and sizes only. The token arrays move once, in the join on the unique id;
    masks, labels and padding are built after it.
    """
    tokenized = supervision.with_room(tokenized_rows(rows, options, encoder))
    batches = supervision.plan_batches(tokenized, ORDINAL, seed, options)
    masked = supervision.mask_labels(tokenized.join(batches, ORDINAL)).drop("skip_example")
    return supervision.pad(masked, options)


def run_supervision(
    train: DataFrame,
    evaluation: DataFrame,
    out: str,
    options: CurateOptions = CurateOptions(),
    encoder: tokens.Encoder | None = None,
) -> DataFrame:
    """Write padded train and eval batches as Parquet; gives (part, rows) after tokenizing."""
    spark = train.sparkSession
    counts = []
    for part, rows in (("train", train), ("eval", evaluation)):
        path = f"{out}/{part}"
        with run_scratch(spark, "supervision"):
            padded_batches(rows, options.seed, options.tokens, encoder).write.parquet(path)
        written = spark.read.parquet(path)
        counts.append(written.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(part).alias("part"), "rows"))
    return counts[0].unionByName(counts[1])


def run_supervision_files(
    spark: SparkSession,
    train: str,
    validation: str | None,
    out: str,
    options: CurateOptions = CurateOptions(),
    encoder: tokens.Encoder | None = None,
) -> DataFrame:
    """``run_supervision`` over JSON lines with messages; a validation file that isn't there is
    replaced by the first rows of train."""
    schema = T.StructType([T.StructField(ORDINAL, T.LongType()), T.StructField("messages", MESSAGES)])
    tables = load_split_files(spark, train, validation, schema, ORDINAL)
    return run_supervision(*tables, out, options, encoder)


def inference_prompts(rows: DataFrame, options: CurateOptions = CurateOptions()) -> DataFrame:
    """(example_id, prompt): what a model is asked for rows with sql_prompt and schema_ddl, in the
    options' inference format."""
    asked = prompt_messages(F.col("sql_prompt"), F.col("schema_ddl"), options.prompt, options.prompt.inference_format)
    return rows.select(ORDINAL, render_chat(asked, True).alias("prompt"))


def score_responses(responses: DataFrame, gold: DataFrame, groups: list[str]) -> DataFrame:
    """Exact-match rate by group of decoded responses (example_id, response) against ``gold``
    (example_id, gold_sql and the groups)."""
    return exact_match(responses, gold, ORDINAL, groups)
