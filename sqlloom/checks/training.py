"""Messages, supervision, answers, sinks and whole jobs (sections 2.10 to 2.14)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F, types as T

from sqlloom.checks import duck as D
from sqlloom.checks.registry import check
from sqlloom.checks.scalar import chat_rows, documents
from sqlloom.checks.tables import BENCHMARK, CORPUS_SUMMARY, OPTIONS, classified_corpus
from sqlloom.functions import tokens
from sqlloom.functions.sqltext import canonical_ddl, extract_schema_ddl, target_sql
from sqlloom.functions.text import normalize_whitespace
from sqlloom.operators import answers, messages, supervision
from sqlloom.options import ADVANCED_REASONING, PromptOptions, TokenOptions
from sqlloom.plans import jobs, views
from sqlloom.sources import readers, sinks
from sqlloom.sources.scratch import materialize, scratch_path
from sqlloom.sources.spread import spread

PROMPT = PromptOptions()
REASONED = replace(PROMPT, include_explanation=True)
TOKENS = TokenOptions()
# Inside the range of prompt and chat lengths: rows are kept whole, cut and skipped.
BATCHES = TokenOptions(max_seq_length=95, batch_size=4, length_bucket=16)
# The same batches under the limit of a run: no prompt fills it, so every row is batched.
WHOLE = replace(BATCHES, max_seq_length=TOKENS.max_seq_length)

ROWS = (
    f"rows AS (SELECT example_id, {D.ws('sql_prompt')} AS sql_prompt, coalesce(schema_ddl, '') AS schema_ddl,"
    f" {D.target('sql')} AS sql, sql_explanation FROM corpus LEFT JOIN ddl USING (example_id))"
)
ROW_STEPS = (D.view("corpus"), D.CORPUS_DDL, ROWS)


def message_rows(contents: list[tuple[str, str]], source: str = "rows") -> str:
    return " UNION ALL ".join(
        f"SELECT example_id, {i} AS pos, '{role}' AS role, {content} AS content FROM {source}"
        for i, (role, content) in enumerate(contents)
    )


def exploded(df):
    # Outer: for an inner one Spark tests the size of the array, so it builds every message a second time,
    # below the repartitioning and thus in the few tasks of the scan. A chat is never empty.
    return df.select("example_id", F.posexplode_outer("messages").alias("pos", "m")).select(
        "example_id", "pos", "m.role", "m.content"
    )


@check("b2_user_message", D.with_(*ROW_STEPS, select=f"SELECT example_id, {D.user_message('sql_prompt', 'schema_ddl')} AS content FROM rows"))
def _(spark, sf):
    content = messages.user_message(F.col("sql_prompt"), F.col("schema_ddl"), PROMPT.user_template)
    return chat_rows(spark, sf).select("example_id", content.alias("content"))


@check("b3_messages", D.with_(*ROW_STEPS, select=message_rows(D.training_contents())))
def _(spark, sf):
    return exploded(chat_rows(spark, sf))


REASONED_ANSWER = (
    "CASE WHEN coalesce(sql_explanation, '') <> '' THEN 'Reasoning:' || chr(10) || "
    + D.strip("sql_explanation")
    + " || chr(10) || chr(10) || 'Final SQL:' || chr(10) || "
    + D.strip("sql")
    + f" ELSE {D.strip('sql')} END"
)


@check(
    "b3_messages_explained",
    D.with_(*ROW_STEPS, select=message_rows([("system", D.lit(PROMPT.reasoning_system_prompt)), D.training_contents()[1], ("assistant", REASONED_ANSWER)])),
)
def _(spark, sf):
    rows = spread(views.corpus(spark, sf), "example_id")
    chat = messages.training_messages(
        normalize_whitespace("sql_prompt"),
        canonical_ddl(extract_schema_ddl("sql_context")),
        target_sql("sql"),
        REASONED,
        F.col("sql_explanation"),
        ADVANCED_REASONING,
    )
    return exploded(rows.select("example_id", chat.alias("messages")))


@check("b4_render_chat", D.with_(*ROW_STEPS, select=f"SELECT example_id, {D.chat_text(D.training_contents())} AS full_text, {D.chat_text(D.training_contents()[:2], True)} AS prompt_text FROM rows"))
def _(spark, sf):
    chat = F.col("messages")
    return chat_rows(spark, sf).select(
        "example_id",
        messages.render_chat(chat).alias("full_text"),
        messages.render_chat(messages.without_answer(chat), True).alias("prompt_text"),
    )


# Turn by turn: a conversation of any length never has to fit into one row.
@check(
    "b4_render_turns",
    f"SELECT conv_id, turn, {D.lit(tokens.TURN_START)} || role || chr(10) || text || {D.lit(tokens.TURN_END)} || chr(10) AS rendered FROM conversations",
)
def _(spark, sf):
    rendered = messages.render_turn(F.col("role"), F.col("text"))
    return views.table(spark, sf, "conversations").select("conv_id", "turn", rendered.alias("rendered"))


CURATED = ", ".join(("example_id", *jobs.CURATED_COLUMNS))
PREPARED = ", ".join(("example_id", *jobs.PREPARED_COLUMNS))


@check("b5_curated_rows", D.with_(*D.CORPUS_STEPS, select=f"SELECT {CURATED} FROM deduped"))
def _(spark, sf):
    return jobs.deduped_rows(materialize(classified_corpus(spark, sf), "classified"))


@check("b5_prepared_rows", D.with_(*D.EXAMPLE_STEPS, select=f"SELECT {PREPARED} FROM prepared"))
def _(spark, sf):
    return jobs.prepared_rows(
        jobs.classify_examples(views.examples(spark, sf), views.raw_catalog(spark, sf))
    )


@check(
    "b6_inference_prompt",
    D.with_(*D.EXAMPLE_STEPS, select=f"SELECT example_id, {D.chat_text([('system', D.lit(PROMPT.reasoning_system_prompt)), D.training_contents()[1]], True)} AS prompt FROM prepared"),
)
def _(spark, sf):
    rows = jobs.prepared_rows(
        jobs.classify_examples(views.examples(spark, sf), views.raw_catalog(spark, sf))
    )
    return jobs.inference_prompts(rows)


def as_string(name: str):
    return F.col(name).cast("string").alias(name)


def as_text(values: str) -> str:
    return f"CAST({values} AS VARCHAR)"


@check("k1_tokens", D.with_(*ROW_STEPS, D.supervision_steps(BATCHES), select=f"SELECT example_id, {as_text('full_ids')} AS full_ids, prompt_len FROM sup"))
def _(spark, sf):
    rows = supervision.tokenize(chat_rows(spark, sf), "messages", BATCHES)
    return rows.select("example_id", as_string("full_ids"), F.col("prompt_len").cast("bigint").alias("prompt_len"))


@check(
    "k1_documents",
    f"SELECT doc_id, len(p) AS n_pieces, {as_text(D.piece_ids('p'))} AS ids FROM (SELECT doc_id, {D.pieces('text')} AS p FROM documents)",
)
def _(spark, sf):
    return documents(spark, sf).select(
        "doc_id",
        F.size(tokens.pieces(F.col("text"))).cast("bigint").alias("n_pieces"),
        tokens.hashed(F.col("text")).cast("string").alias("ids"),
    )


LABEL_ROWS = (
    f"SELECT example_id, CASE WHEN skip_example THEN '[]' ELSE {as_text('full_ids')} END AS input_ids,"
    f" CASE WHEN skip_example THEN '[]' ELSE {as_text(D.ONES)} END AS attention_mask,"
    f" CASE WHEN skip_example THEN '[]' ELSE {as_text(D.LABELS)} END AS labels, skip_example FROM sup"
)


@check("k2_label_mask", D.with_(*ROW_STEPS, D.supervision_steps(BATCHES), select=LABEL_ROWS))
def _(spark, sf):
    rows = supervision.mask_labels(supervision.tokenize(chat_rows(spark, sf), "messages", BATCHES))
    return rows.select("example_id", as_string("input_ids"), as_string("attention_mask"), as_string("labels"), "skip_example")


@check("k3_token_counts", D.with_(*ROW_STEPS, D.supervision_steps(BATCHES), select="SELECT count(*) AS rows_after, CAST(sum(n_tokens) AS BIGINT) AS tokens_after FROM kept"))
def _(spark, sf):
    return jobs.supervised_rows(chat_rows(spark, sf), BATCHES).agg(
        F.count(F.lit(1)).alias("rows_after"), F.sum(F.size("input_ids")).alias("tokens_after")
    )


BATCH_STEPS = (*ROW_STEPS, D.supervision_steps(BATCHES), D.batch_steps(OPTIONS.seed, BATCHES))
WHOLE_STEPS = (*ROW_STEPS, D.supervision_steps(WHOLE), D.batch_steps(OPTIONS.seed, WHOLE))
BATCH_ROWS = (
    f"SELECT example_id, length_bucket, batch_no, pad_to, {D.padded('full_ids', BATCHES.pad_id)} AS input_ids,"
    f" {D.padded(D.ONES, 0)} AS attention_mask, {D.padded(D.LABELS, supervision.MASKED)} AS labels FROM batches"
)


def corpus_batches(spark, sf):
    return jobs.padded_batches(chat_rows(spark, sf), OPTIONS.seed, WHOLE)


def curated_batches(spark, sf):
    curated = jobs.curated_rows(views.corpus(spark, sf), views.blocklist(spark, sf))
    return jobs.padded_batches(curated.where(F.col("split") == "train"), OPTIONS.seed, BATCHES)


def batch_output(df):
    return df.select(
        "example_id",
        F.col("length_bucket").cast("bigint").alias("length_bucket"),
        F.col("batch_no").cast("bigint").alias("batch_no"),
        F.col("pad_to").cast("bigint").alias("pad_to"),
        as_string("input_ids"),
        as_string("attention_mask"),
        as_string("labels"),
    )


@check("k4_padded_batches", D.with_(*WHOLE_STEPS, select=BATCH_ROWS))
def _(spark, sf):
    return batch_output(corpus_batches(spark, sf))


@check("k5_batch_plan", D.with_(*BATCH_STEPS, select="SELECT example_id, n_tokens AS length, length_bucket, batch_no, pad_to FROM batches"))
def _(spark, sf):
    rows = supervision.with_room(jobs.tokenized_rows(chat_rows(spark, sf), BATCHES))
    planned = supervision.plan_batches(rows, "example_id", OPTIONS.seed, BATCHES)
    return planned.select(
        "example_id", *(F.col(c).cast("bigint").alias(c) for c in ("length", "length_bucket", "batch_no", "pad_to"))
    )


@check("v1_answer_sql", D.with_(D.view("responses"), select=f"SELECT example_id, {D.answer('response')} AS answer FROM responses"))
def _(spark, sf):
    return views.responses(spark, sf).select("example_id", answers.answer_sql("response").alias("answer"))


@check(
    "v2_exact_match",
    D.with_(
        D.view("responses"),
        f"found AS (SELECT grp, {D.sql_tokens(D.answer('response'))} AS p, {D.sql_tokens('gold_sql')} AS g FROM responses)",
        f"scored AS (SELECT grp, {D.sql_key(D.canonical('p'))} = {D.sql_key(D.canonical('g'))} AS hit FROM found)",
        select="SELECT grp, count(*) AS n, count(*) FILTER (hit) AS matched, count(*) FILTER (hit) / count(*) AS rate FROM scored GROUP BY grp",
    ),
)
def _(spark, sf):
    both = spread(views.responses(spark, sf), "example_id")
    return jobs.score_responses(both.select("example_id", "response"), both.select("example_id", "gold_sql", "grp"), ["grp"])


@check("w1_jsonl", D.with_(D.view("corpus"), select="SELECT example_id, sql_prompt, sql_context, sql, sql_explanation FROM corpus"))
def _(spark, sf):
    path = scratch_path(spark, "jsonl")
    columns = ["example_id", "sql_prompt", "sql_context", "sql", "sql_explanation"]
    sinks.write_jsonl(views.corpus(spark, sf).select(columns), path)
    return readers.read_json_lines(spark, path, readers.with_ordinal(readers.CORPUS)).select(columns)


PREPARED_SCHEMA = T.StructType(
    [
        T.StructField("example_id", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in jobs.PREPARED_COLUMNS),
        T.StructField("messages", readers.MESSAGES),
        T.StructField("split", T.StringType()),
    ]
)
PREPARE_STEPS = (*D.EXAMPLE_STEPS, D.split_step("prepared", BENCHMARK))


@check("w2_splits", D.with_(*PREPARE_STEPS, select="SELECT split, example_id, sql_prompt, sql FROM labelled"))
def _(spark, sf):
    path = scratch_path(spark, "splits")
    rows = jobs.prepared_splits(views.examples(spark, sf), views.raw_catalog(spark, sf), BENCHMARK)
    sinks.write_splits(rows, path)
    parts = [
        sinks.read_split(spark, path, PREPARED_SCHEMA, s).withColumn("split", F.lit(s)) for s in sinks.SPLITS
    ]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.select("split", "example_id", "sql_prompt", "sql")


SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("section", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.LongType()),
        T.StructField("text", T.StringType()),
    ]
)


@check("w3_summary", CORPUS_SUMMARY)
def _(spark, sf):
    out = scratch_path(spark, "curated")
    jobs.run_curate(views.corpus(spark, sf), out, views.blocklist(spark, sf))
    return readers.read_json_lines(spark, f"{out}/summary", SUMMARY_SCHEMA)


@check(
    "m1_curate",
    D.with_(
        *D.CORPUS_STEPS,
        D.split_step("deduped", OPTIONS),
        select=f"SELECT {CURATED}, split, {D.chat_text(D.training_contents())} AS chat FROM labelled",
    ),
)
def _(spark, sf):
    rows = jobs.curated_rows(views.corpus(spark, sf), views.blocklist(spark, sf))
    return rows.select(*CURATED.split(", "), "split", messages.render_chat(F.col("messages")).alias("chat"))


@check("m2_prepare", D.with_(*PREPARE_STEPS, select=f"SELECT {PREPARED}, split, {D.chat_text(D.training_contents())} AS chat FROM labelled"))
def _(spark, sf):
    rows = jobs.prepared_splits(views.examples(spark, sf), views.raw_catalog(spark, sf), BENCHMARK)
    return rows.select(*PREPARED.split(", "), "split", messages.render_chat(F.col("messages")).alias("chat"))


@check(
    "m3_supervision",
    D.with_(
        *D.CORPUS_STEPS,
        D.split_step("deduped", OPTIONS),
        "rows AS (SELECT * FROM labelled WHERE split = 'train')",
        D.supervision_steps(BATCHES),
        D.batch_steps(OPTIONS.seed, BATCHES),
        select=BATCH_ROWS,
    ),
)
def _(spark, sf):
    return batch_output(curated_batches(spark, sf))


SAMPLED = replace(OPTIONS, sample_size=500)


@check(
    "m1_curate_sampled",
    D.with_(
        *D.CORPUS_STEPS,
        f"sampled AS (SELECT * FROM deduped ORDER BY {D.order_key('example_id', SAMPLED.seed, 'sample')}, CAST(example_id AS VARCHAR) LIMIT {SAMPLED.sample_size})",
        D.split_step("sampled", SAMPLED),
        select=f"SELECT {CURATED}, split FROM labelled",
    ),
)
def _(spark, sf):
    rows = jobs.curated_rows(views.corpus(spark, sf), views.blocklist(spark, sf), SAMPLED)
    return rows.select(*CURATED.split(", "), "split")


@check(
    "m3_run_supervision",
    D.with_(
        *PREPARE_STEPS,
        "rows AS (SELECT * FROM labelled WHERE split = 'train')",
        D.supervision_steps(BATCHES),
        select="SELECT 'train' AS part, count(*) AS rows FROM kept UNION ALL SELECT 'eval', count(*) FROM kept"
        " WHERE example_id IN (SELECT example_id FROM rows ORDER BY example_id LIMIT 8)",
    ),
)
def _(spark, sf):
    """From files; the validation file isn't there, so the first rows of train stand in."""
    out = scratch_path(spark, "supervision")
    rows = jobs.prepared_splits(views.examples(spark, sf), views.raw_catalog(spark, sf), BENCHMARK)
    sinks.write_jsonl(rows.where("split = 'train'").select("example_id", "messages"), f"{out}/train")
    options = replace(OPTIONS, tokens=BATCHES)
    return jobs.run_supervision_files(spark, f"{out}/train", f"{out}/validation", f"{out}/batches", options)
