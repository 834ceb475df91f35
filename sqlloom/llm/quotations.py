"""Chat formatting by quotation linking: reply trees from quoted passages, without the quotes.

A line's quote level is the number of ``>`` in front of it. Lines of one level that follow each other
are reflowed and cut into sentences; a normalised sentence (lower case, single spaces, no marks at
the ends) is a passage, kept by its hash and length. A quoted passage belongs to the first message
of the conversation whose own text, at level 0, has it. A message's parent is the earlier message to
which most characters of its level-1 passages belong (of its deeper passages if those are all that
belong anywhere); ties go to the later message. Then each message has a root and a depth, found by
pointer doubling, and its place in reply order: by (turn of the root, depth, turn).

A conversation or a passage may hold any share of all rows: first messages are minima with partial
aggregates, joins have one row a key on one side, and places come from a range sort.

Defined cases: a null text is empty; a message without quotes that belong anywhere is a root; lines
that announce a quote ("... wrote:") right before it go with it; a message of quotes alone stays with
an empty text; messages with equal turns can't be each other's parent; repeated rows are messages of
their own; messages without a conversation or turn are roots with position null; an empty table gives
no rows; other columns are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sqlloom.llm.common import arrow_batch
from sqlloom.llm.ordering import sums_in_front
from sqlloom.sources.scratch import RunScratch

QUOTE = re.compile(r"[ \t]*((?:>[ \t]?)+)")
ANNOUNCES = re.compile(r".{0,200}\b(?:wrote|writes|said|schrieb|a écrit|escribió)[ \t]*:[ \t]*|-+ ?original message ?-+[ \t]*", re.IGNORECASE)
SENTENCE_END = re.compile(r"(?<=[.!?])\s+")
LEAST = 3  # characters of a passage; shorter ones say nothing about their origin

PARSED = pa.schema(
    [("row", pa.int64()), ("text", pa.string())]
    + [(f"{s}_{k}", pa.list_(pa.int64())) for s in ("own", "quote") for k in ("hash", "length")]
    + [("quote_level", pa.list_(pa.int64()))]
)


def passages(lines: list[str]) -> list[tuple[int, int]]:
    """(hash, length) of the normalised sentences of reflowed lines."""
    out = []
    for sentence in SENTENCE_END.split(" ".join(lines)):
        plain = " ".join(sentence.lower().split()).strip(" .,;:!?\"'*_-")
        if len(plain) >= LEAST:
            out.append((xxhash.xxh3_64_intdigest(plain) - (1 << 63), len(plain)))
    return out


def parse(text: str) -> tuple[str, list[tuple[int, int]], list[tuple[int, int, int]]]:
    """(text without quotes, own passages, quoted passages with their level)."""
    runs: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        line = line.rstrip("\r")
        marks = QUOTE.match(line)
        level = marks.group(1).count(">") if marks else 0
        content = line[marks.end() :] if marks else line
        if not runs or runs[-1][0] != level:
            runs.append((level, []))
        runs[-1][1].append(content)
    kept, own, quoted = [], [], []
    for i, (level, lines) in enumerate(runs):
        if level:
            # Blank quoted lines part paragraphs, which are reflowed apart.
            for paragraph in _paragraphs(lines):
                quoted += [(level, h, n) for h, n in passages(paragraph)]
            continue
        if i + 1 < len(runs):
            at = len(lines) - 1
            while at >= 0 and not lines[at].strip():
                at -= 1
            if at >= 0 and ANNOUNCES.fullmatch(lines[at].strip()):
                lines = lines[:at]
        kept += lines
        for paragraph in _paragraphs(lines):
            own += passages(paragraph)
    return "\n".join(kept).strip("\n") if len(runs) > 1 or runs[0][0] else text, own, quoted


def _paragraphs(lines: list[str]) -> list[list[str]]:
    out: list[list[str]] = [[]]
    for line in lines:
        if line.strip():
            out[-1].append(line)
        elif out[-1]:
            out.append([])
    return [p for p in out if p]


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1_000):
            part = batch.slice(at, 1_000)
            parsed = [parse(t or "") for t in part.column("text").to_pylist()]
            yield arrow_batch(
                PARSED,
                row=part.column("row"),
                text=[p[0] for p in parsed],
                own_hash=[[h for h, _ in p[1]] for p in parsed],
                own_length=[[n for _, n in p[1]] for p in parsed],
                quote_hash=[[h for _, h, _ in p[2]] for p in parsed],
                quote_length=[[n for _, _, n in p[2]] for p in parsed],
                quote_level=[[v for v, _, _ in p[2]] for p in parsed],
            )


def _parents(parsed: DataFrame, scratch: RunScratch) -> DataFrame:
    """(row, parent, n_linked): the message replied to, by the passages that belong to it."""
    quotes = parsed.select("row", "conv_id", "turn", F.explode(F.arrays_zip("quote_hash", "quote_length", "quote_level")).alias("q"))
    quotes = quotes.select("row", "conv_id", "turn", F.col("q.quote_hash").alias("hash"), F.col("q.quote_length").alias("length"), F.col("q.quote_level").alias("level"))
    quotes = scratch.write(quotes.where("conv_id IS NOT NULL AND turn IS NOT NULL"), "quotes")
    own = parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("row", "conv_id", "turn", F.explode("own_hash").alias("hash"))
    asked = quotes.select("conv_id", "hash").distinct()
    first = own.join(asked, ["conv_id", "hash"], "left_semi").groupBy("conv_id", "hash").agg(F.min(F.struct("turn", "row")).alias("origin"))
    linked = quotes.join(first, ["conv_id", "hash"]).where("origin.turn < turn")
    votes = linked.groupBy("row", F.col("origin.row").alias("parent"), F.col("origin.turn").alias("parent_turn")).agg(
        F.sum(F.when(F.col("level") == 1, F.col("length")).otherwise(0)).alias("near"), F.sum("length").alias("all"), F.count(F.lit(1)).alias("n")
    )
    best = F.max(F.struct("near", "all", "parent_turn", "parent")).alias("best")
    return votes.groupBy("row").agg(best, F.sum("n").alias("n_linked")).select("row", F.col("best.parent").alias("parent"), F.col("best.parent_turn").alias("parent_turn"), "n_linked")


def _roots(links: DataFrame, scratch: RunScratch) -> DataFrame:
    """(row, root, depth) of the linked messages: pointers are doubled until all are at a root."""
    step, at = links.select("row", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), 0
    step = scratch.write(step, "up-0")
    while True:
        over = step.select(F.col("row").alias("root"), F.col("root").alias("higher"), F.col("depth").alias("more"))
        at += 1
        joined = step.join(over, "root", "left").select("row", F.coalesce("higher", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("higher").isNotNull().alias("moved"))
        joined = scratch.write(joined, f"up-{at}")
        moved = not joined.where("moved").isEmpty()
        step = joined.drop("moved")
        if not moved:
            return step


def link_replies(messages: DataFrame) -> DataFrame:
    """conv_id, position, turn, role, text, parent_turn, root_turn, depth, n_linked, chat: one row a
    message, ``position`` being its place in reply order and ``chat`` its ChatML form."""
    scratch = RunScratch(messages.sparkSession, "quotations")
    columns = [F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role"), F.col("text").alias("raw")]
    rows = scratch.write(messages.select(*columns).withColumn("row", F.monotonically_increasing_id()), "rows")
    fields = "row long, text string, own_hash array<long>, own_length array<long>, quote_hash array<long>, quote_length array<long>, quote_level array<long>"
    texts = rows.select("row", F.col("raw").alias("text")).mapInArrow(_parse_batches, fields)
    parsed = scratch.write(texts.join(rows.select("row", "conv_id", "turn", "role"), "row"), "parsed")
    links = scratch.write(_parents(parsed, scratch), "links")
    roots = _roots(links, scratch)
    turns = rows.select(F.col("row").alias("root"), F.col("turn").alias("root_turn"))
    placed = links.join(roots, "row").join(turns, "root").select("row", "parent_turn", "root_turn", "depth", "n_linked")
    told = parsed.select("row", "conv_id", "turn", "role", "text").join(placed, "row", "left")
    told = told.withColumns({"root_turn": F.coalesce("root_turn", "turn"), "depth": F.coalesce("depth", F.lit(0)).cast("long"), "n_linked": F.coalesce("n_linked", F.lit(0)).cast("long")})
    told = scratch.write(told, "told")
    order = told.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("row", "conv_id", "root_turn", "depth", "turn", F.lit(1).cast("long").alias("n"))
    at = scratch.write(sums_in_front(order, ["conv_id", "root_turn", "depth", "turn", "row"], scratch, "order").join(told.select("row", "conv_id"), "row"), "at")
    begin = at.groupBy("conv_id").agg(F.min("at").alias("begin"))
    position = at.join(begin, "conv_id").select("row", (F.col("at") - F.col("begin")).alias("position"))
    chat = F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("")), F.lit("\n"), F.col("text"), F.lit("<|im_end|>\n"))
    return told.join(position, "row", "left").select("conv_id", "position", "turn", "role", "text", "parent_turn", "root_turn", "depth", "n_linked", chat.alias("chat"))
