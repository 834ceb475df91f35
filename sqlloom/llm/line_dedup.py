"""Line dedup: a line repeated across documents stays only in the document with the smallest id.

A text is split at ``\\n`` (a null or empty text is one empty line). A line's key is the line with
the white space ``[\\x20\\x09-\\x0D]`` stripped from both ends and A-Z lower-cased. A key of at least
``MIN_CHARS`` code points is repeated when two or more rows hold it; its lines are then dropped from
every row except those whose doc_id is the smallest doc_id among its holders. Other lines stay, in
order, joined by ``\\n``.

Method: two Bloom filters, one of hashes seen once and one of hashes seen twice. Every task sets the
bits of the key hashes of its rows (each key counted once a row); hashes held by two rows of the task
set their bits in the twice filter as well. Spark merges the bit positions of all tasks by an
aggregation with partial sums: a bit is in the once filter when any task set it, and in the twice
filter when a task set it there or two tasks set it in the once filter. Every key held by two rows
is then in the twice filter (no false negatives); a few others are there by chance. Only lines whose
key is in the twice filter -- the suspected repeats -- shuffle, by their exact key, to confirm the
repeat and choose the smallest doc_id. Documents without a dropped line keep their text untouched.

The filters have ``BITS`` bits: that is the size bound of the one broadcast (the twice filter,
BITS / 8 bytes), whatever the input. Tasks send only the positions they set, so a small input sends
little. Past about BITS / 8 distinct keys the filter fills, more lines become suspects, and the exact
step does more work; results never change with the size. The candidate lines (key at least
MIN_CHARS long) are written once, and both the filter pass and the probe read them.

Defined cases: a null text is one empty line, as is an empty text; a row with a null doc_id drops
every repeated line whose holders have a non-null doc_id, and keeps the lines of a key that only
rows without id hold; repeated rows (equal doc_id and text) hold a key each, and keep or drop alike;
several lines of one key in the smallest document all stay; an empty table gives no rows; other
columns pass through, and ``n_lines`` / ``n_dropped`` replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from sqlloom.operators.joins import fits_broadcast, lookup, measured_size
from sqlloom.options import JoinOptions
from sqlloom.sources.scratch import RunScratch

# Fixed values of the contract: the white space stripped from a line's ends, the least key length.
BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS = 10

HASHES = 4
BITS = 1 << 27
BLOCK = 1 << 16  # bits of the twice filter fetched a row at a time

_DOC, _TH, _POS, _LINE, _KEY, _H = "__doc", "__th", "__pos", "__line", "__key", "__h"


def line_key(line) -> F.Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.btrim(line, F.lit(BLANKS)), upper, lower)


def _identity(docs: DataFrame, text: str) -> DataFrame:
    """Rows are told apart by doc_id and a hash of their text: equal rows get equal results anyway."""
    return docs.withColumns({_DOC: F.col("doc_id"), _TH: F.xxhash64(F.coalesce(F.col(text), F.lit("")))})


def lines_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc, th, pos, line, key, h) for every line of every row; h only for keys long enough."""
    exploded = _identity(docs, text).select(_DOC, _TH, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias(_POS, _LINE))
    keyed = exploded.withColumn(_KEY, line_key(F.col(_LINE)))
    return keyed.withColumn(_H, F.when(F.char_length(_KEY) >= MIN_CHARS, F.xxhash64(_KEY)))


def positions(h: np.ndarray, bits: int) -> np.ndarray:
    """HASHES bit positions of each hash (rows), by double hashing of its two halves."""
    u = h.astype(np.int64).view(np.uint64)
    first, second = u & np.uint64(0xFFFFFFFF), (u >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)
    return ((first[:, None] + steps[None, :] * second[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def _task_bits(bits: int):
    """Per task: (bit, seen) with seen 2 where a hash of the task is held by two rows, else 1."""

    def compute(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [f for f in frames if len(f)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True).drop_duplicates()
        h, counts = np.unique(rows[_H].to_numpy(np.int64), return_counts=True)
        at = positions(h, bits)
        seen = np.repeat(np.where(counts >= 2, 2, 1), HASHES)
        out = pd.DataFrame({"bit": at.ravel(), "seen": seen.astype(np.int8)})
        yield out.groupby("bit", as_index=False)["seen"].max()

    return compute


def twice_filter(candidates: DataFrame, bits: int, scratch: RunScratch) -> bytes:
    """The merged twice filter, ``bits`` bits packed little-endian into bits / 8 bytes."""
    task_bits = candidates.select(_DOC, _TH, _H).mapInPandas(_task_bits(bits), "bit long, seen byte")
    merged = task_bits.groupBy("bit").agg(F.count(F.lit(1)).alias("tasks"), F.max("seen").alias("seen"))
    twice = merged.where((F.col("tasks") >= 2) | (F.col("seen") >= 2))
    blocks = scratch.write(twice.groupBy(F.shiftright("bit", BLOCK.bit_length() - 1).alias("block")).agg(F.collect_list(F.col("bit") % BLOCK).alias("at")), "twice")
    packed = np.zeros(bits // 8, np.uint8)
    for row in blocks.toLocalIterator():
        at = row["block"] * BLOCK + np.asarray(row["at"], np.int64)
        np.bitwise_or.at(packed, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
    return packed.tobytes()


def _suspect(flags):
    @F.pandas_udf(T.BooleanType())
    def suspect(h: pd.Series) -> pd.Series:
        known = h.notna().to_numpy()
        out = np.zeros(len(h), bool)
        if known.any():
            bitmap = np.frombuffer(flags.value, np.uint8)
            at = positions(h[known].to_numpy(np.int64), len(bitmap) * 8)
            out[known] = ((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
        return pd.Series(out)

    return suspect


@F.pandas_udf(T.StringType())
def _kept(text: pd.Series, dropped: pd.Series) -> pd.Series:
    def keep(t, gone):
        if gone is None:
            return t
        gone = set(int(i) for i in gone)
        return "\n".join(line for i, line in enumerate((t or "").split("\n")) if i not in gone)

    return pd.Series([keep(t, g) for t, g in zip(text, dropped)], dtype=object)


def dropped_lines(docs: DataFrame, text: str = "text", scratch: RunScratch | None = None, options: JoinOptions = JoinOptions()) -> DataFrame:
    """(doc, th, dropped): the sorted positions of the dropped lines of each row that loses any."""
    spark = docs.sparkSession
    scratch = scratch or RunScratch(spark, "line-dedup")
    candidates = scratch.write(lines_of(docs, text).where(F.col(_H).isNotNull()).select(_DOC, _TH, _POS, _KEY, _H), "candidates")
    flags = twice_filter(candidates, BITS, scratch)
    shared = spark.sparkContext.broadcast(flags)
    suspects = scratch.write(candidates.where(_suspect(shared)(F.col(_H))).select(_DOC, _TH, _POS, _KEY), "suspects")
    shared.unpersist()
    keepers = suspects.groupBy(_KEY).agg(F.min(_DOC).alias("__keeper"))
    judged = lookup(suspects, keepers, _KEY, spread_by=_POS, options=options)
    gone = judged.where(F.col("__keeper").isNotNull() & (F.col(_DOC).isNull() | (F.col(_DOC) > F.col("__keeper"))))
    per_row = gone.groupBy(_DOC, _TH).agg(F.array_sort(F.array_distinct(F.collect_list(_POS))).alias("__dropped"))
    return scratch.write(per_row, "dropped")


def dedupe_lines(docs: DataFrame, text: str = "text", options: JoinOptions = JoinOptions()) -> DataFrame:
    """Every row of ``docs`` with its text's repeated lines dropped, ``n_lines`` (before dropping) and
    ``n_dropped``. Rows keep their other columns."""
    dropped = dropped_lines(docs, text, options=options)
    side = F.broadcast(dropped) if fits_broadcast(*measured_size(dropped), options) else dropped
    rows = _identity(docs, text)
    joined = rows.join(side, [rows[_DOC].eqNullSafe(side[_DOC]), rows[_TH] == side[_TH]], "left").drop(side[_DOC]).drop(side[_TH])
    n_lines = F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).cast("long")
    n_dropped = F.coalesce(F.size("__dropped"), F.lit(0)).cast("long")
    kept = F.when(F.col("__dropped").isNull(), F.col(text)).otherwise(_kept(F.when(F.col("__dropped").isNotNull(), F.col(text)), F.col("__dropped")))
    out = joined.withColumns({"n_lines": n_lines, "n_dropped": n_dropped}).withColumn(text, kept)
    return out.drop(_DOC, _TH, "__dropped")


def oracle() -> str:
    """DuckDB: the same result from whole keys, without filters."""
    blanks = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS t FROM documents),
l AS (
  SELECT doc_id, t, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d
),
k AS (
  SELECT *, translate(trim(line, {blanks}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
),
j AS (
  SELECT *, CASE WHEN length(key) >= {MIN_CHARS} THEN min(doc_id) OVER (PARTITION BY key) END AS keeper FROM k
),
f AS (
  SELECT *, coalesce(keeper IS NOT NULL AND (doc_id IS NULL OR doc_id > keeper), false) AS gone FROM j
),
r AS (
  SELECT doc_id, t, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
  FROM f GROUP BY doc_id, t
)
SELECT r.doc_id AS doc_id, r.n_lines AS n_lines, r.n_dropped AS n_dropped, sha256(r.kept) AS kept_sha256
FROM documents AS s JOIN r ON r.doc_id IS NOT DISTINCT FROM s.doc_id AND r.t = coalesce(s.text, '')
"""
