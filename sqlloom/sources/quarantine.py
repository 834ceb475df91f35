"""Malformed source records: counted by file, set aside, and fatal past a stated share.

JSON sources are read in Spark's permissive mode with a corrupt-record column: a line that does not
parse, a value of the wrong type, or a cut-off array file becomes a row whose raw text is in that
column. The parsed rows are written once; the good ones go on, the bad ones are counted by file and,
if a quarantine folder is named, written there with their file and text. When the bad rows are more
than ``max_bad_share`` of all rows the read raises ``MalformedSourceError``, naming the worst files;
the default share 0 raises on the first bad record, as a strict JSON reader would.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sqlloom.sources.scratch import scratch_path

CORRUPT = "_corrupt_record"
FILE = "source_file"


class MalformedSourceError(ValueError):
    """More malformed records than the policy allows."""


@dataclass(frozen=True)
class MalformedPolicy:
    max_bad_share: float = 0.0
    quarantine_path: str | None = None
    named_files: int = 5  # files named in the error, worst first


@dataclass(frozen=True)
class CheckedRead:
    good: DataFrame  # rows that parsed, in the declared schema
    counts: DataFrame  # (source_file, rows, bad_rows) per file read
    rows: int
    bad_rows: int


def read_json_checked(
    spark: SparkSession, path: str | list[str], schema: T.StructType, lines: bool = True, policy: MalformedPolicy = MalformedPolicy()
) -> CheckedRead:
    """Read JSON (lines, or one array a file) with malformed records counted and set aside."""
    if CORRUPT in schema.fieldNames():
        raise ValueError(f"{CORRUPT} is the reader's own column")
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", not lines)
    raw = reader.json(path).withColumn(FILE, F.col("_metadata.file_path"))
    # Written once: later passes read files, not the source again, and may ask for the text column alone.
    stored = scratch_path(spark, "checked-source")
    raw.write.parquet(stored)
    parsed = spark.read.parquet(stored)
    counts = parsed.groupBy(FILE).agg(F.count(F.lit(1)).alias("rows"), F.count(CORRUPT).alias("bad_rows"))
    totals = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("bad_rows"), F.lit(0))).first()
    rows, bad = int(totals[0]), int(totals[1])
    if policy.quarantine_path and bad:
        parsed.where(F.col(CORRUPT).isNotNull()).select(FILE, F.col(CORRUPT).alias("record")).write.mode("overwrite").parquet(f"{policy.quarantine_path}/records")
        counts.write.mode("overwrite").parquet(f"{policy.quarantine_path}/counts")
    if bad > policy.max_bad_share * rows:
        worst = counts.where(F.col("bad_rows") > 0).orderBy(F.col("bad_rows").desc(), FILE).take(policy.named_files)
        named = ", ".join(f"{r[FILE]}: {r['bad_rows']} of {r['rows']}" for r in worst)
        raise MalformedSourceError(f"{bad} of {rows} records are malformed (allowed share {policy.max_bad_share}): {named}")
    good = parsed.where(F.col(CORRUPT).isNull()).select(*schema.fieldNames())
    return CheckedRead(good, counts, rows, bad)
