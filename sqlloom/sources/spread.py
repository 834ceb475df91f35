"""Parallelism of small scans and of sorts of whole rows."""

from __future__ import annotations

import math
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

MAX_PARTITION_BYTES = "spark.sql.files.maxPartitionBytes"

#: Bytes of files for one task of rows that are spread.
TASK_BYTES = 8 * 2**20

#: Bytes of rows as text for one task that sorts them. In the sort catalog entries take six times as much.
SORTED_BYTES = 16 * 2**20


def spread(df: DataFrame, by: str) -> DataFrame:
    """Repartition by the unique ``by`` when the files under ``df`` cut into fewer scan tasks than
    the session has cores, into as many tasks as the files have ``TASK_BYTES``, so that a task doesn't
    grow with the table. A scan with enough tasks stays as it is, without a shuffle."""
    spark = df.sparkSession
    if df.isStreaming:
        return df
    # Counted on the JVM side: a large table has more names than should come over to Python.
    files = df._jdf.inputFiles()
    cores = spark.sparkContext.defaultParallelism
    if not 0 < len(files) < cores:
        return df
    try:
        sizes = spark.read.format("binaryFile").load([unquote(f) for f in files]).select("length")
    except AnalysisException:  # a file name the reader takes for a pattern
        return df
    split = _bytes(spark.conf.get(MAX_PARTITION_BYTES))
    lengths = [row.length for row in sizes.collect()]  # fewer rows than cores
    if sum(math.ceil(length / split) for length in lengths) >= cores:
        return df
    return df.repartition(max(cores, math.ceil(sum(lengths) / TASK_BYTES)), by)


def sorting_tasks(df: DataFrame) -> int:
    """Into how many tasks whole rows of ``df`` are dealt to be sorted: by the measured size of the rows,
    at least one a core. A shuffle given its number of tasks is not merged again by its compressed size,
    which says little about rows that are much alike."""
    size = df.agg(F.sum(F.octet_length(F.struct("*").cast("string")))).first()[0]
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil((size or 0) / SORTED_BYTES))


def _bytes(text: str) -> int:
    """Spark size text: a number with an optional k/m/g suffix, 'b' allowed behind it."""
    text = text.strip().lower().removesuffix("b")
    factor = {"k": 2**10, "m": 2**20, "g": 2**30}.get(text[-1], 1)
    return int(text[:-1] if factor > 1 else text) * factor
