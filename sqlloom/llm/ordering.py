"""Positions in a total order without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sqlloom.llm.common import arrow_batch
from sqlloom.sources.scratch import RunScratch

PLACED = pa.schema([("row", pa.int64()), ("part", pa.int32()), ("n", pa.int64()), ("local", pa.int64())])


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of ``n`` in front of each row of this sorted range."""
    done, part = 0, TaskContext.get().partitionId()
    for batch in batches:
        n = np.asarray(batch.column("n"), np.int64)
        ends = np.cumsum(n) + done
        yield arrow_batch(PLACED, row=batch.column("row"), part=np.full(len(n), part, np.int32), n=n, local=ends - n)
        done = int(ends[-1]) if len(n) else done


def sums_in_front(rows: DataFrame, order: list[str], scratch: RunScratch, label: str) -> DataFrame:
    """(row, at): the sum of ``n`` over all rows in front, by ``order``; the order must be total.

    Rows are dealt by ranges of the order, so equal leading columns spread over many tasks.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("row", "n")
    placed = scratch.write(sorted_rows.mapInArrow(_running, "row long, part int, n long, local long"), label)
    # As many rows as ranges: their running sums are a window in one task.
    sums = placed.groupBy("part").agg(F.sum("n").alias("total"))
    bases = sums.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    return placed.join(bases, "part").select("row", (F.col("base") + F.col("local")).alias("at"))
