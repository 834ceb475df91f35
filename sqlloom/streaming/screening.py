"""The row rules on a stream of JSON files.

Everything up to schema presence looks at one row, so the batch expressions run unchanged on an
unbounded table and keep no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sqlloom.options import CurateOptions
from sqlloom.plans.jobs import screen
from sqlloom.sources.readers import CORPUS, with_ordinal


def screened_stream(
    spark: SparkSession, path: str, options: CurateOptions = CurateOptions()
) -> DataFrame:
    """Rows of JSON files as they arrive, with drop_reason; they must carry example_id."""
    return screen(spark.readStream.schema(with_ordinal(CORPUS)).json(path), options)


def write_screened(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet, exactly once, until the files now present are done."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
