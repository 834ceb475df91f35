"""Writers and their read-back counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

SPLITS = ("train", "val", "test")


def _json_writer(df: DataFrame) -> DataFrameWriter:
    return (
        df.write.mode("errorifexists")
        .option("ignoreNullFields", False)
        .option("writeNonAsciiCharacterAsCodePoint", True)
    )


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object per line; null keys are kept, characters outside ASCII are escaped."""
    _json_writer(df).json(path)


def write_splits(df: DataFrame, path: str) -> None:
    """The whole curated table in one write, one split=<name> folder per non-empty split."""
    _json_writer(df).partitionBy("split").json(path)


def read_splits(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    fields = [f for f in schema.fields if f.name != "split"]
    whole = T.StructType([*fields, T.StructField("split", T.StringType())])
    return spark.read.schema(whole).json(path)


def read_split(spark: SparkSession, path: str, schema: T.StructType, split: str) -> DataFrame:
    """One split; empty when its folder was never written."""
    if split not in SPLITS:
        raise ValueError(f"Unknown split {split!r}")
    return read_splits(spark, path, schema).where(F.col("split") == split).drop("split")


def write_summary(summary: DataFrame, path: str) -> None:
    """(section, metric, value, text) rows."""
    _json_writer(summary).json(path)
