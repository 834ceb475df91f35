"""Written intermediate tables: lineage ends at files every executor can read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# The folder of the run that is going on in this context, if any.
_run: ContextVar[str | None] = ContextVar("run", default=None)
_private_roots: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints. A private folder is made only where none
    is named and the session is a local one."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a shared folder on a cluster")
    if not _private_roots:
        _private_roots.append(tempfile.mkdtemp(prefix="sqlloom-"))
    return _private_roots[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_run.get() or scratch_root(spark) + '/sqlloom'}/{label}-{uuid.uuid4().hex}"


@contextmanager
def run_scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """Tables written inside go to a folder of this run, which is deleted at the end, whether or not
    the run succeeds. What is handed out must not read them. Other runs' tables are left alone."""
    path = scratch_path(spark, label)
    token = _run.set(path)
    try:
        yield path
    finally:
        _run.reset(token)
        delete_path(spark, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once as Parquet and go on from the files: a lost executor costs a re-read, and
    later passes read only the columns they need."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class RunScratch:
    """Tables of one run, in a folder of its own below the scratch root.

    ``write`` ends lineage at files every executor can read; ``drop`` deletes one table once
    nothing reads it any more, ``close`` all of them. Tables of other runs are never touched.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = scratch_path(spark, label)

    def table(self, label: str) -> str:
        return f"{self.path}/{label}"

    def write(self, df: DataFrame, label: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(self.table(label))
        return self.read(df, label)

    def read(self, df: DataFrame, label: str) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(self.table(label))

    def drop(self, *labels: str) -> None:
        for label in labels:
            delete_path(self.spark, self.table(label))

    def close(self) -> None:
        delete_path(self.spark, self.path)


def delete_path(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
