"""Readers. Every schema is declared; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sqlloom.sources.quarantine import MalformedPolicy, read_json_checked


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# The sources' column names.
CORPUS = _strings(
    "domain",
    "domain_description",
    "sql_complexity",
    "sql_complexity_description",
    "sql_task_type",
    "sql_task_type_description",
    "sql_prompt",
    "sql_context",
    "sql",
    "sql_explanation",
)
EXAMPLES = _strings("db_id", "question", "query")
BLOCKLIST = _strings("question", "prompt", "sql", "query")
MESSAGES = T.ArrayType(_strings("role", "content"))

# The index/name pairs mix numbers and strings, so both are read as text and cast later.
CATALOG = T.StructType(
    [
        T.StructField("db_id", T.StringType()),
        T.StructField("table_names_original", T.ArrayType(T.StringType())),
        T.StructField("column_names_original", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("column_types", T.ArrayType(T.StringType())),
        T.StructField("primary_keys", T.ArrayType(T.IntegerType())),
        T.StructField("foreign_keys", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ]
)


def with_ordinal(schema: T.StructType) -> T.StructType:
    """The schema plus a stored ordinal, for tables written with one."""
    return T.StructType([T.StructField("example_id", T.LongType()), *schema.fields])


def add_file_ordinal(df: DataFrame, name: str = "example_id") -> DataFrame:
    """Sortable text ordinal for a Parquet source without a key: file and row position, both
    stable between runs."""
    row = F.lpad(F.col("_metadata.row_index").cast("string"), 20, "0")
    return df.withColumn(name, F.concat(F.col("_metadata.file_path"), F.lit("#"), row))


def read_dataset(
    spark: SparkSession,
    path: str,
    split: str = "train",
    schema: T.StructType = CORPUS,
    fmt: str = "parquet",
) -> DataFrame:
    """One split of a dataset laid out as split=<name> folders; only that folder is read."""
    whole = T.StructType([*schema.fields, T.StructField("split", T.StringType())])
    df = spark.read.schema(whole).format(fmt).load(path)
    return df.where(F.col("split") == split).drop("split")


def read_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """A file holding one JSON array. Such a file cannot be cut, so each is one task; large
    sources should come as JSON lines or Parquet."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_examples(spark: SparkSession, path: str, lines: bool = False, policy: MalformedPolicy | None = None) -> DataFrame:
    """With a policy, malformed records are counted, set aside and fatal past its share."""
    if policy is not None:
        return read_json_checked(spark, path, EXAMPLES, lines, policy).good
    reader = read_json_lines if lines else read_json_array
    return reader(spark, path, EXAMPLES)


def read_catalog(spark: SparkSession, paths: str | list[str], lines: bool = False) -> DataFrame:
    """Raw catalog objects with their place in the source as ``ordinal``: files by path, then the
    block of the file, then the row in the task that reads the block. Which files Spark puts into
    one task has no say in it."""
    reader = read_json_lines if lines else read_json_array
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return reader(spark, paths, CATALOG).withColumn("ordinal", place)


def read_blocklist(spark: SparkSession, path: str | None, lines: bool = False, policy: MalformedPolicy | None = None) -> DataFrame:
    """With a policy, a broken line is counted and set aside (or fatal), never a row of nulls."""
    if not path:
        return spark.createDataFrame([], BLOCKLIST)
    if policy is not None:
        return read_json_checked(spark, path, BLOCKLIST, lines, policy).good
    reader = read_json_lines if lines else read_json_array
    return reader(spark, path, BLOCKLIST)


def load_splits(
    train: DataFrame, validation: DataFrame | None, ordinal: str, fallback: int = 8
) -> tuple[DataFrame, DataFrame]:
    """Train and evaluation tables. Without a validation table the first rows of train stand in."""
    if validation is not None:
        return train, validation
    return train, train.orderBy(ordinal).limit(fallback)




def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the path's own file system, so it may be any that Spark can read."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(name.getFileSystem(spark._jsc.hadoopConfiguration()).exists(name))


def load_split_files(
    spark: SparkSession,
    train: str,
    validation: str | None,
    schema: T.StructType,
    ordinal: str = "example_id",
    fallback: int = 8,
) -> tuple[DataFrame, DataFrame]:
    """Train and evaluation tables from JSON lines. The validation file counts only if it exists;
    without it the first rows of train stand in."""
    there = validation is not None and path_exists(spark, validation)
    table = read_json_lines(spark, validation, schema) if there else None
    return load_splits(read_json_lines(spark, train, schema), table, ordinal, fallback)
