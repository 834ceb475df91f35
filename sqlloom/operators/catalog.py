"""Database catalogs: normalization, DDL rendering, foreign keys, lookup.

A catalog row holds one whole database in arrays, so rendering is array work inside one row and
needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sqlloom.functions.text import quote_ident, sqlite_type
from sqlloom.operators.joins import lookup
from sqlloom.options import JoinOptions
from sqlloom.sources.spread import sorting_tasks


def normalize_catalog(raw: DataFrame) -> DataFrame:
    """One row per db_id, the last one by ``ordinal``; index/name pairs become structs.

    Spark sorts whole rows to find the last one. They are dealt out before, since a small file can hold
    many entries that one task would sort; first by both keys (the ordinal's hash), so entries of one
    database stay spread too, then the last row of each place by database.
    """
    pairs = F.transform(
        "column_names_original",
        lambda p: F.struct(
            F.get(p, F.lit(0)).cast("int").alias("table_idx"), F.get(p, F.lit(1)).alias("name")
        ),
    )
    tasks = sorting_tasks(raw)
    place = F.pmod(F.xxhash64("ordinal"), F.lit(tasks))
    last_row = F.max_by("row", F.col("row.ordinal")).alias("row")
    entries = raw.select("db_id", place.alias("ordinal"), F.struct("*").alias("row"))
    some = entries.repartition(tasks, "db_id", "ordinal").groupBy("db_id", "ordinal").agg(last_row)
    last = some.repartition(tasks, "db_id").groupBy("db_id").agg(last_row)
    return last.select("row.*").select(
        "db_id",
        F.col("table_names_original").alias("tables"),
        pairs.alias("columns"),
        F.col("column_types"),
        F.coalesce("primary_keys", F.array().cast("array<int>")).alias("primary_keys"),
        F.coalesce("foreign_keys", F.array().cast("array<array<int>>")).alias("foreign_keys"),
    )


def catalog_columns(catalog: DataFrame) -> DataFrame:
    """Flat form, one row per column; the '*' pseudo-column has table index -1."""
    flat = catalog.select(
        "db_id", "tables", "column_types", F.posexplode("columns").alias("column_idx", "column")
    )
    return flat.select(
        "db_id",
        F.col("column.table_idx").alias("table_idx"),
        F.expr("get(tables, column.table_idx)").alias("table_name"),
        "column_idx",
        F.col("column.name").alias("column_name"),
        F.expr("get(column_types, column_idx)").alias("column_type"),
    )


def foreign_keys(catalog: DataFrame) -> DataFrame:
    """Index pairs resolved to names, in listed order (``fk_idx``)."""
    pairs = catalog.select(
        "db_id", "tables", "columns", F.posexplode("foreign_keys").alias("fk_idx", "pair")
    )
    named = pairs.select(
        "db_id",
        "fk_idx",
        "tables",
        F.expr("get(columns, pair[0])").alias("source"),
        F.expr("get(columns, pair[1])").alias("target"),
    )
    return named.select(
        "db_id",
        "fk_idx",
        F.expr("get(tables, source.table_idx)").alias("source_table"),
        F.col("source.name").alias("source_column"),
        F.expr("get(tables, target.table_idx)").alias("target_table"),
        F.col("target.name").alias("target_column"),
    )


def render_ddl() -> Column:
    """CREATE TABLE text of a normalized catalog row, tables and columns in catalog order."""
    columns = F.col("columns")

    def column_at(idx: Column) -> Column:
        return F.get(columns, idx)

    def owner(idx: Column) -> Column:
        return column_at(idx)["table_idx"]

    numbered = F.transform(
        columns,
        lambda c, i: F.struct(
            i.alias("idx"),
            c["table_idx"].alias("table_idx"),
            F.concat(F.lit("  "), quote_ident(c["name"]), F.lit(" "), sqlite_type(F.get("column_types", i))).alias("line"),
        ),
    )

    def table(name: Column, t: Column) -> Column:
        keys = F.filter("primary_keys", lambda k: owner(k) == t)
        single = F.when(F.size(keys) == 1, F.get(keys, F.lit(0)))
        lines = F.transform(
            F.filter(numbered, lambda c: c["table_idx"] == t),
            lambda c: F.when(c["idx"] == single, F.concat(c["line"], F.lit(" PRIMARY KEY"))).otherwise(c["line"]),
        )
        key_names = F.array_join(F.transform(keys, lambda k: quote_ident(column_at(k)["name"])), ", ")
        key_lines = F.when(
            F.size(keys) > 1, F.array(F.concat(F.lit("  PRIMARY KEY ("), key_names, F.lit(")")))
        ).otherwise(F.array().cast("array<string>"))
        links = F.transform(
            F.filter("foreign_keys", lambda p: owner(F.get(p, F.lit(0))) == t), foreign_key
        )
        body = F.array_join(F.concat(lines, key_lines, links), ",\n")
        return F.concat(F.lit("CREATE TABLE "), quote_ident(name), F.lit(" (\n"), body, F.lit("\n);"))

    def foreign_key(pair: Column) -> Column:
        source, target = column_at(F.get(pair, F.lit(0))), column_at(F.get(pair, F.lit(1)))
        return F.concat(
            F.lit("  FOREIGN KEY ("),
            quote_ident(source["name"]),
            F.lit(") REFERENCES "),
            quote_ident(F.get("tables", target["table_idx"])),
            F.lit(" ("),
            quote_ident(target["name"]),
            F.lit(")"),
        )

    return F.array_join(F.transform("tables", table), "\n")


def rendered_schemas(catalog: DataFrame) -> DataFrame:
    """(db_id, schema_ddl), each database rendered once rather than once per example."""
    return catalog.select("db_id", render_ddl().alias("schema_ddl"))


def attach_schema(
    examples: DataFrame, schemas: DataFrame, ordinal: str, options: JoinOptions = JoinOptions()
) -> DataFrame:
    """Left lookup by db_id; ``schema_ddl`` stays null for an unknown database."""
    return lookup(examples, schemas, "db_id", ordinal, options)
