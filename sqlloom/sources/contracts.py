"""Source contract: which columns must be there, and of which type."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# The source's column names.
REQUIRED_COLUMNS = (
    "domain",
    "domain_description",
    "sql_complexity",
    "sql_task_type",
    "sql_prompt",
    "sql_context",
    "sql",
    "sql_explanation",
)


def require_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS) -> DataFrame:
    """Fail before any job runs. Extra columns are fine."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"The source lacks required columns: {missing}")
    wrong = sorted(
        f.name
        for f in df.schema.fields
        if f.name in required and not isinstance(f.dataType, T.StringType)
    )
    if wrong:
        raise ValueError(f"Required columns have another type than string: {wrong}")
    return df


def contract_report(df: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS) -> DataFrame:
    """(name, present, non_null_rows) per required column, counted in one pass."""
    counts = [
        F.struct(
            F.lit(name).alias("name"),
            F.lit(name in df.columns).alias("present"),
            (F.count(name) if name in df.columns else F.lit(0).cast("bigint")).alias(
                "non_null_rows"
            ),
        )
        for name in sorted(required)
    ]
    return df.agg(F.array(*counts).alias("report")).selectExpr("inline(report)")
