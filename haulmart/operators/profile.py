"""Column profiling: nulls of every column from one pass per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmart.functions.columns import count_if, decimal_average, percent_of
from haulmart.operators.checks import Tables
from haulmart.operators.shape import long_form, quoted, text_literal

# Fixed value: share of nulls above which a column is critical, in percent.
CRITICAL_PERCENT = 20


def column_nulls(df: DataFrame, schema_name: str, table: str) -> DataFrame:
    """SchemaName, TableName, ColumnName, NullCount, TotalRows."""
    columns = df.columns
    totals = df.agg(
        F.expr("count(1) AS _total"),
        *[F.expr(f"count_if({quoted(c)} IS NULL) AS {quoted(c)}") for c in columns],
    )
    return long_form(totals, columns, "ColumnName", "NullCount", keep=["_total"]).selectExpr(
        f"{text_literal(schema_name)} AS SchemaName",
        f"{text_literal(table)} AS TableName",
        "ColumnName",
        "NullCount",
        "_total AS TotalRows",
    )


def null_profile(tables: Tables, names: list[tuple[str, str]]) -> DataFrame:
    """The same with NullPct, over many tables given as (schema, table)."""
    counts = reduce(DataFrame.union, [column_nulls(tables(t), schema, t) for schema, t in names])
    return counts.withColumn("NullPct", percent_of(F.col("NullCount"), F.col("TotalRows")))


def with_nulls(profile: DataFrame) -> DataFrame:
    return profile.filter(F.col("NullCount") > 0)


def critical(profile: DataFrame) -> DataFrame:
    return profile.filter(F.col("NullPct") > CRITICAL_PERCENT)


def most_null_first(profile: DataFrame) -> DataFrame:
    return profile.orderBy(F.desc("NullPct"), "SchemaName", "TableName", "ColumnName")


def scorecard(profile: DataFrame) -> DataFrame:
    return (
        profile.groupBy("SchemaName", "TableName")
        .agg(
            F.count(F.lit(1)).alias("ColumnsChecked"),
            count_if(F.col("NullPct") > 0).alias("ColumnsWithNulls"),
            decimal_average(F.col("NullPct")).alias("AvgNullPct"),
            F.max("NullPct").alias("MaxNullPct"),
        )
        .orderBy(F.desc("AvgNullPct"), "SchemaName", "TableName")
    )
