"""Metadata catalog built from the contracts and the schemas of the views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmart.contracts import FACTS, LAYERS, STAGING, WAREHOUSE, Contract
from haulmart.operators.shape import literal_rows

COLUMNS = (
    "SchemaName string, ObjectType string, TableName string, ColumnOrder int, ColumnName string, "
    "DataType string, MaxLength int, NumericPrecision int, NumericScale int, IsNullable string, "
    "DefaultValue string"
)
FOREIGN_KEYS = (
    "SchemaName string, FactTable string, FKColumn string, ReferencedSchema string, "
    "ReferencedTable string, ReferencedColumn string, ConstraintName string, OnDelete string"
)
BASE_TABLES: tuple[Contract, ...] = STAGING + WAREHOUSE

# Precision of the integer types.
INTEGER_PRECISION = {"int": 10, "bigint": 19}


def _table_columns(c: Contract) -> list[tuple]:
    rows = []
    for order, f in enumerate(c.fields, 1):
        precision, scale = None, None
        if f.base_type == "decimal":
            precision, scale = f.arguments
        elif f.base_type in INTEGER_PRECISION:
            precision, scale = INTEGER_PRECISION[f.base_type], 0
        rows.append(
            (
                c.layer,
                "BASE TABLE",
                c.name,
                order,
                f.name,
                f.base_type,
                f.max_length,
                precision,
                scale,
                "YES" if f.nullable else "NO",
                f.default,
            )
        )
    return rows


def _view_columns(layer: str, view: str, schema: T.StructType) -> list[tuple]:
    rows = []
    for order, f in enumerate(schema.fields, 1):
        decimal = isinstance(f.dataType, T.DecimalType)
        rows.append(
            (
                layer,
                "VIEW",
                view,
                order,
                f.name,
                "decimal" if decimal else f.dataType.simpleString(),
                None,
                f.dataType.precision if decimal else None,
                f.dataType.scale if decimal else None,
                "YES" if f.nullable else "NO",
                None,
            )
        )
    return rows


def column_catalog(
    spark: SparkSession, views: Mapping[str, tuple[str, T.StructType]] | None = None
) -> DataFrame:
    """Every column of every table and view; ``views`` maps a view to its layer and schema."""
    rows = [row for c in BASE_TABLES for row in _table_columns(c)]
    for view, (layer, schema) in (views or {}).items():
        rows += _view_columns(layer, view, schema)
    return literal_rows(spark, rows, COLUMNS).orderBy("SchemaName", "TableName", "ColumnOrder")


def primary_key_catalog(spark: SparkSession) -> DataFrame:
    keys = [
        (c.layer, c.name, column, position, f"PK_{c.name}")
        for c in BASE_TABLES
        for position, column in enumerate(c.primary_key, 1)
    ]
    schema = (
        "SchemaName string, TableName string, ColumnName string, KeyPosition int, "
        "PKConstraintName string"
    )
    columns = column_catalog(spark).select(
        "SchemaName", "TableName", "ColumnName", "DataType", "ColumnOrder"
    )
    on = ["SchemaName", "TableName", "ColumnName"]
    return (
        columns.join(literal_rows(spark, keys, schema), on)
        .orderBy("SchemaName", "TableName", "KeyPosition")
        .select(*on, "DataType", "ColumnOrder", "PKConstraintName")
    )


def foreign_key_catalog(spark: SparkSession) -> DataFrame:
    rows = [
        (
            c.layer,
            c.name,
            fk.column,
            "dw",
            fk.ref_table,
            fk.ref_column,
            f"FK_{c.name}_{fk.label}",
            "NO ACTION",
        )
        for c in FACTS
        for fk in c.foreign_keys
    ]
    return literal_rows(spark, rows, FOREIGN_KEYS).orderBy("SchemaName", "FactTable", "FKColumn")


def column_descriptions(spark: SparkSession) -> DataFrame:
    rows = [
        (c.layer, c.name, f.name, f.comment, order)
        for c in BASE_TABLES
        for order, f in enumerate(c.fields, 1)
        if f.comment
    ]
    schema = (
        "SchemaName string, TableName string, ColumnName string, Description string, "
        "ColumnOrder int"
    )
    return (
        literal_rows(spark, rows, schema)
        .orderBy("SchemaName", "TableName", "ColumnOrder")
        .drop("ColumnOrder")
    )


def layer_summary(columns: DataFrame, layers: Sequence[str] = LAYERS) -> DataFrame:
    """SchemaName, TableCount, ViewCount per layer, in load order; empty layers stay."""
    spark = columns.sparkSession
    listed = literal_rows(spark, list(enumerate(layers, 1)), "position int, SchemaName string")
    objects = columns.select("SchemaName", "TableName", "ObjectType").distinct()
    return (
        listed.join(objects, "SchemaName", "left")
        .groupBy("position", "SchemaName")
        .agg(
            F.count_if(F.col("ObjectType") == "BASE TABLE").alias("TableCount"),
            F.count_if(F.col("ObjectType") == "VIEW").alias("ViewCount"),
        )
        .orderBy("position")
        .drop("position")
    )
