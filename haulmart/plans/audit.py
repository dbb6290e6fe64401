"""Health audit of the stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmart.contracts import FACTS, STAGING, WAREHOUSE, Contract
from haulmart.functions.columns import decimal_average
from haulmart.operators.checks import Tables
from haulmart.operators.keys import duplicate_groups
from haulmart.operators.shape import looked_up
from haulmart.plans.gates import AUDIT_REFERENCES, reference_report

STORED = [(c.layer, c.name) for c in STAGING + WAREHOUSE]


def row_counts(tables: Tables, names: list[str]) -> DataFrame:
    """(TableName, RowCount). The count of a stored table comes from file footers."""
    return reduce(
        DataFrame.unionByName,
        [
            tables(n)
            .agg(F.count(F.lit(1)).alias("RowCount"))
            .select(F.lit(n).alias("TableName"), "RowCount")
            for n in names
        ],
    )


def layer_row_counts(tables: Tables, names: list[tuple[str, str]]) -> DataFrame:
    """(SchemaName, TableName, RowCount) ordered by schema, dimensions first."""
    schemas = looked_up("TableName", {table: schema for schema, table in names})
    name = F.col("TableName")
    return (
        row_counts(tables, [t for _, t in names])
        .select(schemas.alias("SchemaName"), "TableName", "RowCount")
        .orderBy("SchemaName", F.when(name.like("dim%"), 0).otherwise(1), "TableName")
    )


def fact_versus_clean(tables: Tables) -> DataFrame:
    """FactTable, CleanRows, DWRows, DroppedRows: rows lost in key lookups."""
    parts = []
    for c in FACTS:
        view = f"clean_{c.name.removeprefix('fact_')}"
        clean = tables(view).agg(F.count(F.lit(1)).alias("CleanRows"), F.lit(0).alias("DWRows"))
        dw = tables(c.name).agg(F.lit(0).alias("CleanRows"), F.count(F.lit(1)).alias("DWRows"))
        parts += [p.withColumn("FactTable", F.lit(c.name)) for p in (clean, dw)]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("FactTable")
        .agg(F.sum("CleanRows").alias("CleanRows"), F.sum("DWRows").alias("DWRows"))
        .withColumn("DroppedRows", F.col("CleanRows") - F.col("DWRows"))
    )


def sales_metrics(tables: Tables) -> DataFrame:
    amount = F.col("SalesAmount")
    return tables("fact_sales").agg(
        F.count(F.lit(1)).alias("TotalTransactions"),
        F.sum(amount).alias("TotalSales"),
        decimal_average(amount).alias("AvgSale"),
        F.min(amount).alias("MinSale"),
        F.max(amount).alias("MaxSale"),
    )


def duplicate_keys(df: DataFrame, c: Contract, label: str | None = None) -> DataFrame:
    """One row per duplicated key: TableName, PKColumns, DuplicateGroupCount."""
    return duplicate_groups(df, c.primary_key).select(
        F.lit(label or c.qualified_name).alias("TableName"),
        F.lit("+".join(c.primary_key)).alias("PKColumns"),
        F.col("copies").alias("DuplicateGroupCount"),
    )


def all_duplicate_keys(tables: Tables) -> DataFrame:
    """Whole keys of every stored table, so a composite key is not misjudged by its first column."""
    return reduce(
        DataFrame.unionByName, [duplicate_keys(tables(c.name), c) for c in STAGING + WAREHOUSE]
    )


def storage(tables: Tables, names: list[tuple[str, str]], paths: dict[str, str]) -> DataFrame:
    """File bytes per table in KB. Only file metadata is read, not content."""
    spark = tables(names[0][1]).sparkSession
    parts = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(paths[table])
        .agg(F.coalesce(F.sum("length"), F.lit(0)).alias("_bytes"))
        .select(
            F.lit(schema).alias("SchemaName"),
            F.lit(table).alias("TableName"),
            F.ceil(F.col("_bytes") / 1024).alias("TotalSpaceKB"),
        )
        for schema, table in names
    ]
    return reduce(DataFrame.unionByName, parts).orderBy(F.desc("TotalSpaceKB"), "TableName")


# The date by which a fact is dated; routes have none.
FACT_DATES = {
    "fact_sales": "DateKey",
    "fact_deliveries": "DeliveryDateKey",
    "fact_exceptions": "DateKey",
}


def freshness(tables: Tables) -> DataFrame:
    """TableName, LastLoad, RowCount, NewestDate (YYYYMMDD): when and what was loaded last."""
    parts = []
    for c in FACTS:
        date = FACT_DATES.get(c.name)
        newest = F.max(date) if date else F.lit(None).cast("int")
        parts.append(
            tables(c.name)
            .agg(
                F.max("load_ts").alias("LastLoad"),
                F.count(F.lit(1)).alias("RowCount"),
                newest.alias("NewestDate"),
            )
            .withColumn("TableName", F.lit(c.name))
        )
    return reduce(DataFrame.unionByName, parts).orderBy(F.desc("LastLoad"), "TableName")


def fact_sizes(tables: Tables) -> DataFrame:
    return row_counts(tables, [c.name for c in FACTS]).orderBy(F.desc("RowCount"), "TableName")


def orphans(tables: Tables) -> DataFrame:
    return (
        reference_report(tables, AUDIT_REFERENCES)
        .select(F.col("check_name").alias("CheckName"), F.col("bad_rows").alias("OrphanCount"))
        .orderBy(F.desc("OrphanCount"), "CheckName")
    )
