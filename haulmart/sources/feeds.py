"""CSV feeds: typed staging rows plus a reject table that explains the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmart.contracts import Contract
from haulmart.operators.keys import split_by_key
from haulmart.sources.workspace import Workspace

CORRUPT = "_corrupt"
REASON = "reject_reason"
COPIES = "copies"

REJECT_SCHEMA = "table_name string, record string, reject_reason string, copies bigint"

# The text forms a bit column accepts.
TRUE_TEXT = ("1", "true")
FALSE_TEXT = ("0", "false")

MODES = ("strict", "quarantine")


class RejectedRows(Exception):
    """Raised in strict mode when a feed holds rows that break its contract."""

    def __init__(self, counts: dict[tuple[str, str], int]):
        self.counts = counts
        listing = ", ".join(f"{t}: {n} {r}" for (t, r), n in sorted(counts.items()))
        super().__init__(f"rejected rows ({listing})")


@dataclass(frozen=True)
class Ingested:
    contract: Contract
    good: DataFrame
    rejects: DataFrame


def read_feed(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """Raw text columns by position; rows with a wrong field count are marked.

    The header is skipped, not interpreted, and quotes have no special meaning.
    """
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in contract.column_names]
        + [T.StructField(CORRUPT, T.StringType())]
    )
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("encoding", "UTF-8")
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def _typed(contract: Contract, column: str) -> Column:
    raw = F.col(column)
    target = contract.spark_type(column)
    if isinstance(target, T.BooleanType):
        text = F.lower(F.trim(raw))
        return F.when(text.isin(*TRUE_TEXT), F.lit(True)).when(
            text.isin(*FALSE_TEXT), F.lit(False)
        )
    if isinstance(target, T.StringType):
        return raw
    return raw.try_cast(target)


def _reason(contract: Contract) -> Column:
    unreadable = F.lit(False)
    too_long = F.lit(False)
    missing = F.lit(False)
    for f in contract.fields:
        raw = F.col(f.name)
        if f.max_length:
            too_long = too_long | (F.length(raw) > f.max_length)
        elif f.base_type not in ("nvarchar", "varchar"):
            unreadable = unreadable | (raw.isNotNull() & _typed(contract, f.name).isNull())
        if not f.nullable:
            missing = missing | raw.isNull()
    return (
        F.when(F.col(CORRUPT).isNotNull(), "malformed_row")
        .when(unreadable, "unreadable_value")
        .when(too_long, "too_long")
        .when(missing, "missing_value")
    )


def judge_rows(raw: DataFrame, contract: Contract) -> DataFrame:
    """Raw columns plus the first broken rule of each row, if any."""
    return raw.withColumn(REASON, _reason(contract))


def typed_rows(judged: DataFrame, contract: Contract) -> DataFrame:
    accepted = judged.filter(F.col(REASON).isNull())
    return accepted.select(*[_typed(contract, c).alias(c) for c in contract.column_names])


def reject_table(rows: DataFrame, contract: Contract, reason: Column, copies: Column) -> DataFrame:
    return rows.select(
        F.lit(contract.name).alias("table_name"),
        F.to_json(F.struct(*contract.column_names)).alias("record"),
        reason.alias(REASON),
        copies.cast("long").alias(COPIES),
    )


def ingest(
    spark: SparkSession, path: str, contract: Contract, workspace: Workspace
) -> Ingested:
    """Load one feed. Every input row is in ``good`` or counted in ``rejects``.

    The parsed text is landed once as Parquet, since the key check and both
    results read it again and CSV parsing is the dearest part.
    """
    landed = workspace.materialize(
        judge_rows(read_feed(spark, path, contract), contract), f"landed_{contract.name}"
    )
    typed = typed_rows(landed, contract)
    split = split_by_key(typed, contract.primary_key, workspace)
    broken = landed.filter(F.col(REASON).isNotNull())
    rejects = reject_table(broken, contract, F.col(REASON), F.lit(1)).unionByName(
        reject_table(split.rejected, contract, F.lit("duplicate_key"), F.col(COPIES))
    )
    return Ingested(contract, split.kept, rejects)


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("table_name", REASON).agg(F.sum(COPIES).alias("rejected_rows"))


def require_no_rejects(rejects: DataFrame) -> None:
    """Strict mode: one bad row aborts the load."""
    rows = reject_counts(rejects).collect()  # one row per table and reason
    if rows:
        raise RejectedRows({(r["table_name"], r[REASON]): r["rejected_rows"] for r in rows})
