"""Helpers for frames: bounded Arrow batches, working tables, global order by id."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmart.sources.workspace import Workspace, remove

BATCH_BYTES = 32 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch, unless the session has its own bound or knows none."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        current = int(spark.conf.get(key).rstrip("bB"))
    except Exception:  # an older Spark without the setting: the record bound holds
        return
    if current > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


class Tables(Workspace):
    """Working tables of one operator; a table goes after its last reader."""

    def __init__(self, spark: SparkSession):
        super().__init__(spark)
        self.paths: dict[str, list[str]] = {}

    def store(self, df: DataFrame, name: str) -> str:
        path = super().store(df, name)
        self.paths.setdefault(name, []).append(path)
        return path

    def drop(self, *names: str) -> None:
        """Remove all tables stored under these names; what reads them must have been written."""
        for name in names:
            for path in self.paths.pop(name, []):
                remove(self.spark, path)


def workspace(df: DataFrame) -> Tables:
    return Tables(df.sparkSession)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    mark = "_"
    while any(f"{mark}{name}" in taken for name in names):
        mark += "_"
    return [f"{mark}{name}" for name in names]


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """The columns an operator reads, under fixed names; a null text is an empty one."""
    bounded_batches(docs.sparkSession)
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
        *[docs[name] for name in more],
    )


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_buckets(docs: DataFrame, column: str = "doc_id", per_partition: int = 2) -> tuple[Bucketizer | None, int]:
    """Cuts of the ids into about even, ordered ranges; reads the id column only."""
    n = per_partition * partitions(docs.sparkSession)
    quantiles = [k / n for k in range(1, n)]
    cuts = docs.agg(F.percentile_approx(column, quantiles, 10 * n).alias("cuts")).first().cuts if n > 1 else None
    inner = sorted({float(c) for c in cuts or []})
    if not inner:
        return None, 1
    splits = [float("-inf"), *inner, float("inf")]
    return Bucketizer(splits=splits, inputCol="_id", outputCol="_bucket", handleInvalid="keep"), len(inner) + 1


def with_bucket(df: DataFrame, buckets: Bucketizer | None, column: str = "doc_id") -> DataFrame:
    """Adds ``bucket``: rows of lower ids have lower buckets; null ids come first, in bucket -1."""
    if buckets is None:
        return df.withColumn("bucket", F.when(F.col(column).isNull(), -1).otherwise(0))
    cut = buckets.transform(df.withColumn("_id", F.col(column).cast("double")))
    number = F.when(F.col(column).isNull(), -1).otherwise(F.col("_bucket").cast("int"))
    return cut.withColumn("bucket", number).drop("_id", "_bucket")


def digest(column: Column | str) -> Column:
    return F.sha2(column, 256)
