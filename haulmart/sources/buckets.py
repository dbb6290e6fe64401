"""Stored tables in buckets of one key, so that joins on it need no shuffle.

Tables with the same key type and number of buckets meet bucket by bucket. A
bucket is read by one task, so rows of a key that holds a large part of the table,
and rows without a key, are not in it: they are stored beside it as they come.
The number of buckets is part of the folder's name; any session can read it back.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmart.sources.workspace import CODEC, children, shuffles_removed

IN_BUCKETS = re.compile(r"by_(\w+)_in_(\d+)")
REST = "rest"
# A key is hot if it holds more than this part of a bucket of even size.
HOT_PART_OF_BUCKET = 0.5
# Rows that are shuffled at once; more are written some of the buckets at a time, so that the shuffle files of
# these alone are on disk.
ROWS_PER_SLICE = 32_000_000
# Fixed value: the least share that Spark's frequent items can be asked for.
LEAST_SHARE = 1e-4


def _likely_keys(df: DataFrame, key: str, buckets: int) -> list:
    """Keys that may be hot, others among them: found in one pass without a shuffle of the keys."""
    keys = df.select(F.col(key).alias("key")).where("key IS NOT NULL")
    return keys.stat.freqItems(["key"], _hot_share(buckets)).first()[0] if buckets > 1 else []


def _hot_share(buckets: int) -> float:
    return max(LEAST_SHARE, HOT_PART_OF_BUCKET / buckets)


def _counted(df: DataFrame, key: str, likely: list) -> list:
    """Rows of each likely key, of all other keys as one, and of none.

    A row is looked up among the likely keys, of which there are more with more buckets, not compared
    with one after the other.
    """
    column = F.col(key)
    named = F.when(column.isin(likely), column) if likely else F.lit(None)
    groups = df.groupBy(named.alias("key"), column.isNull().alias("none")).agg(F.count("*").alias("rows"))
    return groups.collect()  # one row per likely key and two more


def _hot_and_none(df: DataFrame, key: str, buckets: int) -> tuple[list, bool, int]:
    """The hot keys, whether there are rows without a key, and the number of rows with one."""
    groups = _counted(df, key, _likely_keys(df, key, buckets))
    rows = sum(g["rows"] for g in groups if not g["none"])
    hot = [g["key"] for g in groups if g["key"] is not None and g["rows"] > _hot_share(buckets) * rows]
    return hot, any(g["none"] for g in groups), rows


def hot_keys(df: DataFrame, key: str, buckets: int) -> list:
    """Keys with more rows than half an even bucket; at most twice as many as there are buckets."""
    return _hot_and_none(df, key, buckets)[0]


def store_in_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write ``df`` below ``path``; the rows of a bucket come from one task and are sorted by the key."""
    with shuffles_removed(df.sparkSession):
        _write_buckets(df, path, key, buckets)


def _write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    column = F.col(key)
    hot, none, rows = _hot_and_none(df, key, buckets)
    beside = column.isNull() | column.isin(hot) if hot else column.isNull()
    folder = f"{path}/by_{key}_in_{buckets}"
    name = f"buckets_{uuid.uuid4().hex}"
    even = df.where(~beside)
    # A slice has a bucket for each core at least.
    slices = max(1, min(buckets // df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_SLICE)))
    bucket = F.pmod(F.hash(column), F.lit(buckets))
    for n in range(slices):
        own = even.where(bucket % slices == n) if slices > 1 else even
        written = own.repartition(buckets, key).write.mode("append").bucketBy(buckets, key).sortBy(key)
        written.options(path=folder, compression=CODEC).format("parquet").saveAsTable(name)
    # Only the catalog's entry goes; the files stay.
    df.sparkSession.sql(f"DROP TABLE {name}")
    if hot or none:
        df.where(beside).write.parquet(f"{path}/{REST}", compression=CODEC)


def stored_parts(spark: SparkSession, path: str, schema: T.StructType) -> list[DataFrame]:
    """The table at ``path``: its buckets first, then what stands beside them; a plain table is one part."""
    folders = children(spark, path)
    found = next(((f, m) for f in folders if (m := IN_BUCKETS.fullmatch(f))), None)
    if found is None:
        return [spark.read.schema(schema).parquet(path)]
    folder, match = found
    name = f"buckets_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{match[1]}`) SORTED BY (`{match[1]}`)"
        f" INTO {match[2]} BUCKETS LOCATION '{path}/{folder}'"
    )
    parts = [spark.table(name)]
    if REST in folders:
        parts.append(spark.read.schema(schema).parquet(f"{path}/{REST}"))
    return parts
