"""Primary-key operators: duplicates, first row per key, surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmart.functions.columns import match_key
from haulmart.sources.workspace import Workspace

# Bytes up to which a measured table is broadcast.
BROADCAST_BYTES = 64 << 20
# Bits of the map of clashing keys: a million words at most, which is within the bytes above.
MAP_BITS = 26
# Bits of a key's hash: fewer are fewer bytes to shuffle; keys that share a hash by chance only cost a second look.
HASH_BITS = 40
# Dimension values numbered by one task; beyond it the numbering is ranged.
VALUES_PER_TASK = 1_000_000


def key_columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Key expressions as the key constraint compares them."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [
        (match_key(F.col(k)) if isinstance(types[k], T.StringType) else F.col(k)).alias(f"_key_{k}")
        for k in keys
    ]


def estimated_bytes(df: DataFrame) -> int:
    """Size of a stored table in memory: 16 bytes a cell and the bytes of its texts, measured."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = 16 * len(df.columns) + 16
    length = F.lit(fixed)
    for name in texts:
        length = length + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    return df.agg(F.sum(length.cast("long")).alias("n")).first().n or 0


def _hashed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with its key columns and a hash of them."""
    hashed = F.xxhash64(*[f"_key_{k}" for k in keys]).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    return df.select("*", *key_columns(df, keys)).withColumn("_hash", hashed)


def _place() -> tuple[str, str]:
    """Word and bit of a hash in the map of clashing keys."""
    return f"shiftright(_hash & {(1 << MAP_BITS) - 1}L, 6)", "shiftleft(1L, CAST(_hash & 63 AS INT))"


def clash_words(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_word, _bits): a map of the keys held by more than one row, small whatever their number.

    The rows are counted by a hash of the key, so that is all that is shuffled. A
    key that is held once may be on the map by chance, one held twice always is.
    """
    counted = _hashed(df, keys).groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows"))
    clashing = counted.filter(F.col("_rows") > 1)
    word, bit = _place()
    return clashing.groupBy(F.expr(word).alias("_word")).agg(F.expr(f"bit_or({bit})").alias("_bits"))


def _on_map(hashed: DataFrame, words: DataFrame, how: str) -> DataFrame:
    """Rows whose key is on the map, or is not."""
    word, bit = _place()
    return hashed.join(F.broadcast(words), F.expr(f"{word} = _word AND _bits & {bit} != 0"), how)


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key held by more than one row, with the number of rows.

    A first look shuffles hashes of the keys alone, a second one the keys that the
    first has on its map. Counts are combined map-side, so a key held by a large
    part of the rows reaches the shuffle as one row per task.
    """
    key_names = [f"_key_{k}" for k in keys]
    contested = _on_map(_hashed(df, keys), clash_words(df, keys), "left_semi")
    return contested.groupBy(*key_names).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


@dataclass(frozen=True)
class KeySplit:
    kept: DataFrame
    # Rejected rows; equal rows are folded into one with their number in "copies".
    rejected: DataFrame


def split_by_key(
    df: DataFrame,
    keys: Sequence[str],
    workspace: Workspace,
    broadcast_limit: int = BROADCAST_BYTES,
) -> KeySplit:
    """Keep the first row of every key (in the order of all columns).

    Duplicate keys are an error case and mostly few: they are found with a
    shuffle of key hashes alone and put on a map of bounded size. While that is
    small enough to broadcast, only the rows whose key is on it are shuffled;
    else every row takes part. Either way equal rows are folded first by
    a hash aggregate, combined map-side, and stored; winners and rejected rows
    both come from that table, which holds distinct rows only, so a key on a
    third of the rows is as long as its number of different rows.
    """
    columns = df.columns
    key_names = [f"_key_{k}" for k in keys]
    clashes = workspace.materialize(clash_words(df, keys), "duplicate_keys")
    keyed = _hashed(df, keys)
    clashing = clashes.count()
    if clashing == 0:
        return KeySplit(df, df.withColumn("copies", F.lit(0).cast("long")).filter(F.lit(False)))
    if estimated_bytes(clashes) <= broadcast_limit:
        contested = _on_map(keyed, clashes, "left_semi")
        untouched = _on_map(keyed, clashes, "left_anti").select(*columns)
    else:
        contested = keyed
        untouched = None

    folded = workspace.materialize(
        contested.groupBy(*columns, *key_names).agg(F.count(F.lit(1)).alias("copies")), "folded_rows"
    )
    first = folded.groupBy(*key_names).agg(F.min(F.struct(*columns)).alias("row"))
    winners = first.select("row.*")
    kept = winners if untouched is None else untouched.unionByName(winners)

    # The winner of each key is taken off by addition: no join on the key.
    tally = folded.select(*columns, "copies").unionByName(
        winners.select(*columns, F.lit(-1).cast("long").alias("copies"))
    )
    rejected = (
        tally.groupBy(*columns).agg(F.sum("copies").alias("copies")).filter(F.col("copies") > 0)
    )
    return KeySplit(kept, rejected)


def assign_surrogate_key(
    values: DataFrame,
    order_by: str,
    key: str,
    workspace: Workspace,
    values_per_task: int = VALUES_PER_TASK,
) -> DataFrame:
    """Number distinct values 1..n in the order of ``order_by``.

    ``values`` must be distinct. They are written once, so the count that
    picks the strategy and the numbering see the same rows. Few values are
    numbered by one task; many are range-partitioned, numbered per range and
    shifted by the total of the ranges before it.
    """
    stored = workspace.materialize(values, f"values_{key}")
    total = stored.count()
    if total <= values_per_task:
        number = F.row_number().over(Window.orderBy(order_by)).cast("long")
        return stored.select(number.alias(key), *stored.columns)

    ranges = -(-total // values_per_task)
    ranged = workspace.materialize(
        stored.repartitionByRange(ranges, order_by).withColumn("_range", F.spark_partition_id()),
        f"ranges_{key}",
    )
    # One row per range: a handful even for billions of values.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy("_range").orderBy(order_by))
    return ranged.join(F.broadcast(offsets), "_range").select(
        (F.col("_offset") + within).alias(key), *stored.columns
    )
