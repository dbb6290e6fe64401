"""Referential integrity: rows whose parent is missing."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmart.operators.shape import long_form, quoted, text_literal


Parts = DataFrame | Sequence[DataFrame]


def _parts(table: Parts) -> list[DataFrame]:
    return [table] if isinstance(table, DataFrame) else list(table)


def _without_parent(child: DataFrame, column: str, parent: Parts, parent_column: str, few: bool) -> DataFrame:
    """Rows of one part of a child without a parent row.

    Buckets are merged as they are with the parent's buckets; the parent's rows
    beside them have no key or one of a few. A part of few references is not
    joined with the parent: the parent's keys among them are looked out first.
    """
    keys = [p.select(F.col(parent_column).alias("_key")) for p in _parts(parent)]
    if few:
        wanted = F.broadcast(child.select(F.col(column).alias("_wanted")).distinct())
        keys = [k.join(wanted, F.col("_key") == F.col("_wanted"), "left_semi") for k in keys]
    hints = ["broadcast" if few or nth else "merge" for nth in range(len(keys))]
    for known, hint in zip(keys, hints):
        known = known.distinct() if hint == "broadcast" else known
        child = child.join(known.hint(hint), F.col(column) == F.col("_key"), "left_anti")
    return child


def orphan_rows(child: Parts, parent: Parts, column: str) -> DataFrame:
    """Child rows without a parent row; a null reference has no parent.

    Either table may be given as the parts it is stored in: buckets of the
    reference, equal in number, and rows beside them. Buckets meet without a
    shuffle. The rows beside the child's buckets are those of a few hot references,
    or of none; these are looked for in the parent, not the parent for them.
    """
    return reduce(
        DataFrame.unionByName,
        [_without_parent(part, column, parent, column, nth > 0) for nth, part in enumerate(_parts(child))],
    )


def orphan_count(child: Parts, child_column: str, parent: Parts, parent_column: str) -> DataFrame:
    """One row ``bad_rows``: number of child rows without a parent; parts as in ``orphan_rows``.

    The references are counted before the join. A parent that is named by a
    third of all child rows is then one row per task in the shuffle, if there is
    one, and the join runs on distinct keys.
    """
    missing = []
    for nth, part in enumerate(_parts(child)):
        references = part.groupBy(F.col(child_column).alias("_ref")).agg(F.count(F.lit(1)).alias("_rows"))
        missing.append(_without_parent(references, "_ref", parent, parent_column, nth > 0))
    rows = reduce(DataFrame.unionByName, missing)
    return rows.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("bad_rows"))


# Bits of a hash that are summed at once; sums of that many rows and more fit into 64 bits.
SUMMED_BITS = 20


def rows_apart(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """One row ``bad_rows``: by how many rows two frames with the same columns differ, key by key.

    A key lost on one side and another one doubled count two. Both sides are read
    once for their number of rows and sums of a 60-bit hash, which equal frames have
    in common; keys are shuffled and counted only if those differ.
    """
    signed = ours.withColumn("_side", F.lit(1)).unionByName(theirs.withColumn("_side", F.lit(-1)))
    names = ours.columns
    mask = (1 << SUMMED_BITS) - 1
    hashed = signed.withColumn("_hash", F.xxhash64(*names))
    parts = [F.sum(F.expr(f"_side * (shiftright(_hash, {k * SUMMED_BITS}) & {mask}L)")).alias(f"_sum{k}") for k in range(3)]
    totals = hashed.agg(F.sum("_side").alias("_rows"), *parts)
    differ = totals.where(F.expr("_rows != 0 OR _sum0 != 0 OR _sum1 != 0 OR _sum2 != 0")).select(F.lit(1).alias("_differ"))
    # One row or none: without it the second look is dropped at run time.
    looked = signed.join(F.broadcast(differ), F.abs("_side") == F.col("_differ"))
    kept = looked.groupBy(*names).agg(F.sum("_side").alias("_rows"))
    return kept.agg(F.coalesce(F.sum(F.abs("_rows")), F.lit(0)).alias("bad_rows"))


# Keys of one word of a bitmap.
WORD_BITS = 64


@dataclass(frozen=True)
class Reference:
    """A foreign key to check; ``label`` names it in the result."""

    label: str
    fact: str
    column: str
    ref_table: str
    ref_column: str


def key_words(pairs: DataFrame) -> DataFrame:
    """(_name, _word, _bits, _rows): the keys ``_ref`` of each name as words of a bitmap, and the rows of each word.

    Surrogate keys are dense, so a word stands for up to 64 of them, in a map-side
    hash aggregate as in the shuffle. (Spark's own ``bitmap_construct_agg`` sorts
    its input.) A key far outside the range is a word of its own.
    """
    bit = f"shiftleft(1L, CAST(_ref & {WORD_BITS - 1} AS INT))"
    return pairs.groupBy("_name", F.expr("shiftright(_ref, 6)").alias("_word")).agg(
        F.expr(f"bit_or({bit})").alias("_bits"), F.count(F.lit(1)).alias("_rows")
    )


def reference_orphans(
    references: Sequence[Reference], tables: Callable[[str], DataFrame], few: bool = False
) -> DataFrame:
    """(fact_column, bad_rows) by label for any foreign keys of any facts.

    Each fact is read once: its reference columns are turned into (label, key)
    pairs and these into bitmaps, held word by word against those of the
    dimensions' keys. Rows of a word that no dimension has are all orphans, as are
    rows without a key. Only where a word lacks some keys are the rows of those
    keys counted, by a second look at the facts that finds nothing to do, and isn't
    taken, in a sound load. ``few`` says that the dimensions are measured and small
    enough to broadcast; there are no more words than keys.
    """
    labels = [r.label for r in references]
    parts = []
    for fact in dict.fromkeys(r.fact for r in references):
        own = [r for r in references if r.fact == fact]
        whole = tables(fact).selectExpr(*[f"CAST({quoted(r.column)} AS BIGINT) AS {quoted(r.label)}" for r in own])
        parts.append(long_form(whole, [quoted(r.label) for r in own], "_name", "_ref"))
    pairs = reduce(DataFrame.unionByName, parts)
    known = reduce(
        DataFrame.unionByName,
        [
            tables(table).selectExpr(f"{text_literal(table)} AS _name", f"CAST({quoted(column)} AS BIGINT) AS _ref")
            for table, column in dict.fromkeys((r.ref_table, r.ref_column) for r in references)
        ],
    )
    # The words of a dimension go out under the label of every reference to it.
    asking = ", ".join(
        f"{text_literal(table)}, array({', '.join(text_literal(r.label) for r in references if r.ref_table == table)})"
        for table in dict.fromkeys(r.ref_table for r in references)
    )
    held = key_words(known.where("_ref IS NOT NULL")).select(
        F.explode(F.expr(f"map({asking})[_name]")).alias("_of"), F.col("_word").alias("_held"), F.col("_bits").alias("_known")
    )
    words = key_words(pairs).join(held, F.expr("_name = _of AND _word = _held"), "left")
    # Both look at bits and rows, so that they read one and the same shuffle.
    lost = words.where("_known IS NULL AND (_bits IS NULL OR _bits != 0)").select("_name", "_rows")
    partly = words.where("_bits & ~_known != 0 AND _rows > 0").select(
        F.col("_name").alias("_label"), F.col("_word").alias("_lacking"), F.expr("_bits & ~_known").alias("_missing")
    )
    if few:
        partly = F.broadcast(partly)
    missing = pairs.join(
        partly,
        F.expr(
            "_name = _label AND shiftright(_ref, 6) = _lacking"
            f" AND _missing & shiftleft(1L, CAST(_ref & {WORD_BITS - 1} AS INT)) != 0"
        ),
    )
    rows = lost.unionByName(missing.groupBy("_name").agg(F.count(F.lit(1)).alias("_rows")))
    # A conditional sum per label keeps a row for every key, also over no fact rows.
    sums = rows.agg(
        *[
            F.expr(f"coalesce(sum(CASE WHEN _name = {text_literal(n)} THEN _rows END), 0) AS {quoted(n)}")
            for n in labels
        ]
    )
    return long_form(sums, [quoted(n) for n in labels], "fact_column", "bad_rows")
