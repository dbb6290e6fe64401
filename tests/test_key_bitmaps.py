"""Foreign keys by bitmaps: exact orphan rows for gaps, far keys, negative keys and no keys."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from haulmart.contracts import contract
from haulmart.operators.integrity import Reference, key_words, reference_orphans

FACT = contract("fact_routes")
COLUMNS = [fk.column for fk in FACT.foreign_keys]
REFERENCES = [Reference(fk.column, "f", fk.column, fk.ref_table, fk.ref_column) for fk in FACT.foreign_keys]


def orphans(spark, rows, dims):
    tables = {"f": spark.createDataFrame(rows, ", ".join(f"{c} bigint" for c in COLUMNS)).repartition(3)}
    for fk, keys in zip(FACT.foreign_keys, dims):
        tables[fk.ref_table] = spark.createDataFrame([(k,) for k in keys], f"{fk.ref_column} bigint")
    found = reference_orphans(REFERENCES, tables.__getitem__)
    return {r.fact_column: r.bad_rows for r in found.collect()}


def counted(rows, dims):
    return {c: sum(r[k] is None or r[k] not in set(dims[k]) for r in rows) for k, c in enumerate(COLUMNS)}


DIMS = [list(range(1, 501)), [k for k in range(-300, 300) if k % 3], [20240101 + k for k in range(31)]][: len(COLUMNS)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_count_row_by_row(spark, seed):
    rng = random.Random(seed)
    odd = [None, 0, -1, -64, -65, 501, 512, 10**15, -(10**15), 2**63 - 1, -(2**63), 20240132]
    rows = [tuple(rng.choice([rng.choice(d)] * 8 + [rng.choice(odd)]) for d in DIMS) for _ in range(2000)]
    assert orphans(spark, rows, DIMS) == counted(rows, DIMS)


def test_sound_empty_and_without_dimension(spark):
    rows = [tuple(d[k % len(d)] for d in DIMS) for k in range(700)]
    assert set(orphans(spark, rows, DIMS).values()) == {0}
    assert orphans(spark, [], DIMS) == dict.fromkeys(COLUMNS, 0)
    assert orphans(spark, rows, [[] for _ in DIMS]) == dict.fromkeys(COLUMNS, 700)


def test_one_key_for_a_third_of_the_rows(spark):
    """A hot orphan among known neighbours of the same word."""
    rows = [tuple(d[k % len(d)] for d in DIMS) for k in range(1000)] + [(502,) + tuple(d[0] for d in DIMS[1:])] * 500
    dims = [[*DIMS[0], 503], *DIMS[1:]]
    assert orphans(spark, rows, dims) == counted(rows, dims)


def test_far_keys_are_words_of_their_own(spark):
    pairs = spark.range(0, 128).select(F.lit("c").alias("_name"), F.col("id").alias("_ref"))
    far = spark.createDataFrame([("c", 10**17), ("c", 10**17 + 1), ("c", -5)], "_name string, _ref bigint")
    words = {r._word: (bin(r._bits & (2**64 - 1)).count("1"), r._rows) for r in key_words(pairs.union(far)).collect()}
    assert Counter(words.values()) == {(64, 64): 2, (2, 2): 1, (1, 1): 1}


def test_sound_load_reads_the_fact_once(spark):
    """The second look at the fact is dropped at run time when no word lacks a key."""
    fact = spark.range(1, 400).select(*[F.col("id").alias(c) for c in COLUMNS])
    dims = {fk.ref_table: spark.range(1, 400).select(F.col("id").alias(fk.ref_column)) for fk in FACT.foreign_keys}
    found = reference_orphans(REFERENCES, ({"f": fact} | dims).__getitem__, few=True)
    assert {r.bad_rows for r in found.collect()} == {0}
    # Of the final plan, what ran.
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.partition("== Initial Plan ==")[0]
    assert final.count("Range") == 1 + len(COLUMNS), final
