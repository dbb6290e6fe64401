from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from haulmart.operators.keys import assign_surrogate_key, duplicate_groups, split_by_key
from haulmart.sources.workspace import Workspace


@pytest.mark.parametrize("values_per_task", [1_000_000, 7])
def test_surrogate_keys_are_dense_and_ordered(spark, workspace, values_per_task):
    values = spark.range(100).selectExpr("concat('v', lpad(string(id * 7 % 100), 3, '0')) AS v")
    keyed = assign_surrogate_key(values, "v", "k", workspace, values_per_task)
    got = [(r.k, r.v) for r in keyed.orderBy("k").collect()]
    assert got == [(i + 1, f"v{i:03d}") for i in range(100)]
    assert dict(keyed.dtypes)["k"] == "bigint"


def expected_split(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0].rstrip().upper()].append(row)
    kept = [min(g) for g in groups.values()]
    rejected = Counter(rows)
    rejected.subtract(Counter(kept))
    return sorted(kept), {r: n for r, n in rejected.items() if n}


def run_split(spark, rows, limit):
    df = spark.createDataFrame(rows, "k string, v int")
    split = split_by_key(df, ["k"], Workspace(spark), broadcast_limit=limit)
    kept = sorted(tuple(r) for r in split.kept.collect())
    rejected = {(r.k, r.v): r.copies for r in split.rejected.collect()}
    return kept, rejected


ROWS = [("a", 2), ("A ", 1), ("a", 2), ("a", 2), ("b", 5), ("c", 1), ("c", 1), ("d", 9)]


@pytest.mark.parametrize("limit", [1000, 0], ids=["few duplicates", "many duplicates"])
def test_split_keeps_first_row_per_key(spark, limit):
    assert run_split(spark, ROWS, limit) == expected_split(ROWS)


@pytest.mark.parametrize("limit", [1000, 0])
def test_split_with_one_key_on_a_third_of_the_rows(spark, limit):
    rows = [("hot", i % 5) for i in range(300)] + [(f"k{i}", i) for i in range(600)]
    assert run_split(spark, rows, limit) == expected_split(rows)


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.tuples(st.sampled_from("aAbBc"), st.integers(0, 3)), min_size=1, max_size=20))
def test_split_loses_no_row(spark, rows):
    kept, rejected = run_split(spark, rows, 1000)
    assert (kept, rejected) == expected_split(rows)
    assert len(kept) + sum(rejected.values()) == len(rows)


def test_split_without_duplicates(spark):
    kept, rejected = run_split(spark, [("a", 1), ("b", 2)], 1000)
    assert (kept, rejected) == ([("a", 1), ("b", 2)], {})


def test_duplicate_groups_use_the_whole_key(spark):
    df = spark.createDataFrame([("r", "x"), ("r", "y"), ("r", "Y ")], "a string, b string")
    assert [r.copies for r in duplicate_groups(df, ["a", "b"]).collect()] == [2]
