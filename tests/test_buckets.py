"""Tables in buckets: same rows, orphans without a shuffle, hot references beside the buckets."""

from __future__ import annotations

import re

import pytest

from haulmart.operators.integrity import orphan_count, orphan_rows
from haulmart.sources.buckets import hot_keys, store_in_buckets, stored_parts

BUCKETS = 6


@pytest.fixture(scope="module")
def parts_of(spark, tmp_path_factory):
    def stored(rows, schema="ref bigint, name string"):
        path = str(tmp_path_factory.mktemp("buckets") / "t")
        df = spark.createDataFrame(rows, schema).repartition(3)
        store_in_buckets(df, path, "ref", BUCKETS)
        return stored_parts(spark, path, df.schema)

    return stored


def shuffles(df) -> list[str]:
    return re.findall(r"\bExchange [^\n]*|BroadcastExchange", df._jdf.queryExecution().executedPlan().toString())


CHILD = [(k % 200, f"c{k}") for k in range(3000)]
PARENT = [(k, "p") for k in range(0, 200) if k % 7] + [(k, "q") for k in range(500, 900)]
ORPHANS = sorted((r, n) for r, n in CHILD if r % 7 == 0)


def test_orphans_without_exchange(parts_of):
    """Neither side of rows or keys is shuffled; only the one sum at the end is gathered."""
    child, parent = parts_of(CHILD), parts_of(PARENT)
    assert len(child) == len(parent) == 1
    rows = orphan_rows(child, parent, "ref")
    assert shuffles(rows) == []
    assert sorted(map(tuple, rows.collect())) == ORPHANS
    count = orphan_count(child, "ref", parent, "ref")
    assert all("SinglePartition" in s for s in shuffles(count)) and len(shuffles(count)) == 1
    assert count.first().bad_rows == len(ORPHANS)


@pytest.mark.parametrize("hot,missing", [(3, False), (7, True)])
def test_hot_reference_is_kept_out_of_the_buckets(parts_of, hot, missing):
    """One parent for a third of the children: its rows are beside the buckets and judged without the parent being moved."""
    rows = CHILD + [(hot, f"h{k}") for k in range(1500)] + [(None, "none")] * 40
    child, parent = parts_of(rows), parts_of(PARENT)
    buckets, rest = child
    assert {r.ref for r in rest.select("ref").distinct().collect()} == {hot, None}
    assert buckets.where(f"ref = {hot} OR ref IS NULL").isEmpty()
    expected = sorted(((r, n) for r, n in rows if r is None or r % 7 == 0), key=str)
    found = orphan_rows(child, parent, "ref")
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert orphan_count(child, "ref", parent, "ref").first().bad_rows == len(expected)
    assert ((hot, "h0") in expected) == missing


def test_parent_rows_beside_its_buckets_count(parts_of):
    """A repeated parent key and parents without a key."""
    parent = parts_of(PARENT + [(14, "r")] * 900 + [(None, "x")] * 5)
    assert len(parent) == 2
    child = parts_of(CHILD)
    assert orphan_count(child, "ref", parent, "ref").first().bad_rows == sum(r != 14 for r, _ in ORPHANS)
    assert sorted(map(tuple, orphan_rows(child, parent, "ref").collect())) == [o for o in ORPHANS if o[0] != 14]


def test_empty_tables(parts_of):
    child, parent = parts_of(CHILD), parts_of([])
    assert orphan_count(child, "ref", parent, "ref").first().bad_rows == len(CHILD)
    assert orphan_count(parent, "ref", child, "ref").first().bad_rows == 0


def test_hot_keys_are_counted(spark):
    """Frequent items has others among its answers; only keys above the share are hot."""
    df = spark.createDataFrame(CHILD + [(5, "x")] * 1000, "ref bigint, name string")
    assert hot_keys(df, "ref", BUCKETS) == [5]
    assert hot_keys(spark.createDataFrame(CHILD, "ref bigint, name string"), "ref", BUCKETS) == []
    assert hot_keys(df, "ref", 1) == []


def test_plain_table_is_one_part(spark, tmp_path):
    df = spark.createDataFrame(CHILD, "ref bigint, name string")
    df.write.parquet(str(tmp_path / "plain"))
    (part,) = stored_parts(spark, str(tmp_path / "plain"), df.schema)
    assert part.count() == len(CHILD)


@pytest.mark.parametrize("key", ["stg_ri_sales", "stg_ri_exceptions", "cln_ri_sales", "cln_ri_exceptions"])
def test_checks_of_a_load_shuffle_neither_table(spark, key):
    from haulmart.bound import AS_OF, bound
    from haulmart.plans.gates import clean_checks, staging_checks
    from haulmart.plans.profiling import orphan_list

    tables = bound(spark, "/root/testdata/sf0.001").layers
    (check,) = [c for c in staging_checks(AS_OF) + clean_checks() if c.key == key]
    assert len(tables.parts(check.child)) == 1
    assert all("SinglePartition" in s for s in shuffles(check.bad_rows(tables)))
    view = f"clean_{check.child.partition('_')[2]}"
    assert shuffles(orphan_list(tables, view, "SalesID" if "sales" in key else "ExceptionID")) == []
