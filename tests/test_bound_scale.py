"""What building the bound feeds costs: one pass for the faulty rows, tasks of bounded size, few columns counted."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame as ClassicFrame

from haulmart.sources import binding
from haulmart.sources.buckets import hot_keys, store_in_buckets, stored_parts

ROUTES = "RouteID string, DriverID string, PlannedStops int, ActualStops int, PlannedHours decimal(10,2), ActualHours decimal(10,2), Region string"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)


def test_likely_keys_are_looked_up_not_compared_one_by_one(spark, monkeypatch):
    """With a column per likely key the work grew with rows times buckets."""
    widths = []
    plain = ClassicFrame.agg
    monkeypatch.setattr(ClassicFrame, "agg", lambda self, *c: widths.append(len(c)) or plain(self, *c))
    df = spark.range(4000).select((F.col("id") % 2000).alias("ref")).unionByName(spark.range(300).select(F.lit(7).cast("long").alias("ref")))
    assert hot_keys(df, "ref", 400) == [7]
    assert max(widths, default=0) <= 2


@pytest.mark.parametrize("keys", [[None, None], [], [1, 2, None]])
def test_rows_without_a_key_are_beside_the_buckets(spark, tmp_path, keys):
    df = spark.createDataFrame([(k, "x") for k in keys], "ref bigint, name string")
    path = str(tmp_path / "t")
    store_in_buckets(df, path, "ref", 3)
    parts = stored_parts(spark, path, df.schema)
    assert len(parts) == (2 if None in keys else 1)
    assert sorted((r.ref for p in parts for r in p.collect()), key=str) == sorted(keys, key=str)


def test_faulty_rows_come_from_one_pass(spark):
    rows = [("RT-1", f"DRV-{n}", n, 3, None, None, "ASIA") for n in (1, 20, 21, 27, 28, 48)] + [("RT-2", "DRV-0", None, 1, None, None, None)]
    feed = spark.createDataFrame(rows, ROUTES)
    odd, landed = binding.with_odd_rows(feed, "staging_routes"), binding.with_rejects(feed, "staging_routes")
    assert odd.columns == landed.columns == feed.columns
    for df in (odd, landed):
        assert plan_of(df).count("Scan ExistingRDD") == 1
    added = [(r.RouteID, r.DriverID, r.PlannedHours) for r in odd.exceptAll(feed).collect()]
    # 27 and 7 count alike; so do 28, 48 and 8.
    assert sorted(added, key=str) == [
        *(("RT-1", f"DRV-{n}-RT-1-odd", 0) for n in (28, 48)),
        (None, "DRV-27-RT-1-odd", None),
    ]
    again = sorted(((r.DriverID, r.Region) for r in landed.exceptAll(feed).collect()), key=str)
    assert again == [("DRV-1", "ZZ"), ("DRV-20", "ASIA"), ("DRV-21", "ZZ")]


@pytest.fixture
def shop(spark, tmp_path):
    """Lines of more orders, parts and suppliers than one task is meant to take."""
    def write(name, df):
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))

    write("region", spark.createDataFrame([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"))
    write("nation", spark.range(4).selectExpr("int(id) n_nationkey", "'N' n_name", "int(id % 2) n_regionkey"))
    write("customer", spark.range(10).selectExpr("id c_custkey", "int(id % 4) c_nationkey"))
    write("orders", spark.range(100).selectExpr("id o_orderkey", "if(id = 5, NULL, id % 10) o_custkey"))
    write("part", spark.range(9).selectExpr("id p_partkey", "concat('T', id) p_type"))
    write(
        "lineitem",
        spark.range(400).selectExpr(
            "if(id % 50 = 3, NULL, id % 110) l_orderkey", "int(id % 7) l_linenumber", "id % 10 l_partkey", "id % 6 l_suppkey",
            "double(id % 40) l_quantity", "double(id) l_extendedprice", "0.05D l_tax", "0.1D l_discount",
            "if(id % 3 = 0, 'R', 'N') l_returnflag", "timestamp'1998-01-02 00:00:00' l_shipdate",
        ),
    )
    return str(tmp_path)


@pytest.mark.parametrize("feed", [binding.routes_feed, binding.sales_feed])
def test_lines_are_dealt_by_their_number(spark, shop, monkeypatch, feed):
    plain = feed(spark, shop)
    assert "REPARTITION_BY_NUM" not in plan_of(plain)
    monkeypatch.setattr(binding, "LINES_PER_TASK", 20)
    dealt = feed(spark, shop)
    assert plan_of(dealt).count(", 20), REPARTITION_BY_NUM") == 2
    assert rows_of(dealt) == rows_of(plain) != []
