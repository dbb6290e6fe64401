"""What a load keeps on disk: no shuffle files of earlier statements, no working tables after their last reader."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from haulmart.bound import BoundTables
from haulmart.operators import keys
from haulmart.plans.pipeline import Pipeline
from haulmart.sources import binding, buckets
from haulmart.sources.workspace import CODEC, SHUFFLES_END, Workspace, children, shuffles_removed

from tests.test_bound_scale import plan_of, rows_of, shop  # noqa: F401
from tests.test_operations import AS_OF, feeds  # noqa: F401


@pytest.fixture
def busy_shop(spark, shop):  # noqa: F811
    events = spark.range(200).selectExpr(
        "id event_id", "timestamp'2024-01-02 00:00:00' ts", "if(id % 9 = 0, NULL, int(id % 12)) user_id",
        "concat('E', id % 3) event_type", "double(id % 70) value",
    )
    events.write.parquet(f"{shop}/events.parquet")
    spark.range(100).selectExpr(
        "id o_orderkey", "if(id = 5, NULL, id % 10) o_custkey", "timestamp'1998-01-01 00:00:00' o_orderdate",
        "'F' o_orderstatus", "'2-HIGH' o_orderpriority",
    ).write.mode("overwrite").parquet(f"{shop}/orders.parquet")
    return shop


def kept_shuffles(spark) -> set[int]:
    statuses = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    return {int(n) for n in str(statuses.keys().mkString(",")).split(",") if n}


@pytest.mark.parametrize("own", [None, "false"])
def test_a_stored_table_leaves_no_shuffle(spark, workspace, own):
    if own is not None:
        spark.conf.set(SHUFFLES_END, own)
    before, setting = kept_shuffles(spark), spark.conf.get(SHUFFLES_END, None)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    stored = workspace.materialize(df, "sums")
    with shuffles_removed(spark), shuffles_removed(spark):
        assert len(df.orderBy("k").collect()) == 7
    assert kept_shuffles(spark) <= before
    assert spark.conf.get(SHUFFLES_END, None) == setting
    assert rows_of(stored) == rows_of(df)
    spark.conf.unset(SHUFFLES_END)


def test_buckets_leave_no_shuffle(spark, tmp_path):
    before = kept_shuffles(spark)
    buckets.store_in_buckets(spark.range(500).withColumnRenamed("id", "ref"), str(tmp_path / "t"), "ref", 4)
    assert kept_shuffles(spark) <= before


@pytest.mark.parametrize("table", binding.FEEDS)
def test_slices_of_a_feed_make_up_the_feed(spark, busy_shop, monkeypatch, table):
    monkeypatch.setattr(binding, "LINES_PER_SLICE", 150)
    parts = binding.slices(spark, busy_shop)
    assert len(parts) == 3
    feed = binding.FEEDS[table]
    sliced = [rows_of(feed(spark, busy_shop, part)) for part in parts]
    whole = rows_of(feed(spark, busy_shop))
    assert sorted((r for rows in sliced for r in rows), key=str) == whole
    assert max(map(len, sliced)) < len(whole)


def test_few_lines_are_one_slice(spark, busy_shop):
    assert binding.slices(spark, busy_shop) == [binding.WHOLE]


def test_tasks_of_a_slice_are_fewer(spark, busy_shop, monkeypatch):
    monkeypatch.setattr(binding, "LINES_PER_TASK", 10)
    dealt = binding.sales_feed(spark, busy_shop, binding.Slice(0, 2))
    assert plan_of(dealt).count(", 20), REPARTITION_BY_NUM") == 2


def test_buckets_written_some_at_a_time(spark, tmp_path, monkeypatch):
    rows = [(k % 90, f"c{k}") for k in range(900)] + [(7, "hot")] * 400 + [(None, "none")] * 3
    df = spark.createDataFrame(rows, "ref bigint, name string").repartition(3)
    stored, written = {}, []
    plain = DataFrameWriter.saveAsTable
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", lambda self, name: written.append(name) or plain(self, name))
    for size, slices in ((10_000, 1), (400, 4), (100, 6)):
        monkeypatch.setattr(buckets, "ROWS_PER_SLICE", size)
        path = str(tmp_path / str(size))
        written.clear()
        buckets.store_in_buckets(df, path, "ref", 24)
        assert len(written) == slices and len(set(written)) == 1
        files = [f for f in children(spark, f"{path}/by_ref_in_24") if f.startswith("part-")]
        assert len(files) == len({f.split("_")[-1].split(".")[0] for f in files}) > 20
        assert all(f".{CODEC}." in f for f in files)
        stored[size] = buckets.stored_parts(spark, path, df.schema)
    for whole, some, many in zip(*stored.values(), strict=True):
        assert rows_of(whole) == rows_of(some) == rows_of(many) != []
    met = stored[100][0].join(stored[10_000][0].hint("merge"), "ref")
    assert "Exchange" not in plan_of(met)


def test_the_feed_goes_when_its_staging_table_is_stored(spark, busy_shop):
    tables = BoundTables(spark, busy_shop)
    staged = rows_of(tables.layers("staging_sales"))
    left = children(spark, tables.workspace.path)
    assert [name.rpartition("-")[0] for name in left] == ["staging_sales"]
    assert rows_of(tables.feed("staging_sales")[0]) == staged != []


def test_feeds_in_files_are_packed_and_not_stored_besides(spark, busy_shop, monkeypatch):
    monkeypatch.setattr(binding, "LINES_PER_SLICE", 150)
    tables = BoundTables(spark, busy_shop)
    path = tables.csv_path("staging_deliveries")
    assert all(f.endswith(".csv.gz") for f in children(spark, path) if f.startswith("part-"))
    assert children(spark, tables.workspace.path) == [path.rpartition("/")[2]]
    landed = [r for part in tables.landed("staging_deliveries") for r in part.collect()]
    assert spark.read.option("header", True).csv(path).count() == len(landed) > 0
    assert tables.landed_keys("staging_deliveries").count() == len(landed)


def test_parsed_feeds_are_gone_before_the_gates(spark, tmp_path, feeds, monkeypatch):  # noqa: F811
    root, seen = str(tmp_path / "root"), []
    gate = Pipeline._gate

    def watched(self, result, step, *more):
        place = result.layers.workspace.path
        seen.append((step, sorted(n.rpartition("-")[0] or n for n in children(spark, place))))
        return gate(self, result, step, *more)

    monkeypatch.setattr(Pipeline, "_gate", watched)
    Pipeline(spark, root, as_of=AS_OF, mode="quarantine").run(feeds(staging_sales=["1,10,2024-01-05,box,ne,3,30.00"]))
    assert seen[0] == ("Staging gate", ["rejects", *sorted(binding.FEEDS)])


def test_many_clashing_keys_move_only_rows_on_their_map(spark, tmp_path, monkeypatch):
    """The list of these keys is beyond the limit of a broadcast, their map isn't."""
    monkeypatch.setattr(keys, "MAP_BITS", 12)
    df = spark.range(4000).selectExpr("concat('key ', if(id < 3800, id, id - 3800)) k", "int(id) v")
    place = Workspace(spark, str(tmp_path))
    split = keys.split_by_key(df, ["k"], place, broadcast_limit=64 * 48)
    folded = next(n for n in children(spark, place.path) if n.startswith("folded"))
    assert 400 <= spark.read.parquet(f"{place.path}/{folded}").count() < 1200
    assert sorted(r.v for r in split.kept.collect()) == list(range(3800))
    assert sorted(r.v for r in split.rejected.collect()) == list(range(3800, 4000))


@pytest.mark.parametrize("map_bits,hash_bits", [(6, 6), (26, 3), (26, 40)])
def test_keys_that_share_a_hash_are_told_apart(spark, tmp_path, monkeypatch, map_bits, hash_bits):
    monkeypatch.setattr(keys, "MAP_BITS", map_bits)
    monkeypatch.setattr(keys, "HASH_BITS", hash_bits)
    df = spark.range(100).selectExpr("if(id % 10 = 0, NULL, concat('k', id)) k", "int(id) v")
    found = keys.duplicate_groups(df, ["k"]).collect()
    assert [(r._key_k, r.copies) for r in found] == [(None, 10)]
    split = keys.split_by_key(df, ["k"], Workspace(spark, str(tmp_path)))
    assert sorted(r.v for r in split.kept.collect()) == [0, *[v for v in range(100) if v % 10]]
    assert sorted(r.v for r in split.rejected.collect()) == list(range(10, 100, 10))


def test_duplicates_are_looked_for_by_hash(spark):
    """The first look moves a number a row, not the key."""
    wide = spark.range(100).selectExpr("concat('a long name ', id) k")
    (first,) = [line for line in plan_of(keys.clash_words(wide, ["k"])).splitlines() if "Exchange hashpartitioning(_hash" in line]
    assert "_key_k" not in first
