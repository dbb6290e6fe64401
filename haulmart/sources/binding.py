"""Test tables seen as the four source feeds.

The rules are fixed, so an SQL twin can rebuild every feed from the same tables.
Nation and region lookups carry no broadcast hint: the planner sees their file
sizes and decides.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the binding.
PLANNED_DAYS = 60
UNPLANNED_EVERY = 50
URGENT = ("1-URGENT", "2-HIGH")


def scan(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Lines that one statement shuffles. More are taken in slices, one after the other, so that the shuffle files
# of one slice are on disk at a time, whatever the size of the tables.
LINES_PER_SLICE = 64_000_000


@dataclass(frozen=True)
class Slice:
    """One of several parts of a feed."""

    number: int = 0
    of: int = 1

    def rows(self, df: DataFrame, key: str) -> DataFrame:
        """Rows of this slice. All rows of a key, and of none, are in one slice, also where the key has another name or width."""
        if self.of == 1:
            return df
        # Not the hash that deals rows to tasks, or a slice would leave some tasks without rows.
        return df.where(F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(self.of)) == self.number)


WHOLE = Slice()


def slices(spark: SparkSession, sf_dir: str) -> list[Slice]:
    lines = scan(spark, sf_dir, "lineitem").count()  # counted in the file footers
    number = max(1, -(-lines // LINES_PER_SLICE))
    return [Slice(n, number) for n in range(number)]


def _customer_region(spark: SparkSession, sf_dir: str, part: Slice = WHOLE) -> DataFrame:
    customer = part.rows(scan(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
    nation = scan(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = scan(spark, sf_dir, "region")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_nationkey", F.col("r_name").alias("Region"))
    )


def _order_region(spark: SparkSession, sf_dir: str, *columns: str, part: Slice = WHOLE) -> DataFrame:
    orders = scan(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", *columns)
    return part.rows(orders, "o_orderkey").join(
        _customer_region(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")
    ).drop("o_custkey", "c_custkey")


# Every so many exceptions are open: more than the share of nulls that makes a column critical.
OPEN_EVERY = 3


# Lines that one task joins and groups. Many more are dealt over as many tasks as that takes, whatever the
# session's number: what a task holds must not grow with the tables.
LINES_PER_TASK = 500_000
FEW_TASKS = 16


def _dealt(lineitem: DataFrame, orders: DataFrame, part: Slice, key: str) -> tuple[DataFrame, DataFrame]:
    """Lines of a slice by ``key`` and orders by order, in tasks of bounded size; a few tasks' worth is left to the planner."""
    tasks = -(-lineitem.count() // (LINES_PER_TASK * part.of))  # counted in the file footers
    lineitem = part.rows(lineitem, key)
    if tasks <= FEW_TASKS:
        return lineitem, orders
    tasks = max(tasks, lineitem.sparkSession.sparkContext.defaultParallelism)
    return lineitem.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")


def sales_feed(spark: SparkSession, sf_dir: str, sliced: Slice = WHOLE) -> DataFrame:
    lineitem = scan(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_shipdate",
    )
    part = scan(spark, sf_dir, "part").select("p_partkey", "p_type")
    lineitem, orders = _dealt(lineitem, _order_region(spark, sf_dir, part=sliced), sliced, "l_orderkey")
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat_ws(
                "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd")
            ).alias("SalesID"),
            F.col("l_orderkey").alias("DeliveryID"),
            F.col("l_shipdate").cast("date").alias("DateKey"),
            F.col("p_type").alias("ProductType"),
            "Region",
            F.col("l_quantity").cast("int").alias("UnitsSold"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("SalesAmount"),
        )
    )


def deliveries_feed(spark: SparkSession, sf_dir: str, sliced: Slice = WHOLE) -> DataFrame:
    orders = _order_region(
        spark, sf_dir, "o_orderdate", "o_orderstatus", "o_orderpriority", part=sliced
    )
    shipped = (
        sliced.rows(scan(spark, sf_dir, "lineitem"), "l_orderkey")
        .groupBy("l_orderkey")
        .agg(
            F.max(F.col("l_shipdate").cast("date")).alias("shipped"),
            F.min("l_suppkey").alias("supplier"),
        )
    )
    planned = F.date_add(F.col("o_orderdate").cast("date"), PLANNED_DAYS)
    return orders.join(
        shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    ).select(
        F.col("o_orderkey").alias("DeliveryID"),
        F.concat(F.lit("RT-"), F.col("c_nationkey").cast("string")).alias("RouteID"),
        F.concat(F.lit("DRV-"), F.col("supplier").cast("string")).alias("DriverID"),
        "Region",
        F.col("o_orderpriority").alias("ShipmentType"),
        F.col("shipped").alias("DeliveryDate"),
        F.when(F.col("o_orderkey") % UNPLANNED_EVERY != 0, planned).alias("ExpectedDeliveryDate"),
        F.col("o_orderstatus").alias("DeliveryStatus"),
        F.col("o_orderpriority").isin(*URGENT).alias("PriorityFlag"),
    )


def exceptions_feed(spark: SparkSession, sf_dir: str, sliced: Slice = WHOLE) -> DataFrame:
    events = scan(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value"
    )
    reported = F.col("ts").cast("date")
    resolved = F.date_add(reported, F.floor(F.col("value") / 24).cast("int") - 1)
    hours = (
        F.when(F.col("event_id") % 5 == 0, F.lit(-1).cast("decimal(6,2)"))
        .when(F.col("event_id") % 4 == 0, F.lit(None).cast("decimal(6,2)"))
        .otherwise(F.col("value").cast("decimal(6,2)"))
    )
    return sliced.rows(events, "user_id").join(
        _customer_region(spark, sf_dir, sliced), F.col("user_id") == F.col("c_custkey")
    ).select(
        F.col("event_id").alias("ExceptionID"),
        F.col("user_id").alias("DeliveryID"),
        F.col("event_type").alias("ExceptionType"),
        reported.alias("DateReported"),
        F.when(F.col("event_id") % OPEN_EVERY != 0, resolved).alias("ResolvedDate"),
        hours.alias("ResolutionTimeHours"),
        (F.col("event_id") % 2 == 1).alias("PriorityFlag"),
        "Region",
    )


def routes_feed(spark: SparkSession, sf_dir: str, sliced: Slice = WHOLE) -> DataFrame:
    """A stop counts as done unless its line was returned. A slice has whole suppliers, so whole routes."""
    lineitem = scan(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_tax", "l_discount", "l_returnflag"
    )
    quantity = F.col("l_quantity").cast("decimal(10,2)")
    factor = (
        F.lit(1).cast("decimal(4,2)")
        + F.col("l_tax").cast("decimal(4,2)")
        - F.col("l_discount").cast("decimal(4,2)")
    )
    tenth = F.lit("0.1").cast("decimal(2,1)")
    lineitem, orders = _dealt(lineitem, _order_region(spark, sf_dir), sliced, "l_suppkey")
    grouped = (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("c_nationkey", "l_suppkey", "Region")
        .agg(
            F.countDistinct("l_orderkey").alias("planned_stops"),
            F.count(F.when(F.col("l_returnflag") != "R", 1)).alias("actual_stops"),
            F.sum(quantity).alias("planned"),
            F.sum(quantity * factor).alias("actual"),
        )
    )
    return grouped.select(
        F.concat(F.lit("RT-"), F.col("c_nationkey").cast("string")).alias("RouteID"),
        F.concat(F.lit("DRV-"), F.col("l_suppkey").cast("string")).alias("DriverID"),
        F.col("planned_stops").cast("int").alias("PlannedStops"),
        F.col("actual_stops").cast("int").alias("ActualStops"),
        (F.col("planned") * tenth).cast("decimal(10,2)").alias("PlannedHours"),
        (F.col("actual") * tenth).cast("decimal(10,2)").alias("ActualHours"),
        "Region",
    )


# Fixed rules for faulty rows. Each is a copy of a real row with something changed, so no real row is
# touched. The number that a rule counts by, and how often it applies, per feed.
COUNTED_BY = {
    "staging_sales": ("DeliveryID", 400),
    "staging_deliveries": ("DeliveryID", 400),
    "staging_routes": ("PlannedStops", 20),
    "staging_exceptions": ("ExceptionID", 400),
}
TOO_LONG = "LONG " * 11
LATE_DATE = "2101-03-01"


def _with_changed(feed: DataFrame, table: str, first: int, changed: list[dict]) -> DataFrame:
    """The feed and, for each change, changed copies of the rows that it applies to, in one pass over the feed.

    The changes apply to rows counted ``first``, the next to those counted one more, and so on.
    """
    column, every = COUNTED_BY[table]
    nth = F.col(column) % every - first
    none = F.lit(-1)
    copies = F.when(nth.between(0, len(changed) - 1), F.array(none, nth.cast("int"))).otherwise(F.array(none))
    values = {c: F.col(c) for c in feed.columns}
    for i, change in enumerate(changed):
        values |= {c: F.when(F.col("_copy") == i, value).otherwise(values[c]) for c, value in change.items()}
    return feed.withColumn("_copy", F.explode(copies)).select(*[v.alias(c) for c, v in values.items()])


def with_odd_rows(feed: DataFrame, table: str) -> DataFrame:
    """The feed and rows under keys of their own that break rules of the gates: empty, zero or late values, no delivery."""
    changed: list[dict] = {
        "staging_sales": [
            {"UnitsSold": F.lit(0)},
            {"DateKey": F.lit(LATE_DATE).cast("date")},
            {"SalesAmount": F.lit(None).cast("decimal(10,2)")},
            {"DeliveryID": -F.col("DeliveryID")},
        ],
        "staging_deliveries": [
            {"RouteID": F.lit(None).cast("string")},
            {"DeliveryDate": F.lit(LATE_DATE).cast("date"), "ExpectedDeliveryDate": F.lit(LATE_DATE).cast("date")},
            {"DeliveryStatus": F.lit(" delivered ")},
        ],
        "staging_routes": [
            {"RouteID": F.lit(None).cast("string")},
            {"PlannedHours": F.lit(0).cast("decimal(10,2)")},
        ],
        "staging_exceptions": [
            {"DateReported": F.lit(None).cast("date")},
            {"DeliveryID": -F.col("DeliveryID")},
        ],
    }[table]
    key = {
        "staging_sales": {"SalesID": F.concat("SalesID", F.lit("-odd"))},
        "staging_deliveries": {"DeliveryID": -F.col("DeliveryID")},
        "staging_routes": {"DriverID": F.concat_ws("-", "DriverID", "RouteID", F.lit("odd"))},
        "staging_exceptions": {"ExceptionID": -F.col("ExceptionID")},
    }[table]
    return _with_changed(feed, table, 7, [{**key, **c} for c in changed])


def with_rejects(feed: DataFrame, table: str) -> DataFrame:
    """What lands as a file: the feed and rows that its contract rejects.

    Exact copies, copies under the same key with another region, regions longer
    than the column, and rows without a region.
    """
    changed = [
        {},
        {"Region": F.lit("ZZ")},
        {"Region": F.lit(TOO_LONG)},
        {"Region": F.lit(None).cast("string")},
    ]
    return _with_changed(feed, table, 0, changed)


FEEDS = {
    "staging_sales": sales_feed,
    "staging_deliveries": deliveries_feed,
    "staging_routes": routes_feed,
    "staging_exceptions": exceptions_feed,
}
