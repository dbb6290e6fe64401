"""The test tables loaded as a warehouse, shared by the queries of one session."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from haulmart.contracts import STAGING, contract
from haulmart.operators.checks import WARN
from haulmart.operators.keys import split_by_key
from haulmart.plans.layers import Layers
from haulmart.plans.pipeline import LoadResult, Pipeline
from haulmart.sources.binding import FEEDS, slices, with_odd_rows, with_rejects
from haulmart.sources.feeds import Ingested, ingest
from haulmart.sources.workspace import CODEC, Workspace, remove, shuffles_removed

# The day the queries treat as today, and the load time of their facts.
AS_OF = date(2024, 12, 31)
LOAD_TS = datetime(2024, 12, 31, tzinfo=timezone.utc)


class BoundTables:
    """Feeds, layers and one logged full load over the tables in ``sf_dir``.

    Each part is built when a query first needs it and stored, as the staging
    and warehouse tables of a real load are. Nothing is built for queries that
    are never asked.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.workspace = Workspace(spark, codec=CODEC)
        self.layers = Layers(self.workspace, self._deduplicated, LOAD_TS, self._forget_feed)
        self._feeds: dict[str, Workspace] = {}
        self._csv: dict[str, str] = {}
        self._ingested: dict[str, Ingested] = {}
        self._load: tuple[Pipeline, LoadResult] | None = None

    def feed(self, table: str) -> list[DataFrame]:
        """The feed in slices."""
        return [
            with_odd_rows(FEEDS[table](self.spark, self.sf_dir, part), table)
            for part in slices(self.spark, self.sf_dir)
        ]

    def landed(self, table: str) -> list[DataFrame]:
        """The feed as it comes in files, with rows that its contract rejects, in slices."""
        return [with_rejects(part, table) for part in self.feed(table)]

    def landed_keys(self, table: str) -> DataFrame:
        keys = [part.select(*contract(table).primary_key) for part in self.landed(table)]
        return self.workspace.materialize_slices(keys, f"keys_{table}")

    def _deduplicated(self, table: str) -> DataFrame:
        """The feed is written once, since it is read several times, and goes when its staging table is stored."""
        place = self._feeds[table] = Workspace(self.spark, self.workspace.path, CODEC)
        feed = place.materialize_slices(self.feed(table), f"feed_{table}")
        return split_by_key(feed, contract(table).primary_key, place).kept

    def _forget_feed(self, table: str) -> None:
        remove(self.spark, self._feeds.pop(table).path)

    def csv_path(self, table: str) -> str:
        """The feed as header CSV files, packed, the form the loader takes."""
        if table not in self._csv:
            path = self.workspace.new_path(f"csv_{table}")
            for part in self.landed(table):
                with shuffles_removed(self.spark):
                    part.write.mode("append").options(
                        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip"
                    ).csv(path)
            self._csv[table] = path
        return self._csv[table]

    def ingested(self, table: str) -> Ingested:
        if table not in self._ingested:
            self._ingested[table] = ingest(
                self.spark, self.csv_path(table), contract(table), self.workspace
            )
        return self._ingested[table]

    def load(self) -> tuple[Pipeline, LoadResult]:
        """A full logged load from the CSV feeds; bad rows go to the reject table."""
        if self._load is None:
            pipeline = Pipeline(
                self.spark,
                f"{self.workspace.path}/published",
                as_of=AS_OF,
                mode="quarantine",
                default_severity=WARN,
            )
            self._load = pipeline, pipeline.run({c.name: self.csv_path(c.name) for c in STAGING})
        return self._load


_BOUND: dict[tuple[str, str], BoundTables] = {}


def bound(spark: SparkSession, sf_dir: str) -> BoundTables:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _BOUND:
        _BOUND[key] = BoundTables(spark, sf_dir.rstrip("/"))
    return _BOUND[key]
