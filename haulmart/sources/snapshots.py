"""Published snapshots: a layer switches to new tables by one manifest entry.

Tables of a run are written to folders of their own. Publishing creates one
small file with the table paths, named by the layer's next number, and only if
no file has that name. Readers follow the highest number, whatever the clocks
of the publishers say, so a run that fails before this point leaves the
previous tables readable. An entry is one line: one that its publisher could
not finish is not read.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmart.contracts import contract
from haulmart.operators.shape import empty_frame
from haulmart.sources.buckets import stored_parts
from haulmart.sources.workspace import children, create_new

ENTRY_SCHEMA = (
    "layer string, entry bigint, run_id string, published_at timestamp, "
    "tables array<struct<table_name string, path string, rows bigint>>"
)
MANIFEST_SCHEMA = (
    "layer string, entry bigint, run_id string, published_at timestamp, table_name string, "
    "path string, row_count bigint"
)


class PublishConflict(RuntimeError):
    """Another run has published the layer since this one looked."""


@dataclass(frozen=True)
class Published:
    path: str
    rows: int


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.manifest_path = f"{self.root}/manifest"

    def last_entry(self, layer: str) -> int:
        """Number of a layer's last entry, finished or not; 0 before the first one."""
        names = children(self.spark, f"{self.manifest_path}/{layer}")
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def publish(
        self, layer: str, run_id: str, tables: Mapping[str, Published], after: int | None = None
    ) -> int:
        """Add an entry and return its number.

        With ``after``, the entry must be the next one to that number, else ``PublishConflict``
        is raised and nothing changes; without, it gets the first free number.
        """
        listed = [{"table_name": name, **asdict(t)} for name, t in tables.items()]
        number = (self.last_entry(layer) if after is None else after) + 1
        while True:
            now = datetime.now(timezone.utc).isoformat()
            entry = {
                "layer": layer, "entry": number, "run_id": run_id, "published_at": now, "tables": listed,
            }
            path = f"{self.manifest_path}/{layer}/{number:012d}.json"
            if create_new(self.spark, path, json.dumps(entry) + "\n"):
                return number
            if after is not None:
                raise PublishConflict(
                    f"run {run_id}: entry {number} of layer {layer} has been published by another run"
                )
            number += 1

    def manifest(self) -> DataFrame:
        """A row per table of every publication; empty before the first one."""
        reader = self.spark.read.schema(ENTRY_SCHEMA).option("mode", "DROPMALFORMED")
        try:
            entries = reader.option("recursiveFileLookup", "true").json(self.manifest_path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty_frame(self.spark, MANIFEST_SCHEMA)
        listed = entries.select("layer", "entry", "run_id", "published_at", F.inline("tables"))
        return listed.withColumnRenamed("rows", "row_count")

    def newest_run(self, layer: str) -> str | None:
        rows = self.newest_runs(layer, 1)
        return rows[0] if rows else None

    def newest_runs(self, layer: str, count: int) -> list[str]:
        """Runs that published a layer, the newest first."""
        runs = self.manifest().filter(F.col("layer") == layer).groupBy("run_id")
        last = runs.agg(F.max("entry").alias("entry")).orderBy(F.desc("entry"))
        return [r["run_id"] for r in last.limit(count).collect()]

    def current(self, layer: str, run_id: str | None = None) -> dict[str, Published]:
        """Tables of the newest publication of a layer, or of one run; a dozen rows at most."""
        run_id = run_id or self.newest_run(layer)
        published = self.manifest().filter((F.col("layer") == layer) & (F.col("run_id") == run_id))
        return {r["table_name"]: Published(r["path"], r["row_count"]) for r in published.collect()}

    def read(self, layer: str, table: str, run_id: str | None = None) -> DataFrame:
        path = self.current(layer, run_id)[table].path
        return reduce(DataFrame.unionByName, stored_parts(self.spark, path, contract(table).schema()))


def reload_table(df: DataFrame, path: str) -> DataFrame:
    """Full refresh: the table at ``path`` holds exactly the rows of ``df`` afterwards."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
