"""All tables of one warehouse run, built on demand and stored once."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from haulmart.contracts import DIMENSIONS, FACTS, STAGING, contract
from haulmart.operators.keys import BROADCAST_BYTES, estimated_bytes
from haulmart.plans.clean import CLEAN_VIEWS
from haulmart.plans.dims import VALUE_DIMENSIONS, build_dimension
from haulmart.plans.facts import FACT_PLANS
from haulmart.plans.reporting import REPORTS
from haulmart.sources.buckets import store_in_buckets, stored_parts
from haulmart.sources.workspace import Workspace

# Tables that reference a delivery, and the deliveries, are stored in buckets of this key.
BUCKET_KEYS = {t: "DeliveryID" for t in ("staging_sales", "staging_deliveries", "staging_exceptions")}
# Independent tables are written by concurrent Spark jobs.
CONCURRENT_LOADS = 4


def sized_for_lookup(dimension: DataFrame, limit: int = BROADCAST_BYTES, measured: int | None = None) -> DataFrame:
    """Mark a stored dimension for broadcast if its ``measured`` bytes are within ``limit``.

    Sending that to every executor is far cheaper than shuffling a fact. A larger
    dimension, be it by rows or by long values, is joined by shuffle, with skewed
    partitions split at run time.
    """
    measured = estimated_bytes(dimension) if measured is None else measured
    return F.broadcast(dimension) if measured <= limit else dimension


def concurrently(work: Callable[[str], object], names: Iterable[str]) -> dict[str, object]:
    """Run independent Spark jobs side by side; the first error is raised."""
    with ThreadPoolExecutor(CONCURRENT_LOADS) as pool:
        futures = {n: pool.submit(work, n) for n in names}
    return {n: f.result() for n, f in futures.items()}


def _stored_inputs(name: str) -> list[str]:
    """Stored tables a load reads; they can be loaded side by side."""
    if name in FACT_PLANS:
        return sorted({fk.ref_table for fk in contract(name).foreign_keys})
    if name == "dim_date":
        return ["staging_sales", "staging_deliveries", "staging_exceptions"]
    if name in VALUE_DIMENSIONS:
        return [CLEAN_VIEWS[view][0] for view in VALUE_DIMENSIONS[name].views]
    return []


class Layers:
    """Calling it with a table name returns that table.

    Staging, dimensions and facts are stored when first asked for; clean and
    reporting frames are views over them.
    """

    def __init__(
        self,
        workspace: Workspace,
        staging: Callable[[str], DataFrame],
        load_ts: datetime,
        staged: Callable[[str], None] | None = None,
    ):
        self.workspace = workspace
        self.staging = staging
        # Told when a staging table is stored: what it was made of is not read again.
        self.staged = staged
        self.load_ts = load_ts
        self.paths: dict[str, str] = {}
        # As many for all tables, or they don't meet; a session sizes its shuffles for its data.
        self.buckets = int(workspace.spark.conf.get("spark.sql.shuffle.partitions"))
        self._tables: dict[str, DataFrame] = {}
        self._parts: dict[str, list[DataFrame]] = {}
        self._bytes: dict[str, int] = {}
        self._locks: dict[str, threading.RLock] = {}
        self._guard = threading.Lock()

    def __call__(self, name: str) -> DataFrame:
        with self._guard:
            lock = self._locks.setdefault(name, threading.RLock())
        with lock:
            if name not in self._tables:
                self._tables[name] = self._build(name)
            return self._tables[name]

    def _build(self, name: str) -> DataFrame:
        if name in CLEAN_VIEWS:
            source, plan, _ = CLEAN_VIEWS[name]
            return plan(self(source))
        if name in REPORTS:
            return REPORTS[name](self)
        self.load(_stored_inputs(name))
        if name in FACT_PLANS:
            return self._stored(name, FACT_PLANS[name](self, self, self.load_ts))
        if name.startswith("dim_"):
            return self._sized(name, self._stored(name, build_dimension(name, self, self.workspace)))
        stored = self._stored(name, self.staging(name))
        if self.staged:
            self.staged(name)
        return stored

    def parts(self, name: str) -> list[DataFrame]:
        """A table as it is stored: its buckets, then the rows beside them; a view, the same of its source."""
        if name in CLEAN_VIEWS:
            source, plan, _ = CLEAN_VIEWS[name]
            return [plan(part) for part in self.parts(source)]
        whole = self(name)
        return self._parts.get(name, [whole])

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        if name in BUCKET_KEYS:
            self.paths[name] = self.workspace.new_path(name)
            store_in_buckets(df, self.paths[name], BUCKET_KEYS[name], self.buckets)
        else:
            self.paths[name] = self.workspace.store(df, name)
        return self._read(name, df.schema)

    def _read(self, name: str, schema: StructType) -> DataFrame:
        self._parts[name] = stored_parts(self.workspace.spark, self.paths[name], schema)
        return reduce(DataFrame.unionByName, self._parts[name])

    def adopt(self, name: str, path: str) -> None:
        """Take over a table that is already stored."""
        self.paths[name] = path
        stored = self._read(name, contract(name).schema())
        self._tables[name] = self._sized(name, stored) if name.startswith("dim_") else stored

    def _sized(self, name: str, dimension: DataFrame) -> DataFrame:
        self._bytes[name] = estimated_bytes(dimension)
        return sized_for_lookup(dimension, measured=self._bytes[name])

    def measured(self, names: Iterable[str]) -> int:
        """Bytes in memory of several dimensions."""
        for name in names:
            self(name)
        return sum(self._bytes[name] for name in names)

    def load(self, names: Iterable[str]) -> None:
        """Store several tables that do not depend on each other."""
        concurrently(self, names)

    def load_warehouse(self) -> None:
        """Dimensions before facts, since the facts join them as stored."""
        self.load(c.name for c in STAGING)
        self.load(c.name for c in DIMENSIONS)
        self.load(c.name for c in FACTS)
