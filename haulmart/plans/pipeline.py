"""One full load: feeds, staging, gates, star schema, reporting views."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession

from haulmart.contracts import DIMENSIONS, FACTS, STAGING, Contract, contract
from haulmart.operators.checks import FAIL, judge
from haulmart.plans.audit import row_counts
from haulmart.plans.clean import CLEAN_VIEWS
from haulmart.plans.gates import (
    CLEAN_FAILED,
    STAGING_FAILED,
    WAREHOUSE_FAILED,
    gate_clean,
    gate_staging,
    gate_warehouse,
    null_detail,
)
from haulmart.plans.layers import Layers, concurrently
from haulmart.plans.reporting import REPORTS
from haulmart.runlog import RunLog, utc_now
from haulmart.sources.feeds import (
    MODES,
    REJECT_SCHEMA,
    Ingested,
    ingest,
    require_no_rejects,
)
from haulmart.sources.snapshots import Published, SnapshotStore
from haulmart.sources.workspace import CODEC, Workspace, children, remove, shuffles_removed


# Checks whose failure is explained column by column.
NULL_CHECKS = "stg_nulls_"
# Folder of a run's parsed feeds, within its working tables.
PARSED = "parsed"


@dataclass
class LoadResult:
    run_id: str
    layers: Layers
    reports: dict[str, list[Row]] = field(default_factory=dict)


class Pipeline:
    """Loads CSV feeds into a published staging layer and star schema under ``root``.

    A load removes its working files when it ends; what it published, with its
    rejected rows, stays. ``keep_runs`` says how many of the runs that published a
    warehouse are kept on disk, the newest first; by default all are.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        as_of: date | None = None,
        mode: str = "strict",
        severities: Mapping[str, str] | None = None,
        default_severity: str = FAIL,
        gates_enabled: bool = True,
        keep_runs: int | None = None,
    ):
        if mode not in MODES:
            raise ValueError(f"unknown mode {mode!r}")
        if keep_runs is not None and keep_runs < 1:
            raise ValueError("keep_runs must be 1 or more")
        self.keep_runs = keep_runs
        self.spark = spark
        self.root = root.rstrip("/")
        self.as_of = as_of or utc_now().date()
        self.mode = mode
        self.gates_enabled = gates_enabled
        self.gate_options = {
            "severities": severities,
            "default_severity": default_severity,
            "enabled": gates_enabled,
        }
        self.snapshots = SnapshotStore(spark, self.root)
        self.log = RunLog(spark, f"{self.root}/log")

    def run(self, feeds: Mapping[str, str], name: str = "full load") -> LoadResult:
        """``feeds`` maps staging tables to CSV paths."""
        run_id = self.log.start_run(name)
        try:
            result = self._load(run_id, feeds)
        except Exception as error:
            self.log.end_run(run_id, "FAILED", str(error))
            raise
        self.log.end_run(run_id, "SUCCESS")
        return result

    def _load(self, run_id: str, feeds: Mapping[str, str]) -> LoadResult:
        workspace = Workspace(self.spark, f"{self.root}/runs/{run_id}", CODEC)
        try:
            result = self._load_into(run_id, feeds, workspace)
        finally:
            layers = ("rejects", "staging", "dw")
            stored = [t.path for n in layers for t in self.snapshots.current(n, run_id).values()]
            workspace.keep_only(stored)
        self._remove_old_runs()
        return result

    def _remove_old_runs(self) -> None:
        if self.keep_runs is None:
            return
        kept = set(self.snapshots.newest_runs("dw", self.keep_runs))
        kept |= {self.snapshots.newest_run(n) for n in ("rejects", "staging")}
        for run_id in children(self.spark, f"{self.root}/runs"):
            if run_id not in kept:
                remove(self.spark, f"{self.root}/runs/{run_id}")

    def _load_into(
        self, run_id: str, feeds: Mapping[str, str], workspace: Workspace
    ) -> LoadResult:
        # Of loads that run at once the first to publish goes on, the others stop.
        seen = {layer: self.snapshots.last_entry(layer) for layer in ("staging", "dw")}
        ingested = self._stage(run_id, feeds, workspace)
        layers = Layers(workspace, lambda table: ingested[table].good, utc_now())
        staged = self._load_tables(run_id, layers, STAGING)
        self.snapshots.publish("staging", run_id, staged, after=seen["staging"])
        # Both results of the feeds are published; the parsed text is not read again.
        remove(self.spark, f"{workspace.path}/{PARSED}")

        result = LoadResult(run_id, layers)
        options = self.gate_options
        self._gate(
            result, "Staging gate", STAGING_FAILED, lambda: gate_staging(layers, self.as_of, **options)
        )
        self._gate(result, "Clean gate", CLEAN_FAILED, lambda: gate_clean(layers, **options))

        # Dimensions before facts, since the facts join them as stored.
        loaded = self._load_tables(run_id, layers, DIMENSIONS)
        loaded |= self._load_tables(run_id, layers, FACTS)
        # Checked before it is published: readers never see a bad load.
        self._gate(result, "Warehouse gate", WAREHOUSE_FAILED, lambda: gate_warehouse(layers, **options))
        self.snapshots.publish("dw", run_id, loaded, after=seen["dw"])
        started = utc_now()
        views = publish_views(layers)
        self.log.log_step(run_id, "Publish views", started, len(views))
        return result

    def rejects(self) -> DataFrame:
        """Rejected rows of the newest load: table_name, record, reject_reason, copies."""
        path = self.snapshots.current("rejects")["rejects"].path
        return self.spark.read.schema(REJECT_SCHEMA).parquet(path)

    def _stage(
        self, run_id: str, feeds: Mapping[str, str], workspace: Workspace
    ) -> dict[str, Ingested]:
        """Parse all four feeds; in strict mode one bad row stops the load."""
        parsed = Workspace(self.spark, f"{workspace.path}/{PARSED}", CODEC)
        ingested = concurrently(
            lambda table: ingest(self.spark, feeds[table], contract(table), parsed),
            [c.name for c in STAGING],
        )
        rejects = reduce(DataFrame.unionByName, [i.rejects for i in ingested.values()])
        started = utc_now()
        path = workspace.store(rejects, "rejects")
        stored = self.spark.read.schema(rejects.schema).parquet(path)
        count = stored.count()
        # Published before the verdict, so a stopped load can be looked into.
        self.snapshots.publish("rejects", run_id, {"rejects": Published(path, count)})
        if self.mode == "strict" and count:
            try:
                require_no_rejects(stored)
            except Exception as error:
                self.log.log_step(run_id, "Check feeds", started, count, "FAILED", str(error))
                raise
        self.log.log_step(run_id, "Check feeds", started, count)
        return ingested

    def _gate(self, result: LoadResult, step: str, code: int, gate: Callable[[], DataFrame]) -> None:
        started = utc_now()
        with shuffles_removed(self.spark):
            rows = gate().collect()  # one row per declared check
        if any(r["check_id"].startswith(NULL_CHECKS) and r["bad_rows"] for r in rows):
            self._log_null_detail(result)
        try:
            judge(rows, code, step)
        except Exception as error:
            self.log.log_step(result.run_id, step, started, None, "FAILED", str(error))
            raise
        status = "SUCCESS" if self.gates_enabled else "SKIPPED"
        self.log.log_step(result.run_id, step, started, len(rows), status)
        result.reports[step] = rows

    def _log_null_detail(self, result: LoadResult) -> None:
        """A step per staging column that lacks values, with their number."""
        started = utc_now()
        found = null_detail(result.layers).filter("NullCount > 0").collect()
        self.log.log_steps(
            result.run_id,
            [
                (f"Nulls in {r['TableName']}.{r['ColumnName']}", started, r["NullCount"], "SUCCESS", None)
                for r in found
            ],
        )

    def _load_tables(
        self, run_id: str, layers: Layers, contracts: Sequence[Contract]
    ) -> dict[str, Published]:
        """Store independent tables and log the rows that landed in each."""
        started = utc_now()
        try:
            layers.load(c.name for c in contracts)
            rows = stored_rows(layers, [c.name for c in contracts])
        except Exception as error:
            names = ", ".join(c.name for c in contracts)
            self.log.log_step(run_id, f"Load {names}", started, None, "FAILED", str(error))
            raise
        self.log.log_steps(
            run_id, [(f"Load {n}", started, count, "SUCCESS", None) for n, count in rows.items()]
        )
        return {n: Published(layers.paths[n], count) for n, count in rows.items()}


def stored_rows(tables: Callable[[str], DataFrame], names: list[str]) -> dict[str, int]:
    """Rows per stored table, read from the file footers by one job."""
    return {r["TableName"]: r["RowCount"] for r in row_counts(tables, names).collect()}


def publish_views(tables: Callable[[str], DataFrame]) -> list[str]:
    """Create or replace one view per table and per clean and reporting frame."""
    names = [c.name for c in STAGING + DIMENSIONS + FACTS] + [*CLEAN_VIEWS, *REPORTS]
    for name in names:
        tables(name).createOrReplaceTempView(name)
    return names


def published(store: SnapshotStore, views: bool = False) -> Layers:
    """The layers of the newest published warehouse, ready to query: the reader's entry.

    Staging, and so the clean frames over it, is of the run that published the
    warehouse, whatever a later run that failed has staged. ``views`` registers
    every table and frame as a view of this session.
    """
    run_id = store.newest_run("dw")
    staged = store.current("staging", run_id)

    def staging(table: str) -> DataFrame:
        return store.read("staging", table, run_id)

    layers = Layers(Workspace(store.spark), staging, utc_now())
    for tables in (staged, store.current("dw", run_id)):
        for table, stored in tables.items():
            layers.adopt(table, stored.path)
    if views:
        publish_views(layers)
    return layers
