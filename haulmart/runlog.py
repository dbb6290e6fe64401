"""Run and step log as append-only event tables.

Nothing is updated in place: opening and closing a run are two events, and
the run table is the fold of the events of each run.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmart.operators.shape import empty_frame, literal_rows

# The statuses a run or step may have.
STATUSES = ("RUNNING", "SUCCESS", "FAILED", "SKIPPED")

RUN_EVENTS = (
    "RunID string, seq int, PipelineName string, event_time timestamp, "
    "Status string, ErrorMessage string"
)
STEP_EVENTS = (
    "StepLogID string, RunID string, StepName string, StartTime timestamp, EndTime timestamp, "
    "RowsProcessed bigint, Status string, ErrorMessage string"
)


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


class RunLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.run_path = f"{root.rstrip('/')}/run_events"
        self.step_path = f"{root.rstrip('/')}/step_events"

    def _append(self, path: str, schema: str, rows: list[tuple]) -> None:
        """One file per append, however many rows."""
        literal_rows(self.spark, rows, schema).write.mode("append").parquet(path)

    def _read(self, path: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty_frame(self.spark, schema)

    def start_run(self, pipeline: str) -> str:
        run_id = uuid.uuid4().hex
        self._append(self.run_path, RUN_EVENTS, [(run_id, 0, pipeline, utc_now(), "RUNNING", None)])
        return run_id

    def end_run(self, run_id: str, status: str, error: str | None = None) -> None:
        self._check(status)
        self._append(self.run_path, RUN_EVENTS, [(run_id, 1, None, utc_now(), status, error)])

    def log_step(
        self,
        run_id: str,
        step: str,
        started: datetime,
        rows: int | None = None,
        status: str = "SUCCESS",
        error: str | None = None,
    ) -> None:
        """Record a finished step; it ends at the time of the call."""
        self.log_steps(run_id, [(step, started, rows, status, error)])

    def log_steps(
        self, run_id: str, steps: list[tuple[str, datetime, int | None, str, str | None]]
    ) -> None:
        """Record steps that ended together: (step, started, rows, status, error)."""
        ended = utc_now()
        entries = []
        for step, started, rows, status, error in steps:
            self._check(status)
            entries.append(
                (uuid.uuid4().hex, run_id, step, started, ended, rows, status, error)
            )
        self._append(self.step_path, STEP_EVENTS, entries)

    @staticmethod
    def _check(status: str) -> None:
        if status not in STATUSES:
            raise ValueError(f"unknown status {status!r}")

    def runs(self) -> DataFrame:
        """RunID, PipelineName, StartTime, EndTime, Status, ErrorMessage."""
        opened = F.col("seq") == 0
        # Two closing events of one run: the later one counts.
        order = F.struct("seq", "event_time")
        return (
            self._read(self.run_path, RUN_EVENTS)
            .groupBy("RunID")
            .agg(
                F.max(F.when(opened, F.col("PipelineName"))).alias("PipelineName"),
                F.min(F.when(opened, F.col("event_time"))).alias("StartTime"),
                F.max(F.when(~opened, F.col("event_time"))).alias("EndTime"),
                F.max_by("Status", order).alias("Status"),
                F.max_by("ErrorMessage", order).alias("ErrorMessage"),
            )
        )

    def steps(self) -> DataFrame:
        """Step rows with DurationSec, the second boundaries between start and end."""
        seconds = F.unix_timestamp("EndTime") - F.unix_timestamp("StartTime")
        return self._read(self.step_path, STEP_EVENTS).select(
            "StepLogID",
            "RunID",
            "StepName",
            "StartTime",
            "EndTime",
            seconds.cast("int").alias("DurationSec"),
            "RowsProcessed",
            "Status",
            "ErrorMessage",
        )

    def violations(self) -> DataFrame:
        """(table_name, entry_id, problem): statuses off the list and steps without a run."""
        runs, steps = self.runs(), self.steps()
        bad_run = runs.filter(~F.col("Status").isin(*STATUSES)).select(
            F.lit("etl_run_log").alias("table_name"),
            F.col("RunID").alias("entry_id"),
            F.lit("unknown status").alias("problem"),
        )
        bad_step = steps.filter(~F.col("Status").isin(*STATUSES)).select(
            F.lit("etl_step_log").alias("table_name"),
            F.col("StepLogID").alias("entry_id"),
            F.lit("unknown status").alias("problem"),
        )
        orphan = steps.join(runs.select("RunID"), "RunID", "left_anti").select(
            F.lit("etl_step_log").alias("table_name"),
            F.col("StepLogID").alias("entry_id"),
            F.lit("no such run").alias("problem"),
        )
        return bad_run.unionByName(bad_step).unionByName(orphan)

    def constraint_report(self) -> DataFrame:
        """(table_name, problem, violations) for every constraint, also when kept."""
        constraints = literal_rows(
            self.spark,
            [
                ("etl_run_log", "unknown status"),
                ("etl_step_log", "unknown status"),
                ("etl_step_log", "no such run"),
            ],
            "table_name string, problem string",
        )
        return (
            constraints.join(self.violations(), ["table_name", "problem"], "left")
            .groupBy("table_name", "problem")
            .agg(F.count("entry_id").alias("violations"))
        )
