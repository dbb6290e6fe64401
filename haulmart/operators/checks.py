"""Quality checks as data, and the report and gate built from them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmart.functions.columns import count_if, flag
from haulmart.operators.integrity import orphan_count
from haulmart.operators.keys import duplicate_groups
from haulmart.operators.shape import literal_rows, long_form, looked_up

Tables = Callable[[str], DataFrame]

FAIL, WARN = "fail", "warn"


def parts_of(tables: Tables, name: str) -> list[DataFrame]:
    """A table as the parts that it is stored in, where the lookup knows them."""
    parts = getattr(tables, "parts", None)
    return parts(name) if parts else [tables(name)]


@dataclass(frozen=True)
class Check:
    """Counts bad rows; any bad row is a failure."""

    key: str
    title: str

    def result(self, tables: Tables) -> DataFrame:
        """One row: check_name, bad_rows."""
        return self.bad_rows(tables).select(
            F.lit(self.title).alias("check_name"), F.col("bad_rows").cast("long").alias("bad_rows")
        )

    def bad_rows(self, tables: Tables) -> DataFrame:
        raise NotImplementedError


@dataclass(frozen=True)
class AggregateCheck(Check):
    """A check that one aggregate over one table answers."""

    table: str
    measure: Callable[[], Column]

    def bad_rows(self, tables: Tables) -> DataFrame:
        return tables(self.table).agg(self.measure().alias("bad_rows"))


@dataclass(frozen=True)
class OrphanCheck(Check):
    child: str
    child_column: str
    parent: str
    parent_column: str

    def bad_rows(self, tables: Tables) -> DataFrame:
        return orphan_count(
            parts_of(tables, self.child), self.child_column, parts_of(tables, self.parent), self.parent_column
        )


@dataclass(frozen=True)
class DuplicateKeyCheck(Check):
    table: str
    keys: tuple[str, ...]

    def bad_rows(self, tables: Tables) -> DataFrame:
        groups = duplicate_groups(tables(self.table), self.keys)
        return groups.agg(F.count(F.lit(1)).alias("bad_rows"))


@dataclass(frozen=True)
class QueryCheck(Check):
    """A check with its own plan that ends in one row ``bad_rows``."""

    plan: Callable[[Tables], DataFrame]

    def bad_rows(self, tables: Tables) -> DataFrame:
        return self.plan(tables)


@dataclass(frozen=True)
class CheckSet:
    """Several checks that one plan answers with rows (check_id, bad_rows)."""

    titles: Mapping[str, str]
    plan: Callable[[Tables], DataFrame]


def not_empty(key: str, title: str, table: str) -> AggregateCheck:
    return AggregateCheck(key, title, table, lambda: flag(F.count(F.lit(1)) == 0))


def row_check(key: str, title: str, table: str, bad: Callable[[], Column]) -> AggregateCheck:
    return AggregateCheck(key, title, table, lambda: count_if(bad()))


def check_report(
    layer: str,
    checks: Iterable[Check | CheckSet],
    tables: Tables,
    severities: Mapping[str, str] | None = None,
    default_severity: str = FAIL,
    enabled: bool = True,
) -> DataFrame:
    """One row per check: layer, check_id, check_name, bad_rows, severity, status.

    Every check counts; the report never stops at the first failure. The
    aggregate checks of a table share one pass over it.
    """
    severities = severities or {}
    checks = list(checks)
    titles: dict[str, str] = {}
    for check in checks:
        titles.update(check.titles if isinstance(check, CheckSet) else {check.key: check.title})
    counted = _counted(checks, tables) if enabled else _unread(titles)
    check_id, bad_rows = F.col("check_id"), F.col("bad_rows")
    severity = looked_up("check_id", {k: severities.get(k, default_severity) for k in titles})
    status = (
        F.when(F.lit(not enabled), F.lit("SKIPPED"))
        .when(bad_rows == 0, F.lit("PASS"))
        .when(severity == FAIL, F.lit("FAIL"))
        .otherwise(F.lit("WARN"))
    )
    return counted.select(
        F.lit(layer).alias("layer"),
        check_id,
        looked_up("check_id", titles).alias("check_name"),
        "bad_rows",
        severity.alias("severity"),
        status.alias("status"),
    )


def _counted(checks: Iterable[Check | CheckSet], tables: Tables) -> DataFrame:
    """(check_id, bad_rows) of every check."""
    by_table: dict[str, list[AggregateCheck]] = {}
    parts: list[DataFrame] = []
    for check in checks:
        if isinstance(check, CheckSet):
            parts.append(check.plan(tables))
        elif isinstance(check, AggregateCheck):
            by_table.setdefault(check.table, []).append(check)
        else:
            parts.append(check.bad_rows(tables).withColumn("check_id", F.lit(check.key)))
    for table, group in by_table.items():
        totals = tables(table).agg(*[c.measure().alias(c.key) for c in group])
        parts.append(long_form(totals, [c.key for c in group], "check_id", "bad_rows"))
    return reduce(
        DataFrame.unionByName,
        [p.select("check_id", F.col("bad_rows").cast("long").alias("bad_rows")) for p in parts],
    )


def _unread(titles: Mapping[str, str]) -> DataFrame:
    """One row per check without a count; no table is asked for."""
    rows = [(k, None) for k in titles]
    return literal_rows(SparkSession.active(), rows, "check_id string, bad_rows bigint")


class GateFailed(Exception):
    """A layer's checks found bad rows; the next layer must not load."""

    def __init__(self, code: int, layer: str, failures: list[tuple[str, int]]):
        self.code = code
        self.layer = layer
        self.failures = failures
        listing = "; ".join(f"{name} = {n}" for name, n in failures)
        super().__init__(f"{code}: {layer} validation failed, {len(failures)} check(s): {listing}")


def judge(rows: list, code: int, layer: str) -> None:
    """Raise if any report row of severity ``fail`` has bad rows."""
    failures = [(r["check_name"], r["bad_rows"]) for r in rows if r["status"] == "FAIL"]
    if failures:
        raise GateFailed(code, layer, failures)


def enforce(report: DataFrame, code: int, layer: str) -> list:
    """Raise if any check of severity ``fail`` found bad rows; else return the report rows."""
    rows = report.collect()  # one row per declared check
    judge(rows, code, layer)
    return rows
