from __future__ import annotations

import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql.types import StringType

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from haulmart.contracts import contract  # noqa: E402
from haulmart.session import local_session  # noqa: E402
from haulmart.sources.workspace import Workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, memory="4g")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    return session


@pytest.fixture(scope="session")
def workspace(spark, tmp_path_factory):
    return Workspace(spark, str(tmp_path_factory.mktemp("work")))


@pytest.fixture(scope="session")
def staged(spark):
    """Build a staging frame from tuples in contract order."""

    def build(table: str, rows: list[tuple]):
        schema = contract(table).schema()
        text = [isinstance(f.dataType, StringType) for f in schema.fields]
        typed = [
            tuple(str(v) if t and v is not None else v for v, t in zip(row, text)) for row in rows
        ]
        return spark.createDataFrame(typed, schema).coalesce(1)

    return build


def d(text: str) -> date:
    return date.fromisoformat(text)


def dec(text: str) -> Decimal:
    return Decimal(text)


SALES = [
    (1, 10, d("2024-01-05"), "  box ", "ne", 3, dec("30.00")),
    (2, 10, d("2024-01-05"), "Box", "NE", 1, dec("10.00")),
    (3, 11, d("2024-02-07"), "PALLET", "SW", 2, dec("25.50")),
]
DELIVERIES = [
    (10, "r1", "Driver 1", "ne", "Air", d("2024-01-09"), d("2024-01-07"), "Delivered", True),
    (11, "R1", "Driver 2", "SW", "ground", d("2024-02-10"), d("2024-02-10"), " delivered ", False),
]
ROUTES = [
    ("R1", "Driver 1", 10, 9, dec("5.70"), dec("6.80"), "NE"),
    ("R2", "driver 2", 8, 9, dec("6.00"), dec("5.00"), "SW"),
]
EXCEPTIONS = [
    (100, 10, "Delay", d("2024-01-08"), d("2024-01-06"), dec("-5.00"), True, "ne"),
    (101, 11, "Damage", d("2024-02-11"), None, None, False, "sw"),
    (102, 11, "damage ", d("2024-02-11"), d("2024-02-12"), None, False, "sw"),
]
STAGED_ROWS = {
    "staging_sales": SALES,
    "staging_deliveries": DELIVERIES,
    "staging_routes": ROUTES,
    "staging_exceptions": EXCEPTIONS,
}


@pytest.fixture(scope="session")
def small_tables(spark, staged):
    """Lookup over small valid staging frames with the clean views on top."""
    from haulmart.plans.clean import CLEAN_VIEWS

    def build(**changed):
        frames = {t: staged(t, rows) for t, rows in STAGED_ROWS.items()}
        frames.update(changed)

        def lookup(name: str):
            if name in frames:
                return frames[name]
            source, plan, _ = CLEAN_VIEWS[name]
            return plan(frames[source])

        return lookup

    return build
