from __future__ import annotations

import pytest

from haulmart.contracts import contract
from haulmart.sources.feeds import RejectedRows, ingest, reject_counts, require_no_rejects

from tests.conftest import d, dec

HEADERS = {
    "staging_sales": "SalesID,DeliveryID,DateKey,ProductType,Region,UnitsSold,SalesAmount",
    "staging_exceptions": "ExceptionID,DeliveryID,ExceptionType,DateReported,ResolvedDate,"
    "ResolutionTimeHours,PriorityFlag,Region",
    "staging_routes": "RouteID,DriverID,PlannedStops,ActualStops,PlannedHours,ActualHours,Region",
}


@pytest.fixture
def load(spark, workspace, tmp_path):
    def run(table, lines):
        path = tmp_path / f"{table}.csv"
        path.write_text("\n".join([HEADERS[table], *lines]) + "\n", encoding="utf-8")
        return ingest(spark, str(path), contract(table), workspace)

    return run


def reasons(loaded):
    return {r.reject_reason: r.rejected_rows for r in reject_counts(loaded.rejects).collect()}


def test_good_rows_are_typed(load):
    loaded = load("staging_sales", ["1,10,2024-01-05,Böx,NE,3,30.5", "2,10,2024-01-06,Box,SW,1,7"])
    rows = {r.SalesID: tuple(r) for r in loaded.good.collect()}
    assert rows["1"] == ("1", 10, d("2024-01-05"), "Böx", "NE", 3, dec("30.50"))
    assert [f.dataType for f in loaded.good.schema] == [
        f.dataType for f in contract("staging_sales").schema()
    ]
    assert reasons(loaded) == {}
    require_no_rejects(loaded.rejects)


def test_every_bad_row_is_rejected_with_its_reason(load):
    loaded = load(
        "staging_sales",
        [
            "1,10,2024-01-05,Box,NE,3,30.00",
            "1,10,2024-01-05,Box,NE,3,30.00",
            "1,10,2024-01-05,Box,NE,3,30.00",
            "1,10,2024-01-05,Box,NE,4,30.00",
            "2,10,not a date,Box,NE,3,30.00",
            "3,10,2024-01-05,Box,NE,3",
            "4,10,2024-01-05,Box,NE,3,30.00,extra",
            f"5,10,2024-01-05,Box,{'NORTH-' * 9},3,30.00",
            "6,10,2024-01-05,Box,NE,,30.00",
            "7,10,2024-01-05,Box,NE,1.5,30.00",
            "8,10,2024-01-05,Box,NE,1,123456789.00",
        ],
    )
    assert [tuple(r) for r in loaded.good.collect()] == [
        ("1", 10, d("2024-01-05"), "Box", "NE", 3, dec("30.00"))
    ]
    assert reasons(loaded) == {
        "duplicate_key": 3,
        "unreadable_value": 3,
        "malformed_row": 2,
        "too_long": 1,
        "missing_value": 1,
    }
    with pytest.raises(RejectedRows) as failure:
        require_no_rejects(loaded.rejects)
    assert sum(failure.value.counts.values()) == 10


def test_flags_and_open_exceptions(load):
    loaded = load(
        "staging_exceptions",
        [
            "1,10,Delay,2024-01-05,,,1,NE",
            "2,10,Delay,2024-01-05,2024-01-06,1.50,0,NE",
            "3,10,Delay,2024-01-05,2024-01-06,-2,TRUE,NE",
            "4,10,Delay,2024-01-05,2024-01-06,1,maybe,NE",
        ],
    )
    rows = {r.ExceptionID: r for r in loaded.good.collect()}
    assert [rows[k].PriorityFlag for k in (1, 2, 3)] == [True, False, True]
    assert (rows[1].ResolvedDate, rows[1].ResolutionTimeHours) == (None, None)
    assert rows[3].ResolutionTimeHours == dec("-2.00")
    assert reasons(loaded) == {"unreadable_value": 1}


def test_route_keys_ignore_case_and_empty_drivers_are_rejected(load):
    loaded = load(
        "staging_routes",
        [
            "R1,Driver 1,10,9,5.7,6.8,NE",
            "r1,DRIVER 1 ,10,9,5.7,6.8,NE",
            "R1,,10,9,5.7,6.8,N.",
            'R2,"Driver 1",10,9,5.7,6.8,SE',
        ],
    )
    assert loaded.good.count() == 2
    assert '"Driver 1"' in {r.DriverID for r in loaded.good.collect()}
    assert reasons(loaded) == {"duplicate_key": 1, "missing_value": 1}


def test_empty_file(load):
    loaded = load("staging_sales", [])
    assert (loaded.good.count(), loaded.rejects.count()) == (0, 0)


def test_several_files_each_with_a_header(spark, workspace, tmp_path):
    folder = tmp_path / "sales"
    folder.mkdir()
    for i in (1, 2):
        (folder / f"{i}.csv").write_text(
            f"{HEADERS['staging_sales']}\n{i},10,2024-01-05,Box,NE,3,30.00\n"
        )
    loaded = ingest(spark, str(folder), contract("staging_sales"), workspace)
    assert loaded.good.count() == 2
    assert loaded.rejects.count() == 0
