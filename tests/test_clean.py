from __future__ import annotations

from haulmart.plans.clean import (
    clean_deliveries,
    clean_exceptions,
    clean_routes,
    clean_sales,
)

from tests.conftest import d, dec


def by_key(df):
    return {r[0]: r for r in df.collect()}


def test_sales_dates_are_checked_and_bad_ones_kept(staged):
    rows = by_key(
        clean_sales(
            staged(
                "staging_sales",
                [
                    (1, 1, d("1899-12-31"), "a", "x", 1, dec("1.00")),
                    (2, 1, d("2101-01-01"), "a", "x", 1, dec("1.00")),
                    (3, 1, d("1900-01-01"), "a", "x", 1, dec("1.00")),
                    (4, 1, d("2100-12-31"), "a", "x", 1, dec("1.00")),
                ],
            )
        )
    )
    assert [(rows[k].DateKey, rows[k].IsBadDateKey) for k in ("1", "2")] == [(None, 1)] * 2
    assert [rows[k].IsBadDateKey for k in ("3", "4")] == [0, 0]
    assert rows["4"].DateKey == d("2100-12-31")


def test_sales_filter_and_text(staged):
    rows = by_key(
        clean_sales(
            staged(
                "staging_sales",
                [
                    (1, 1, None, "a", "x", 1, dec("1.00")),
                    (2, 1, d("2024-01-01"), "a", "x", 0, dec("1.00")),
                    (3, 1, d("2024-01-01"), "a", "x", 1, dec("-1.00")),
                    (4, None, d("2024-01-01"), "a", "x", 1, dec("1.00")),
                    (5, 1, d("2024-01-01"), "  box ", " ne", 1, dec("1.00")),
                ],
            )
        )
    )
    assert list(rows) == ["5"]
    assert (rows["5"].ProductType, rows["5"].Region) == ("BOX", "NE")


def test_deliveries(staged):
    late, planned = d("2024-01-09"), d("2024-01-07")
    rows = by_key(
        clean_deliveries(
            staged(
                "staging_deliveries",
                [
                    (1, "r", "x", "ne", "air", late, planned, "Delivered", True),
                    (2, "r", "x", "ne", "air", planned, planned, " delivered ", False),
                    (3, "r", "x", "ne", "air", late, None, "Delivered", True),
                    (4, "r", "x", "ne", "air", planned, late, "Delivered", None),
                    (5, "r", None, "ne", "air", planned, late, "Delivered", None),
                ],
            )
        )
    )
    assert sorted(rows) == [1, 2, 4]
    assert [rows[k].DeliveryStatus for k in (1, 2, 4)] == ["LATE", "DELIVERED", "DELIVERED"]
    assert [rows[k].PriorityFlag for k in (1, 2, 4)] == [1, 0, 0]
    assert rows[1].RouteID == "r"  # codes keep their spelling


def test_exceptions(staged):
    day = d("2024-03-10")
    rows = by_key(
        clean_exceptions(
            staged(
                "staging_exceptions",
                [
                    (1, 1, "a", day, d("2024-03-08"), dec("7.00"), True, "x"),
                    (2, 1, "a", day, None, None, True, "x"),
                    (3, 1, "a", day, d("2024-03-12"), dec("-5.00"), True, "x"),
                    (4, 1, "a", day, d("2024-03-11"), None, True, "x"),
                    (5, 1, "a", day, d("2024-03-08"), dec("-5.00"), True, "x"),
                    (6, 1, "a", day, None, dec("-5.00"), None, "x"),
                    (7, 1, "a", day, day, dec("1.50"), True, "x"),
                    (8, 1, "a", None, day, dec("1.50"), True, "x"),
                ],
            )
        )
    )
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 7]
    got = {
        k: (r.ResolvedDate, r.IsDateCorrected, r.ResolutionTimeHours) for k, r in rows.items()
    }
    assert got == {
        1: (day, 1, dec("7.00")),
        2: (None, 0, None),
        3: (d("2024-03-12"), 0, dec("48.00")),
        4: (d("2024-03-11"), 0, dec("24.00")),
        5: (day, 1, dec("0.00")),
        6: (None, 0, None),
        7: (day, 0, dec("1.50")),
    }
    assert rows[6].PriorityFlag == 0


def test_routes(staged):
    rows = by_key(
        clean_routes(
            staged(
                "staging_routes",
                [
                    ("A", "x", 10, 12, dec("5.70"), dec("6.80"), "ne"),
                    ("B", "x", 0, 12, dec("5.70"), dec("6.80"), "ne"),
                    ("C", "x", 10, 12, dec("0.00"), dec("6.80"), "ne"),
                    ("D", "x", 10, 12, dec("5.70"), dec("-1.00"), "ne"),
                ],
            )
        )
    )
    assert list(rows) == ["A"]
    assert (rows["A"].EfficiencyRatio, rows["A"].StopVariance) == (dec("1.1930"), 2)


def test_ratio_just_below_a_tie_is_not_rounded_up(staged):
    # 900.02 / 990.11 style quotients: compare against exact whole-number rounding.
    pairs = [(a, b) for b in range(99901, 99999, 7) for a in range(50000, 50200, 3)]
    rows = [
        (str(i), "x", 1, 1, dec(b) / 100, dec(a) / 100, "n") for i, (a, b) in enumerate(pairs)
    ]
    got = {r.RouteID: r.EfficiencyRatio for r in clean_routes(staged("staging_routes", rows)).collect()}
    for i, (a, b) in enumerate(pairs):
        assert got[str(i)] == dec((20000 * a + b) // (2 * b)) / 10000


def test_cleaning_text_twice_changes_nothing(staged):
    row = [(1, 1, d("2024-01-01"), "  box ", " ne ", 1, dec("1.00"))]
    once = clean_sales(staged("staging_sales", row))
    twice = clean_sales(once.drop("IsBadDateKey"))
    assert once.collect() == twice.collect()
