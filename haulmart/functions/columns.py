"""Column expressions. All built-in, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The calendar range a sales date must lie in (inclusive).
FIRST_VALID_DATE = "1900-01-01"
LAST_VALID_DATE = "2100-12-31"


def standard_text(c: Column) -> Column:
    """Upper-case text without surrounding spaces."""
    return F.upper(F.trim(c))


def match_key(c: Column) -> Column:
    """Comparison form of a code: case and trailing spaces do not matter."""
    return F.upper(F.rtrim(c))


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def count_if(condition: Column) -> Column:
    """Rows for which the condition is true; 0 over no rows."""
    return F.count_if(condition)


def null_cells(*columns: str) -> Column:
    """Null values summed over several columns; 0 over no rows."""
    return F.expr(" + ".join(f"count_if(`{c}` IS NULL)" for c in columns))


def any_null(*columns: str) -> Column:
    return F.expr(" OR ".join(f"`{c}` IS NULL" for c in columns))


def none_null(*columns: str) -> Column:
    return ~any_null(*columns)


def date_key(d: Column) -> Column:
    """YYYYMMDD as an int, by arithmetic rather than by formatting text."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def whole_part(number: Column, divisor: int) -> Column:
    """Whole-number quotient of an int; subtracting the remainder makes it exact."""
    return ((number - number % divisor) / divisor).cast("int")


def date_of_key(k: Column) -> Column:
    """Inverse of ``date_key``; spares a lookup in the date dimension."""
    return F.make_date(whole_part(k, 10000), whole_part(k % 10000, 100), k % 100)


def month_of_key(k: Column) -> Column:
    """YYYYMM of a YYYYMMDD key."""
    return whole_part(k, 100)


def in_calendar(d: Column) -> Column:
    return d.between(F.lit(FIRST_VALID_DATE).cast("date"), F.lit(LAST_VALID_DATE).cast("date"))


def week_of_year(d: Column) -> Column:
    """Sunday-start week number in which 1 January always falls in week 1."""
    first_weekday = F.dayofweek(F.trunc(d, "year"))
    return (F.floor((F.dayofyear(d) + first_weekday - 2) / 7) + 1).cast("int")


def decimal_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient rounded half up to 4 digits, empty for a zero denominator.

    The operands are widened so the quotient carries 19 digits before the
    final rounding. With less a quotient just under a tie is first rounded
    onto the tie and then up.
    """
    safe = F.nullif(denominator, F.lit(0)).cast("decimal(16,2)")
    return F.round(numerator.cast("decimal(18,2)") / safe, 4).cast("decimal(10,4)")


def decimal_average(c: Column) -> Column:
    """Exact mean of a decimal column, rounded to 6 digits."""
    return (F.sum(c) / F.nullif(F.count(c), F.lit(0))).cast("decimal(38,6)")


def integer_average(name: str) -> Column:
    """Mean of an integer column, cut to an integer; exact, as it divides whole numbers."""
    return F.expr(f"CAST(sum(`{name}`) DIV nullif(count(`{name}`), 0) AS INT)")


def share(numerator: Column, denominator: Column) -> Column:
    """Quotient of two counts or sums as a double, empty for zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent_of(part: Column, whole: Column) -> Column:
    """part / whole in percent, two digits, empty over no rows."""
    scaled = part.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
    return (scaled / F.nullif(whole, F.lit(0)).cast("decimal(20,0)")).cast("decimal(10,2)")
