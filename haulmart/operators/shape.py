"""Reshaping of one-row totals and small literal frames.

Wide expressions are handed over as SQL text: one call to the JVM instead of
several for every column.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return f"`{name}`"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def long_form(
    totals: DataFrame, names: Sequence[str], name: str, value: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Turn the columns ``names`` into rows (name, value)."""
    return totals.unpivot([*keep], [*names], name, value)


def looked_up(key: str, mapping: Mapping[str, str]) -> Column:
    """Value of a small constant mapping for the column ``key``."""
    pairs = ", ".join(text_literal(x) for item in mapping.items() for x in item)
    return F.expr(f"map({pairs})[{quoted(key)}]")


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few driver-side rows as a one-partition frame, passed as one JSON literal."""
    struct = T._parse_datatype_string(schema)
    records = [dict(zip(struct.fieldNames(), row)) for row in rows]
    text = json.dumps(records, default=lambda v: v.isoformat())
    parsed = F.from_json(F.lit(text), T.ArrayType(struct))
    return spark.range(0, 1, 1, 1).select(F.inline(parsed))


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
