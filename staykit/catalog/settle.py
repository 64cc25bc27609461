"""Rounding shared by queries and checks.

Sums of doubles differ in their last digits with the order of the rows. Results are rounded by their size, after a small
shift, because means of values with few decimals often lie exactly on a rounding tie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# (below this size, shift, digits); larger values are rounded to whole numbers.
STEPS = ((1e3, 1e-9, 6), (1e9, 1e-5, 3))
WHOLE_SHIFT = 0.1


def settle(df: DataFrame) -> DataFrame:
    """Doubles rounded, dates as text."""
    columns = []
    for f in df.schema.fields:
        value = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            rounded = F
            for below, shift, digits in STEPS:
                rounded = rounded.when(F.abs(value) < below, F.round(value + shift, digits))
            value = rounded.otherwise(F.round(value + WHOLE_SHIFT, 0))
        elif isinstance(f.dataType, T.DateType):
            value = value.cast("string")
        columns.append(value.alias(f.name))
    return df.select(*columns)


def _rounded_sql(c: str) -> str:
    whens = " ".join(f"WHEN abs({c}) < {below:.0f} THEN round({c} + CAST({shift:.9f} AS DOUBLE), {digits})" for below, shift, digits in STEPS)
    return f"CASE {whens} ELSE round({c} + CAST({WHOLE_SHIFT} AS DOUBLE), 0) END AS {c}"


def settle_sql(sql: str, doubles=(), dates=()) -> str:
    """The same on a query text."""
    changes = [_rounded_sql(c) for c in doubles] + [f"CAST({c} AS VARCHAR) AS {c}" for c in dates]
    return f"SELECT * REPLACE ({', '.join(changes)}) FROM ({sql})" if changes else sql
