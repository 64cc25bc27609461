"""Exact positions in a total order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from staykit.sources.tables import Workspace

# ``monotonically_increasing_id`` holds the number of the partition above this bit, the row in it below.
_ROW_BITS = 33


def exact_rank(df: DataFrame, order: list[Column], work: Workspace, name: str = "rank") -> DataFrame:
    """``df`` with ``name``: 1 for the first row in ``order``, 2 for the next, and so on, each number once.

    The rows are range-partitioned and sorted, so each task numbers its own; what comes before a task's rows is a sum over
    the sizes of the partitions. Rows that ``order`` does not tell apart lie in one task, so end it with a key; equal rows
    are numbered in any order. A column called ``name`` gives way; an empty table stays empty. ``df`` is read twice (once
    to find the ranges): store it first where that is costly.
    """
    others = [c for c in df.columns if c != name]
    placed = work.store(df.orderBy(*order).select(*others, F.monotonically_increasing_id().alias("_at")), name)
    part = F.shiftrightunsigned("_at", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per task of the sort, so never more than there are shuffle partitions.
    offsets = F.broadcast(sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    row = F.col("_at").bitwiseAND(F.lit(2**_ROW_BITS - 1))
    return placed.join(offsets, part == F.col("_part")).select(*others, (F.col("_before") + row + 1).alias(name))
