"""Exact distinct counts as bitmaps over dictionary ids: one pass for many columns, and counts that days can be merged into.

Each value of a column has a small number in a dictionary that only grows. The values a group has seen are then bits: of a
few 64-bit words where the dictionary is small, of Spark's 32,768-bit bitmaps where it is not. Words and bitmaps of two sets
of rows are or-ed to those of their union, which counts are not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from staykit.operators.ranking import exact_rank
from staykit.sources.tables import Workspace, read_table, rebuild_table

WORD = 64
# Up to this many words per column; larger dictionaries use bitmaps.
MOST_WORDS = 16
BITMAP = 32768


def column_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct (column, value) pairs, values as text, without NULLs."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).where("value IS NOT NULL").distinct()


class Dictionary:
    """Ids from 0 per column, in a folder. Values that are there keep their id; new ones get the next."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        """``column``, ``value``, ``id``."""
        return read_table(self.spark, self.path)

    def extend(self, df: DataFrame, columns: list[str], work: Workspace) -> Dictionary:
        """Adds the values of ``columns`` that are new, in the order of the text."""
        found, empty = column_values(df, columns), self.spark.createDataFrame([], "column string, value string, id long")
        try:
            known = self.table()
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            known = empty
        new = work.store(found.join(known, ["column", "value"], "left_anti"), "new-values")
        ranked = exact_rank(new, [F.col("column"), F.col("value")], work, "place")
        # One row per column.
        before = known.groupBy("column").agg((F.max("id") + 1).alias("_used"))
        first = ranked.groupBy("column").agg(F.min("place").alias("_first"))
        bases = F.broadcast(first.join(before, "column", "left"))
        numbered = ranked.join(bases, "column").select(
            "column", "value", (F.coalesce("_used", F.lit(0)) + F.col("place") - F.col("_first")).cast("long").alias("id"))
        rebuild_table(known.unionByName(numbered), self.path)
        return self

    def sizes(self, columns: list[str]) -> dict[str, int]:
        """Number of ids per column."""
        counted = {r["column"]: r["n"] for r in self.table().groupBy("column").agg((F.max("id") + 1).alias("n")).collect()}
        return {c: counted.get(c, 0) for c in columns}

    def with_ids(self, df: DataFrame, columns: list[str]) -> DataFrame:
        """``df`` with ``_id_<column>`` for each column. Dictionaries are joined like any table: broadcast where small."""
        known = self.table()
        for c in columns:
            own = known.where(F.col("column") == c).select(F.col("value").alias(f"_value_{c}"), F.col("id").alias(f"_id_{c}"))
            df = df.join(own, F.col(c).cast("string") == F.col(f"_value_{c}"), "left").drop(f"_value_{c}")
        return df


def _parts(column: str, size: int) -> list[str]:
    """Names of a column's words or bitmaps."""
    words = -(-size // WORD)
    if words <= MOST_WORDS:
        return [f"{column}_word{i}" for i in range(words)]
    return [f"{column}_map{i}" for i in range(-(-size // BITMAP))]


def bitmap_columns(sizes: dict[str, int]) -> list[Column]:
    """Aggregates that collect the ids of each column (``_id_<column>``)."""
    found = []
    for c, size in sizes.items():
        i = F.col(f"_id_{c}")
        for number, name in enumerate(_parts(c, size)):
            if "_word" in name:
                bit = F.call_function("shiftleft", F.lit(1).cast("long"), (i % WORD).cast("int"))
                collected = F.bit_or(F.when(F.floor(i / WORD) == number, bit))
            else:
                inside = F.when(F.floor(i / BITMAP) == number, i % BITMAP)
                # A position that is NULL sets no bit.
                collected = F.bitmap_construct_agg(inside)
            found.append(collected.alias(name))
    return found


def merged_columns(sizes: dict[str, int]) -> list[Column]:
    """Aggregates that put rows of ``bitmap_columns`` together."""
    return [(F.bit_or(n) if "_word" in n else F.bitmap_or_agg(n)).alias(n) for c, size in sizes.items() for n in _parts(c, size)]


def distinct_count(column: str, size: int) -> Column:
    """Number of values from the column's words or bitmaps."""
    counts = [
        F.coalesce(F.bit_count(n) if "_word" in n else F.bitmap_count(n), F.lit(0)).cast("long") for n in _parts(column, size)
    ]
    return reduce(lambda a, b: a + b, counts, F.lit(0).cast("long"))


def distinct_counts(df: DataFrame, keys: list[str], columns: dict[str, str], dictionary: Dictionary) -> DataFrame:
    """``keys`` and, for each column, its number of distinct values under the given name.

    One aggregation of the rows, combined before the shuffle, whatever the number of columns. Every value must be in the
    dictionary. NULLs are not counted.
    """
    sizes = dictionary.sizes(list(columns))
    coded = dictionary.with_ids(df, list(columns))
    collected = coded.groupBy(*keys).agg(*bitmap_columns(sizes)) if sum(sizes.values()) else coded.select(*keys).distinct()
    return collected.select(*keys, *[distinct_count(c, sizes[c]).alias(name) for c, name in columns.items()])
