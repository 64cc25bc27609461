"""From a feature matrix to a numeric model frame."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, functions as F, types as T

from staykit.functions.numbers import to_number
from staykit.operators.ranking import exact_rank
from staykit.sources.tables import Workspace

SPLITS = (("train", 0.8), ("valid", 0.1), ("test", 0.1))


# Types whose values are the same double by way of their text. Floats and decimals are not.
EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType)


def coerce_numeric(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Every column but ``keep`` as a double; what is no number becomes 0."""
    return df.select(
        *[
            F.col(f.name) if f.name in keep
            else to_number(F.col(f.name), isinstance(f.dataType, T.BooleanType), isinstance(f.dataType, EXACT)).alias(f.name)
            for f in df.schema.fields
        ]
    )


def feature_names(df: DataFrame, exclude: list[str]) -> list[str]:
    """Column names that are not excluded, in alphabetical order."""
    return sorted(set(df.columns) - set(exclude))


def model_frame(df: DataFrame, features: list[str], label: str = "churn", keep: list[str] = ()) -> DataFrame:
    """``label`` as a double, the features as one vector, and the columns to keep."""
    assembled = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    return assembled.select(*keep, F.col(label).cast("double").alias("label"), "features")


def bucket(key: Column, seed: int = 0) -> Column:
    """A number in [0, 1) from a key: the first 32 bits of an MD5 over seed and key. It depends on nothing else, so an
    account lands in the same part on every run, every engine and every cluster."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / 2**32


def hash_split(df: DataFrame, key: str, seed: int = 0, parts=SPLITS, output: str = "split") -> DataFrame:
    """Names the part of each row: disjoint parts of the given shares, without a sort or a shuffle."""
    place, reached, name = bucket(F.col(key), seed), 0.0, F
    for label, share in parts[:-1]:
        reached += share
        name = name.when(place < reached, label)
    return df.withColumn(output, name.otherwise(parts[-1][0]))


def exact_split(
    df: DataFrame, key: str, work: Workspace, seed: int = 0, parts=SPLITS, output: str = "split"
) -> DataFrame:
    """Names the part of each row: disjoint parts of exactly the shares' numbers of rows, each rounded (halves to the even
    number), the last part taking what is left.

    Rows are ordered by ``bucket`` and, where equal, by the key, and numbered without a window over all of them
    (``exact_rank``). Rows of one key may lie in different parts; with distinct keys a row's part depends on nothing but
    the keys there are.
    """
    ranked = exact_rank(df.withColumn("_place", bucket(F.col(key), seed)), [F.col("_place"), F.col(key)], work, "_rank")
    total, reached, name = df.count(), 0, F
    for label, share in parts[:-1]:
        reached += round(share * total)
        name = name.when(F.col("_rank") <= reached, label)
    return ranked.withColumn(output, name.otherwise(parts[-1][0])).drop("_place", "_rank")


OTHER = "(other)"


def index_categories(df: DataFrame, columns: list[str], max_bins: int = 32) -> DataFrame:
    """Text columns as numbers of categories that tree models split by sets, not by order.

    A column's most frequent values get the numbers 0, 1 and so on (ties in code-point order); the values beyond the first
    ``max_bins`` - 1, and NULL, are one last category. Only those names reach the driver. The columns carry their categories
    as metadata, which ``model_frame`` passes on; a model needs a ``maxBins`` of at least the number of categories.
    """
    for column in columns:
        text = F.col(column).cast("string")
        counted = df.where(text.isNotNull()).groupBy(text.alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
        top = counted.orderBy(F.desc("_n"), "_value").limit(max(0, max_bins - 1)).collect()
        names = [r["_value"] for r in sorted(top, key=lambda r: (-r["_n"], r["_value"]))]
        numbers = df.sparkSession.createDataFrame([(n, float(i)) for i, n in enumerate(names)], "_value string, _number double")
        other = OTHER
        while other in names:
            other += "*"
        attributes = {"ml_attr": {"type": "nominal", "name": column, "vals": [*names, other]}}
        number = F.coalesce("_number", F.lit(float(len(names)))).alias(column, metadata=attributes)
        # At most ``max_bins`` rows.
        joined = df.join(F.broadcast(numbers), text == F.col("_value"), "left")
        df = joined.select(*[number if c == column else c for c in df.columns])
    return df


def constant_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns with at most one distinct value, with their number of NULLs, from one pass of minima and maxima."""
    stats = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max, F.count)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            (F.col("_rows") - F.col(f"count_{c}")).alias("nulls"),
            F.coalesce(F.col(f"min_{c}") == F.col(f"max_{c}"), F.lit(True)).alias("constant"),
        )
        for c in columns
    ]
    return stats.select(F.inline(F.array(*entries))).where("constant").select("column_name", "nulls")


def correlations(df: DataFrame, columns: list[str], at_least: float = 0.0) -> DataFrame:
    """Pairs of columns with their Pearson correlation. The cluster reduces the rows to a columns x columns matrix; only
    that reaches the driver."""
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(df).select("features")
    matrix = Correlation.corr(vectors, "features").head()[0].toArray()
    pairs = [
        (columns[i], columns[j], float(matrix[i, j]))
        for i in range(len(columns))
        for j in range(i + 1, len(columns))
        if abs(matrix[i, j]) >= at_least
    ]
    return df.sparkSession.createDataFrame(pairs, "first_column string, second_column string, correlation double")
