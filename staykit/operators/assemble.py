"""One row per account out of many per-account tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

KEY = "account_guid"


def union_features(tables: list[DataFrame], legacy: bool = False) -> DataFrame:
    """All features of every account that is in any of the tables, one row per account.

    The tables have the key and no other column in common; two rows of one table for an account are an error. They are laid
    over each other and folded by the key, which is a full outer join on the coalesced key with one shuffle instead of one
    per table. Only numbers and dates are folded, which hashing can do; texts join the folded rows where they lie.
    ``legacy`` joins each table on the key of the one before it and reports the first table's key only, so an account
    missing from one table falls apart.
    """
    if legacy:
        return _chain(tables, "full")
    known = [t.where(F.col(KEY).isNotNull()) for t in tables]
    names = [c for t in known for c in t.columns if c != KEY]
    texts = {i: [f.name for f in t.schema.fields if f.name != KEY and isinstance(f.dataType, T.StringType)] for i, t in enumerate(known)}
    flat = [t.drop(*texts[i]).withColumn(f"_rows{i}", F.lit(1)) for i, t in enumerate(known)]
    laid = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), flat)
    folded = laid.groupBy(KEY).agg(
        *[F.max(c).alias(c) for c in laid.columns if c != KEY and not c.startswith("_rows")],
        *[F.sum(f"_rows{i}").alias(f"_rows{i}") for i in range(len(known))],
    )
    most = F.greatest(F.lit(0), *[F.coalesce(f"_rows{i}", F.lit(0)) for i in range(len(known))])
    repeated = F.raise_error(F.concat(F.lit("more than one row of a table for account "), F.col(KEY))).cast("string")
    folded = folded.withColumn(KEY, F.when(most > 1, repeated).otherwise(F.col(KEY)))
    for i, table in enumerate(known):
        if texts[i]:
            folded = folded.join(table.select(KEY, *texts[i]), KEY, "left")
    return folded.select(KEY, *names)


def attach(spine: DataFrame, tables: list[DataFrame], legacy: bool = False) -> DataFrame:
    """The spine with the features of every table, NULL where an account is missing from one.

    Every table joins on the spine's key; the spine stays partitioned by it, so no link shuffles it again. ``legacy`` joins
    each table on the key of the one before it, so one gap blanks everything to its right.
    """
    if legacy:
        return _chain([spine, *tables], "left")
    return reduce(lambda left, table: left.join(table, KEY, "left"), tables, spine)


def _chain(tables: list[DataFrame], how: str) -> DataFrame:
    """Each table joined on the key of the one before it.

    All keys of a row that are not NULL are equal, so "the key before equals mine" is "the row's account equals mine, and
    the key before is there". Joined that way, rows with a gap stay with their account instead of meeting under NULL in one
    task, and a spine that is clustered by account is not shuffled again.
    """
    keyed = [t.withColumnRenamed(KEY, f"_key{i}") for i, t in enumerate(tables)]
    joined = keyed[0]
    for i, table in enumerate(keyed[1:], 1):
        # Only a full join has rows without the first key.
        account = F.col("_key0") if how == "left" else F.coalesce(*[F.col(f"_key{k}") for k in range(i)])
        joined = joined.join(table, (account == F.col(f"_key{i}")) & F.col(f"_key{i - 1}").isNotNull(), how)
    return joined.withColumnRenamed("_key0", KEY).drop(*[f"_key{i}" for i in range(1, len(tables))])


def one_per_account(accounts: DataFrame) -> DataFrame:
    """One row per account; where an account has several, the largest in column order."""
    others = [c for c in accounts.columns if c != KEY]
    return accounts.groupBy(KEY).agg(F.max(F.struct(*others)).alias("_row")).select(KEY, "_row.*")


def feature_matrix(
    spine: DataFrame,
    quality: DataFrame,
    viewing: DataFrame,
    calls: DataFrame,
    changes: DataFrame,
    promo: DataFrame,
    identity: DataFrame | None = None,
    search: DataFrame | None = None,
    week_number: str | None = None,
    legacy: bool = False,
) -> DataFrame:
    """The model input. Training uses the labels as spine and passes ``identity`` (active accounts) for the id columns;
    scoring uses the active accounts as spine. ``search`` is optional and placed before the calls."""
    tables = [quality, viewing, calls, changes, promo.drop("account_number", "operator")]
    if search is not None:
        tables.insert(2, search)
    if identity is not None:
        tables.insert(0, identity)
    if week_number is not None:
        spine = spine.withColumn("week_number", F.lit(week_number))
    return attach(spine, tables, legacy)
