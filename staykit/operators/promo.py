"""Promotion, dwelling, zip-code and trouble-call features from account history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from staykit.functions.keys import AccountCipher, Operator, billing_id
from staykit.functions.numbers import count_where
from staykit.functions.text import last_code
from staykit.functions.timeparts import as_date
from staykit.operators.population import with_account_guid

PROMO_COLUMNS = [
    "account_guid", "account_number", "operator", "count_zip_code_changes", "sum_truck_trouble_call",
    "total_promo_flag", "most_recent_dwelling", "most_recent_promo_flag",
]


def _prepared(history, operator, pattern, eligible, since, as_of, exclude_promo, cipher) -> DataFrame:
    """Eligible rows of one operator in their window, keyed, with what the profile adds up."""
    rows = history.where(eligible)
    if as_of is not None:
        rows = rows.where(F.col("snapshot_date") == as_date(as_of))
    elif since is not None:
        rows = rows.where(F.col("snapshot_date") >= as_date(since))
    flag = _code_flag(pattern)
    detail = F.coalesce(F.col("promotion_description") != exclude_promo, F.lit(False))
    system = F.col("system") if operator.with_division else F.lit(None).cast("string")
    prepared = rows.select(
        F.lit(operator.name).alias("operator"),
        "account_number",
        system.alias("system"),
        billing_id(F.col("account_number"), operator, cipher).alias("billing_id"),
        detail.alias("_detail"),
        F.when(detail, F.concat("zip_code", "zip_code_4")).alias("_zip"),
        F.when(detail, F.col("truck_call_count")).alias("_trouble"),
        F.when(detail, flag).alias("_promo"),
        "snapshot_date", "dwelling", flag.alias("_flag"),
    )
    return with_account_guid(prepared, "system", [operator])


def _code_flag(pattern: str) -> Column:
    return F.coalesce((last_code(F.col("promotion_description"), pattern) != "").cast("int"), F.lit(0))


def _totals() -> list[Column]:
    return [
        F.sum("_trouble").alias("sum_truck_trouble_call"),
        F.coalesce(F.sum("_promo"), F.lit(0)).alias("total_promo_flag"),
        count_where(F.col("_detail")).alias("_details"),
    ]


def _profile(totals: DataFrame, number: Column) -> DataFrame:
    return totals.where("_details > 0").select(
        "account_guid", number.alias("account_number"), "operator",
        "count_zip_code_changes", "sum_truck_trouble_call", "total_promo_flag",
        F.col("_newest.dwelling").alias("most_recent_dwelling"),
        F.col("_newest._flag").alias("most_recent_promo_flag"),
    )


def promo_profiles(
    histories: list[tuple[DataFrame, Operator, str, Column]], since=None, as_of=None, exclude_promo: str = "Unkown",
    cipher: AccountCipher | None = None,
) -> DataFrame:
    """Per account: distinct zip codes, summed trouble calls and rows with a matching promotion among the detail rows, and
    dwelling and promotion flag of its newest eligible row. ``histories`` lists, per operator, its history, itself, the
    pattern of its codes and the condition that makes a row eligible.

    Eligible rows are taken from ``since`` on, or from the ``as_of`` snapshot; detail rows are those whose promotion is
    known and not ``exclude_promo`` (spelled as in the data). An account without detail rows has no profile. The newest row
    is the first by (date, number, dwelling, promotion), so every account has one.

    All operators' rows are laid over each other and reduced in one aggregation, so each history is read and shuffled once.
    Zip codes are collected as a set per account, whose size is bounded by the zip codes it had.
    """
    rows = reduce(DataFrame.unionByName, [_prepared(h, o, p, e, since, as_of, exclude_promo, cipher) for h, o, p, e in histories])
    newest = F.max(F.struct("snapshot_date", "account_number", "dwelling", "_flag")).alias("_newest")
    zips = F.size(F.collect_set("_zip")).cast("long").alias("count_zip_code_changes")
    return _profile(rows.groupBy("account_guid", "operator").agg(zips, *_totals(), newest), F.col("_newest.account_number"))


def promo_profile(
    history: DataFrame,
    operator: Operator,
    pattern: str,
    eligible: Column,
    since=None,
    as_of=None,
    exclude_promo: str = "Unkown",
    cipher: AccountCipher | None = None,
    legacy: bool = False,
) -> DataFrame:
    """``promo_profiles`` of one operator.

    ``legacy`` groups by account number, takes all rows of the newest date, eligible or not, and repeats the totals for
    each distinct state.
    """
    if not legacy:
        return promo_profiles([(history, operator, pattern, eligible)], since, as_of, exclude_promo, cipher)
    prepared = _prepared(history, operator, pattern, eligible, since, as_of, exclude_promo, cipher)
    newest = F.struct("snapshot_date", "dwelling", "_flag").alias("_newest")
    dates = prepared.groupBy("account_number").agg(F.max("snapshot_date").alias("snapshot_date"))
    states = (
        history.select("account_number", "snapshot_date", "dwelling", _code_flag(pattern).alias("_flag"))
        .join(dates, ["account_number", "snapshot_date"])
        .select("account_number", newest)
        .distinct()
    )
    zips = F.count_distinct("_zip").alias("count_zip_code_changes")
    totals = prepared.groupBy("account_guid", "account_number", "operator").agg(zips, *_totals()).join(states, "account_number")
    return _profile(totals, F.col("account_number"))


def promo_profile_union(profiles: list[DataFrame]) -> DataFrame:
    """The operators' profiles one below the other."""
    union = profiles[0]
    for profile in profiles[1:]:
        union = union.unionByName(profile)
    return union.select(PROMO_COLUMNS)
