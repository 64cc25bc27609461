"""Package and price changes per account, and the band of its price-change ratio among all accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from staykit.functions.numbers import BAND_POINTS, count_where, decile_band, ratio
from staykit.functions.timeparts import as_date

FLAGS = (
    "internet_package", "video_package", "other_package", "tv_stream_package", "stream_choice_package",
    "internet_price", "video_price", "total_price",
)
ACCOUNT_KEYS = ["billing_id", "operator", "system", "account_number"]
CHANGED = "change_event_date"


def _newest(changes: DataFrame) -> DataFrame:
    """The newest event of each account; on one date the larger flag, in the order of FLAGS, decides (NULL is smallest).

    The rank is limited to the first row before the shuffle, so a task passes on one narrow row per account."""
    order = Window.partitionBy("account_guid").orderBy(*[F.desc_nulls_last(c) for c in (CHANGED, *FLAGS)])
    ranked = changes.select("account_guid", CHANGED, *FLAGS).withColumn("_rank", F.row_number().over(order))
    return ranked.where("_rank = 1").select(
        "account_guid", F.col(CHANGED).alias("most_recent_change_date"), *[F.col(f).alias(f"most_recent_{f}_change") for f in FLAGS]
    )


def _counts() -> list[Column]:
    columns = []
    for flag in FLAGS:
        value = F.col(flag)
        columns += [
            F.sum(value).alias(f"{flag}_add_drop"),
            F.count(value).alias(f"{flag}_changes"),
            count_where(value == 1).alias(f"{flag}_adds"),
            count_where(value == -1).alias(f"{flag}_drop"),
        ]
    return columns


def _change_ratio() -> Column:
    """Share of an account's events that changed its total price."""
    return ratio(F.count("total_price"), F.count(CHANGED))


def change_latest(changes: DataFrame) -> DataFrame:
    """The newest value of each flag per account, from one scan instead of a self-join on the newest date."""
    return _newest(changes)


def change_counts(changes: DataFrame) -> DataFrame:
    """Per account and flag: net sum, number of changes, adds and drops; and the change ratio."""
    return changes.groupBy("account_guid").agg(*_counts(), _change_ratio().alias("change_ratio"))


def change_deciles(changes: DataFrame, as_of, keys=("account_guid",)) -> DataFrame:
    """One row over all accounts, events up to ``as_of`` only: ten percentile points, deviation and mean of the change
    ratio in percent. The points hold whole percents, so at most 101 values are kept."""
    percent = F.col("_ratio") * 100
    return (
        changes.where(F.col(CHANGED) <= as_date(as_of))
        .groupBy(*keys)
        .agg(_change_ratio().alias("_ratio"))
        .agg(
            F.percentile(F.round(percent).cast("int"), F.array(*[F.lit(p) for p in BAND_POINTS])).alias("points"),
            F.stddev_pop(percent).alias("std_dev"),
            F.avg(percent).alias("avg_price"),
        )
    )


def change_profile(changes: DataFrame, as_of, legacy: bool = False) -> DataFrame:
    """43 features per account: newest flags, counts, change ratio and its band.

    The one row of percentile points enters as a scalar subquery. ``legacy`` takes the literal form: newest events found
    by a join that loses accounts without a billing system and keeps ties, and a 0..1 ratio compared with points of the
    ratio in percent, one point too high.
    """
    if legacy:
        totals = changes.groupBy(*ACCOUNT_KEYS).agg(
            *_counts(), F.max(CHANGED).alias(CHANGED), _change_ratio().alias("total_count_int")
        )
        newest = changes.select(
            "account_guid", *ACCOUNT_KEYS, CHANGED, *[F.col(f).alias(f"most_recent_{f}_change") for f in FLAGS]
        ).distinct()
        profile = newest.join(totals, [*ACCOUNT_KEYS, CHANGED]).drop(*ACCOUNT_KEYS, CHANGED)
        points = change_deciles(changes, as_of, ACCOUNT_KEYS)
    else:
        totals = changes.groupBy("account_guid").agg(*_counts(), (_change_ratio() * 100).alias("total_count_int"))
        profile = totals.join(_newest(changes), "account_guid")
        points = change_deciles(changes, as_of)
    band = decile_band(F.col("total_count_int"), points.select("points").scalar(), first=1 if legacy else 0)
    profile = profile.select(
        "account_guid",
        *[f"most_recent_{flag}_change" for flag in FLAGS],
        *[f"{flag}_{kind}" for flag in FLAGS for kind in ("add_drop", "changes", "adds", "drop")],
        F.col("total_count_int").alias("total_count_int_100_day"),
        (F.col("total_count_int") / 100).alias("total_count_int_day"),
        band.alias("percentile_score_price"),
    )
    return profile.distinct() if legacy else profile
