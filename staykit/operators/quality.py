"""Playback-quality features: an account's own scores, and its scores against everybody's."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from staykit.functions.numbers import count_where, fixed_point, joined_parts, or_zero, ratio, whole_parts, wide
from staykit.functions.timeparts import DAY_PARTS, DAY_PARTS_LEGACY, day_part, moment, week_part

SCORE, WATCHED, DAY = "mos_score", "watch_time_ms", "activity_date"
SCORE_STEPS = 1_000_000


def account_quality(sessions: DataFrame, legacy: bool = False, normalised: bool = False) -> DataFrame:
    """Active days, 10th/90th percentile of the score in hundredths, and plain and watch-weighted mean and deviation.

    "Weighted" is the mean of score times watch time, not divided by the total watch time; ``normalised`` adds the divided
    form as ``weighted_mean_norm``. ``legacy`` leaves each percentile in a one-element array. The percentiles see one row per account
    and whole-number score, so their state is bounded by the number of distinct scores and not by the sessions.
    """
    weighted = F.col(SCORE) * F.col(WATCHED)
    watched_total = F.sum(F.when(F.col(SCORE).isNotNull(), F.col(WATCHED)))
    own = sessions.groupBy("account_guid").agg(
        F.count_distinct(DAY).alias("active_day_cnt"),
        or_zero(F.stddev_pop(SCORE)).alias("mos_std_dev_acct"),
        or_zero(F.avg(SCORE)).alias("avg_mos_acct"),
        or_zero(F.avg(weighted)).alias("weighted_avg_mos_acct"),
        or_zero(F.stddev_pop(weighted)).alias("weighted_std_dev_acct"),
        *([ratio(F.sum(weighted), watched_total).alias("weighted_mean_norm")] if normalised else []),
    )
    hundredths = (
        sessions.groupBy("account_guid", F.round(F.col(SCORE) * 100).cast("int").alias("_score"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy("account_guid")
        .agg(F.percentile("_score", F.array(F.lit(0.1), F.lit(0.9)), F.col("_rows")).alias("_points"))
    )
    low, high = (F.get("_points", F.lit(i)) for i in (0, 1))
    points = hundredths.select(
        "account_guid",
        (F.array(low) if legacy else low).alias("mos_bottom_10_percentile"),
        (F.array(high) if legacy else high).alias("mos_top_10_percentile"),
    )
    return own.join(points, "account_guid")


@dataclass(frozen=True)
class Grain:
    """What counts as "the same viewing" when an account is compared with everybody.

    ``keys`` are the peer keys. ``days`` says how the per-day denominators count days: distinct days of the account, or
    the sum over its groups of each group's distinct days. ``weighted_by`` is the denominator of the weighted mean: a
    column to count, or "days". ``inclusive`` makes the tail tests accept equality. ``small`` marks grains whose peer
    table is bounded by construction (named parts of days and weeks) and can be broadcast.
    """

    name: str
    keys: tuple[str, ...]
    weighted_by: str
    distinct_days: bool = True
    inclusive: bool = True
    small: bool = False


BY_STREAM = Grain("stream", ("stream_id", DAY), "stream_id", inclusive=False)
BY_CHANNEL = Grain("channel", ("channel_number", DAY), "channel_number")
BY_WEEK_PART = Grain("week_part", ("week_part", "day_part"), "week_part", distinct_days=False, small=True)
BY_DAY_PART = Grain("day_part", (DAY, "day_part"), "days", distinct_days=False)
# Grains made of these share one aggregation of the sessions, whose shuffle is written once and read by each of them.
PARTS = (DAY, "week_part", "day_part")
GRAINS = (BY_STREAM, BY_CHANNEL, BY_WEEK_PART, BY_DAY_PART)


def with_day_and_week_part(
    sessions: DataFrame, start: str = "start_timestamp", zone: str = "UTC", legacy: bool = False
) -> DataFrame:
    """Adds ``day_part`` and ``week_part`` of the session's start in a time zone."""
    when = moment(F.col(start), zone)
    bands = DAY_PARTS_LEGACY if legacy else DAY_PARTS
    return sessions.withColumns({"day_part": day_part(F.hour(when), bands), "week_part": week_part(when)})


def score_sums(score: Column) -> list[Column]:
    """Counts and exact sums of score steps and of score steps x watch time."""
    watched = score * F.col(WATCHED)
    high, low = whole_parts(watched)
    return [
        F.count(score).alias("_n"), F.sum(score).alias("_sum"), F.count(watched).alias("_wn"),
        F.sum(high).alias("_whigh"), F.sum(low).alias("_wlow"),
    ]


def peer_compare(
    sessions: DataFrame,
    grain: Grain,
    own: Column | None = None,
    legacy: bool = False,
    score_steps: int = SCORE_STEPS,
) -> DataFrame:
    """Nine features per account from its mean score in each group of ``grain`` against all sessions of that group.

    ``sessions`` are those that make up the peers. ``own`` marks the ones that also count for their account (training
    compares an account inside its own window with peers that have no upper bound); by default all do. Scores are summed
    in whole steps of 1/``score_steps``. ``legacy`` takes the literal formulas: two to the power of the difference
    instead of its square, and tail points one place too far right, where the upper one does not exist.

    Both sides are reduced where the sessions lie: to account x group, and to group x whole score, whose counts feed the
    percentiles. Only the first is large when shuffled; where a group is hot, adaptive execution splits it, as nothing after
    the join needs its partitioning.
    """
    keys = list(grain.keys)
    fine = list(PARTS) if set(keys) <= set(PARTS) else keys
    score = fixed_point(F.col(SCORE), score_steps)
    mine = sessions if own is None else sessions.where(own)
    accounts = mine.groupBy("account_guid", *fine).agg(*score_sums(score))
    peers = sessions.groupBy(*fine, F.round(SCORE).cast("int").alias("_whole")).agg(
        F.count(F.lit(1)).alias("_rows"), *score_sums(score)
    )
    return compare_groups(accounts, peers, grain, legacy, score_steps)


def compare_groups(
    accounts: DataFrame, peers: DataFrame, grain: Grain, legacy: bool = False, score_steps: int = SCORE_STEPS
) -> DataFrame:
    """``peer_compare`` from sums (``score_sums``) per account and group, and per group and whole score (``_whole``, with
    ``_rows``). Groups are the grain's or, for grains made of ``PARTS``, all of them."""
    keys = list(grain.keys)
    accounts = accounts.groupBy("account_guid", *keys).agg(
        # The finer groups of one account and part differ by day.
        (F.lit(1) if DAY in keys else F.count(DAY)).alias("_days"),
        F.sum("_sum").alias("_own_sum"),
        ratio(F.sum("_sum"), F.sum("_n")).alias("_own_mean"),
        ratio(joined_parts(F.sum("_whigh"), F.sum("_wlow")), F.sum("_wn")).alias("_own_wmean"),
    )
    peers = peers.groupBy(*keys).agg(
        F.sum("_sum").alias("_peer_sum"),
        ratio(F.sum("_sum"), F.sum("_n")).alias("_peer_mean"),
        ratio(joined_parts(F.sum("_whigh"), F.sum("_wlow")), F.sum("_wn")).alias("_peer_wmean"),
        F.percentile("_whole", F.array(F.lit(0.1), F.lit(0.9)), F.col("_rows")).alias("_points"),
    )
    if grain.small:
        both = accounts.join(F.broadcast(peers), keys, "left")
    else:
        both = accounts.join(peers, keys, "left")

    day_count = F.count_distinct(DAY) if grain.distinct_days else F.sum("_days")
    weighted_by = F.count_distinct(DAY) if grain.weighted_by == "days" else F.count(grain.weighted_by)
    low, high = (F.get("_points", F.lit(i)) * score_steps for i in ((1, 2) if legacy else (0, 1)))
    mean, wmean = F.col("_own_mean"), F.col("_own_wmean")
    gap = (mean - F.col("_peer_mean")) / score_steps
    wgap = (wmean - F.col("_peer_wmean")) / score_steps
    sum_gap = wide(F.col("_own_sum") - F.col("_peer_sum"))

    def deviation(difference, count):
        power = F.pow(F.lit(2.0), difference) if legacy else F.pow(difference, F.lit(2.0))
        return F.sqrt(ratio(F.sum(power), count))

    prefix = f"mos_comp_{grain.name}"
    return both.groupBy("account_guid").agg(
        ratio(count_where(mean > F.col("_peer_mean")), day_count).alias(f"{prefix}_cnt_acct_bigger"),
        (ratio(F.sum(sum_gap), day_count) / score_steps).alias(f"{prefix}_avg_acct_bigger"),
        deviation(gap, F.count(mean)).alias(f"{prefix}_std_dev_acct"),
        count_where(mean <= low if grain.inclusive else mean < low).alias(f"{prefix}_avg_mos_bottom_10"),
        count_where(mean >= high if grain.inclusive else mean > high).alias(f"{prefix}_avg_mos_top_10"),
        ratio(F.sum(wmean) / score_steps, weighted_by).alias(f"{prefix}_weighted_avg_mos_acct"),
        ratio(count_where(wmean > F.col("_peer_wmean")), day_count).alias(f"{prefix}_weighted_cnt_acct_bigger"),
        ratio(F.sum(wgap), day_count).alias(f"{prefix}_weighted_avg_acct_bigger"),
        deviation(wgap, F.count(F.col("_peer_wmean"))).alias(f"{prefix}_weighted_std_dev_acct"),
    )
