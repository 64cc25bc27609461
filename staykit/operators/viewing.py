"""What an account watches: 73 aggregates, top channel, variability, and accounts that never logged in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from staykit.functions.numbers import count_where, ratio, share_where, sum_where
from staykit.functions.text import finds, taller_than
from staykit.functions.timeparts import epoch_ms, within
from staykit.operators.changes import CHANGED
from staykit.operators.distinct import Dictionary, distinct_counts

# What makes a session sports, premium or HD, and the devices watch time is split by.
SPORTS_GENRES = "football|basketball|baseball|soccer"
SPORTS_PROVIDERS = "nbcolympics|nbcsports|espn|nfl|foxdeportes|foxsports1|beinsport"
PREMIUM_NETWORKS = "hbo|showtime|starz|cinemax"
PREMIUM_PROVIDERS = "sho|hbo|starzencore|cinemax"
HD_LINES = 720
DEVICES = (
    "iphone", "androidphone", "uwp", "samsungtv", "androidtablet", "webbrowser", "ipad", "ipod touch", "xbox", "roku",
)

# Metrics that are averaged, by how the column becomes a number.
NUMBERS = (
    "rental_duration_hours", "content_runtime", "content_year", "stream_init_starts", "stream_noninit_failures",
    "stream_init_failures", "stream_failures", "stream_stops", "tune_time_ms", "watch_time_ms", "bandwidth_consumed_mb",
    "bitrate_content_elapsed_ms", "buffering_events", "buffering_stops", "buffering_duration_ms", "buffering_ratio",
    "buffering_score", "ad_breaks", "ad_events", "last_ad_sequence_number", "last_ad_end_sequence_number",
    "avg_bitrate_mbps", "bitrate_upshifts", "bitrate_downshifts", "downshifts_score", "last_stop_sequence_number",
    "level2_downshifts", "pibbe_ms", "pibd2_ms", "mos_score", "watch_time_on_net_ms", "watch_time_off_net_ms",
)
BOOLEANS = ("is_active", "has_playback_start")
DATES = ("content_available_date", "content_expiration_date", "content_original_air_date")
EPOCHS = ("start_timestamp", "end_timestamp", "last_stop_timestamp")
# Counted distinct, and the name of the feature.
DISTINCTS = {
    "channel_name": "dist_channel_name", "network_name": "dist_network_name",
    "channel_category": "dist_channel_category", "device_type": "distinct_device_cnt",
}


def flag_columns() -> list[Column]:
    sports = finds(F.col("content_genres"), SPORTS_GENRES) | finds(F.col("provider_asset_id"), SPORTS_PROVIDERS)
    premium = finds(F.col("network_name"), PREMIUM_NETWORKS) | finds(F.col("provider_asset_id"), PREMIUM_PROVIDERS)
    hd = taller_than(F.col("screen_resolution"), HD_LINES)
    columns = []
    for name, test in (("sports", sports), ("prem", premium), ("hd", hd)):
        columns += [count_where(test).alias(f"sum_{name}_flag"), share_where(test).alias(f"avg_{name}_flag")]
    return columns


def device_columns() -> list[Column]:
    return [
        sum_where(F.col("device_type") == d, F.col("watch_time_ms")).alias(f"{d.split()[0]}_device_watch_time")
        for d in DEVICES
    ]


def mean_columns() -> list[Column]:
    """Plain means; dates are averaged as days since 1970 and epochs as milliseconds, whichever unit they came in."""
    columns = [F.avg(c).alias(f"avg_{c}") for c in NUMBERS]
    columns += [F.avg(F.col(c).cast("int")).alias(f"avg_{c}") for c in BOOLEANS]
    columns += [F.avg(F.unix_date(c)).alias(f"avg_{c}") for c in DATES]
    return columns + [F.avg(epoch_ms(F.col(c))).alias(f"avg_{c}") for c in EPOCHS]


def count_columns() -> list[Column]:
    """Ratios of sums, sums, counts and last dates."""
    linear, vod = (F.col("playback_type") == kind for kind in ("linear", "vod"))
    cancels = F.col("user_cancels_stream")
    return [
        ratio(F.sum("watch_time_ms"), F.sum("level2_downshifts")).alias("watch_time_per_level2_downshift"),
        ratio(F.sum(F.col("mos_score") * F.col("watch_time_on_net_ms")), F.count("billing_id")).alias("avg_mos_x_time"),
        F.sum("stream_failures").alias("sum_stream_failures"),
        ratio(F.sum("watch_time_off_net_ms"), F.sum("watch_time_ms")).alias("pctn_watch_time_off_net_ms"),
        F.max("activity_date").alias("max_activity_date"),
        count_where(linear).alias("sum_linear"),
        count_where(vod).alias("sum_vod"),
        F.max(F.when(linear, F.col("activity_date"))).alias("max_linear_activity_date"),
        F.max(F.when(vod, F.col("activity_date"))).alias("max_vod_activity_date"),
        count_where(cancels).alias("sum_user_stream_cancel"),
        count_where(~cancels).alias("sum_user_stream_not_cancel"),
        F.count("activity_date").alias("total_stream_count_date"),
    ]


def viewing_distinct(sessions: DataFrame, period_days: int, dictionary: Dictionary | None = None) -> DataFrame:
    """Share of days active and the distinct channels, networks, categories and devices.

    With a ``dictionary`` of these columns (``DISTINCTS`` and the day) they are counted as bitmaps, in one pass; without,
    each row is expanded once per counted column.
    """
    if dictionary:
        counted = distinct_counts(sessions, ["account_guid"], {"activity_date": "_days", **DISTINCTS}, dictionary)
        return counted.select("account_guid", (F.col("_days") / period_days).alias("dist_date_percent"), *DISTINCTS.values())
    return sessions.groupBy("account_guid").agg(
        (F.count_distinct("activity_date") / period_days).alias("dist_date_percent"),
        *[F.count_distinct(column).alias(name) for column, name in DISTINCTS.items()],
    )


def viewing_means(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("account_guid").agg(*mean_columns())


def viewing_flags(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("account_guid").agg(*flag_columns())


def viewing_devices(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("account_guid").agg(*device_columns())


def viewing_counts(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("account_guid").agg(*count_columns())


def viewing_profile(sessions: DataFrame, period_days: int, dictionary: Dictionary | None = None) -> DataFrame:
    """All 73 aggregates per account.

    Three aggregations over disjoint columns, joined where they already lie: the means alone keep 80 buffers, and more
    than 100 fields would switch code generation off; the distinct counts expand each row once per counted column and do
    so on a narrow projection.
    """
    sums = sessions.groupBy("account_guid").agg(*flag_columns(), *device_columns(), *count_columns())
    return sums.join(viewing_means(sessions), "account_guid").join(
        viewing_distinct(sessions, period_days, dictionary), "account_guid"
    )


def _linear(sessions: DataFrame) -> DataFrame:
    return sessions.where((F.col("playback_type") == "linear") & F.col("guide_id").isNotNull())


def top_channel(sessions: DataFrame) -> DataFrame:
    """The linear channel an account watched longest; on equal time the lowest channel id."""
    best = Window.partitionBy("account_guid").orderBy(F.desc("channel_watch_time"), "guide_id")
    return (
        _linear(sessions)
        .groupBy("account_guid", "guide_id")
        .agg(F.sum("watch_time_ms").alias("channel_watch_time"))
        .withColumn("_rank", F.row_number().over(best))
        .where("_rank = 1")
        .select("account_guid", F.col("guide_id").alias("top_channel_watch_time"), "channel_watch_time")
    )


def channel_variability(sessions: DataFrame) -> DataFrame:
    """Mean over channel and week of the year of the deviation of watch time."""
    return (
        _linear(sessions)
        .groupBy("account_guid", "guide_id", F.weekofyear("activity_date").alias("_week"))
        .agg(F.stddev_pop("watch_time_ms").alias("_deviation"))
        .groupBy("account_guid")
        .agg(F.avg("_deviation").alias("avg_std_channel"))
    )


def never_logged_in(usage: DataFrame, changes: DataFrame, first, last, legacy: bool = False) -> DataFrame:
    """Accounts with a streaming-package change in the window and no row in the usage table.

    Operator, billing id and system are compared null-safely, because one operator has no system; ``legacy`` compares
    with plain equality, which reports all of that operator's accounts. Both sides are distinct before the join.
    """
    changed = changes.where(F.col("tv_stream_package").isNotNull() & within(F.col(CHANGED), first, last))
    accounts = changed.select("account_guid", "operator", "billing_id", "system").distinct().alias("a")
    used = usage.select("operator", "billing_id", F.col("division").alias("system")).distinct().alias("u")
    pairs = [(F.col(f"a.{c}"), F.col(f"u.{c}")) for c in ("operator", "billing_id", "system")]
    same = F.lit(True)
    for mine, theirs in pairs:
        same = same & ((mine == theirs) if legacy else mine.eqNullSafe(theirs))
    found = accounts.join(used, same, "left_anti")
    return found.select("account_guid", "billing_id", F.lit(1).alias("never_logged_in"))
