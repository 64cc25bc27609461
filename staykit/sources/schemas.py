"""Columns of the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from staykit.operators.changes import CHANGED, FLAGS
from staykit.operators.viewing import BOOLEANS, DATES, EPOCHS, NUMBERS

_DOUBLES = {
    "rental_duration_hours", "content_runtime", "bandwidth_consumed_mb", "buffering_ratio", "buffering_score",
    "avg_bitrate_mbps", "downshifts_score", "mos_score",
}
_SESSION_TEXT = (
    "billing_id", "operator", "division", "stream_id", "content_genres", "provider_asset_id", "screen_resolution",
    "channel_number", "channel_name", "network_name", "channel_category", "guide_id", "device_type", "playback_type",
)


def _struct(**kinds) -> T.StructType:
    types = {"text": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(),
             "date": T.DateType(), "bool": T.BooleanType(), "texts": T.ArrayType(T.StringType())}
    return T.StructType([T.StructField(name, types[kind]) for kind, names in kinds.items() for name in names.split()])


SESSIONS = _struct(
    text=" ".join(_SESSION_TEXT),
    date=" ".join(("activity_date",) + DATES),
    bool=" ".join(BOOLEANS + ("user_cancels_stream",)),
    double=" ".join(c for c in NUMBERS if c in _DOUBLES),
    long=" ".join(tuple(c for c in NUMBERS if c not in _DOUBLES) + EPOCHS),
)
LABELS = _struct(text="account_guid churn_date", int="churn tv_stream_tenure customer_tenure", date="connect_date convert_date")
CHANGES = _struct(text="billing_id operator system account_number", date=CHANGED, int=" ".join(FLAGS))
HISTORY = _struct(
    text="account_number customer_name system customer_type file_type account_type video_package_type "
    "promotion_description dwelling zip_code zip_code_4",
    bool="stream_flag choice_flag", long="truck_call_count", date="snapshot_date",
)
CALLS = _struct(date="call_date", int="days_since_install", text="company_code subaccount")
USAGE = _struct(text="billing_id operator division")
PAGES = _struct(
    text="billing_id operator division visit_id search_id operation_type", texts="search_text_list", date="activity_date"
)


def conform(df: DataFrame, schema: T.StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """Brings a table to ``schema``: renames columns (theirs to ours), casts, and adds absent ones as NULL."""
    df = df.withColumnsRenamed(renames or {})
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
