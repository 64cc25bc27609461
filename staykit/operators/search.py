"""Search behaviour from page events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staykit.functions.numbers import count_where, ratio
from staykit.functions.text import part
from staykit.functions.timeparts import within

SEARCH_OPERATIONS = ("searchEntered", "searchResultSelected")


def search_features(pages: DataFrame, first, last) -> DataFrame:
    """Eight features from search entries ``operation||text||results||milliseconds``: unique searches, searches without
    and with results and response time, each in total and per visit."""
    entries = (
        pages.where(
            within(F.col("activity_date"), first, last)
            & F.col("operation_type").isin(*SEARCH_OPERATIONS)
            & F.col("search_id").isNotNull()
        )
        .select("account_guid", "visit_id", "search_id", F.explode("search_text_list").alias("_entry"))
        .where(F.col("_entry").isNotNull())
        .select(
            "account_guid", "visit_id", "search_id",
            part(F.col("_entry"), "||", 2).try_cast("bigint").alias("_results"),
            part(F.col("_entry"), "||", 3).try_cast("double").alias("_response_ms"),
        )
    )
    visits = F.count_distinct("visit_id")
    totals = {
        "unique_searches": F.count_distinct("search_id"),
        "search_entered_returned_no_results": count_where(F.col("_results") == 0),
        "search_entered_selected_results": count_where(F.col("_results") > 0),
        "search_response_time_ms": F.sum("_response_ms"),
    }
    return entries.groupBy("account_guid").agg(
        *[value.alias(f"sum_{name}") for name, value in totals.items()],
        *[ratio(value, visits).alias(f"avg_{name}") for name, value in totals.items()],
    )
