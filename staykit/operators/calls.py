"""Support calls per account."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staykit.functions.keys import OPERATORS, SEPARATOR, AccountCipher, billing_id
from staykit.functions.timeparts import as_date


def _account_days(calls: DataFrame, history: DataFrame, operators, cipher, legacy: bool) -> DataFrame:
    """Calls per account key and day. Calls are counted per raw account number first, so the lookup of the billing system
    joins at most one row per number and day, however often a customer called."""
    counted = (
        calls.withColumn("account_number", cipher.encrypt(F.col("subaccount")) if cipher else F.col("subaccount"))
        .groupBy("company_code", "account_number", "call_date")
        .agg(F.count("call_date").alias("calls"), F.min("days_since_install").alias("gap"))
    )
    looked_up = [o for o in operators if o.with_division]
    lookup = history.groupBy("account_number", "system").agg(F.count(F.lit(1)).alias("_copies"))

    def keyed(rows, operator):
        number = F.col("account_number")
        parts = [F.col("system"), billing_id(number, operator, cipher)] if operator.with_division else [number]
        return F.concat_ws(SEPARATOR, F.lit(operator.name), *parts)

    if legacy:
        # Literal form: every call is joined to all history snapshots of its number, which multiplies it; a number
        # without history keeps only the operator's name as its key.
        rows = counted.join(lookup, "account_number", "left")
        guid = F
        for o in operators:
            code, name = F.col("company_code") == o.call_code, F.lit(o.name)
            found = F.when(F.col("_copies").isNull(), name).otherwise(keyed(rows, o)) if o.with_division else keyed(rows, o)
            guid = guid.when(code, found)
        times = F.coalesce("_copies", F.lit(1))
        rows = rows.select(guid.alias("account_guid"), "call_date", (F.col("calls") * times).alias("calls"), "gap")
    else:
        rows = None
        for o in operators:
            mine = counted.where(F.col("company_code") == o.call_code)
            if o in looked_up:
                mine = mine.join(lookup.drop("_copies"), "account_number")
            mine = mine.select(keyed(mine, o).alias("account_guid"), "call_date", "calls", "gap")
            rows = mine if rows is None else rows.unionByName(mine)
    return rows.groupBy("account_guid", "call_date").agg(F.sum("calls").alias("calls"), F.min("gap").alias("gap"))


def call_profile(
    calls: DataFrame,
    history: DataFrame,
    operators=OPERATORS,
    cipher: AccountCipher | None = None,
    labels: DataFrame | None = None,
    as_of=None,
    legacy: bool = False,
) -> DataFrame:
    """Total calls, days between first and last, days with several calls, days with calls, days from install to the first
    call and the mean call date as a yyyymmdd number.

    ``history`` is that of the operators with three-part keys. Scoring passes ``as_of`` (inclusive). Training passes
    ``labels`` with windows: calls before the end of the account's window count; with ``legacy`` only calls before a
    churn date, so accounts that did not churn have none.
    """
    days = _account_days(calls, history, operators, cipher, legacy)
    if as_of is not None:
        days = days.where(F.col("call_date") <= as_date(as_of))
    if labels is not None:
        end = F.nullif("churn_date", F.lit("")).cast("date") if legacy else F.col("max_agg_date")
        ends = labels.select("account_guid", end.alias("_end")).distinct()
        days = days.join(ends, "account_guid").where(F.col("call_date") < F.col("_end"))
    return days.groupBy("account_guid").agg(
        F.sum("calls").alias("total_calls"),
        F.datediff(F.max("call_date"), F.min("call_date")).alias("call_tenure"),
        F.sum(F.when(F.col("calls") >= 2, 1).otherwise(0)).alias("total_same_day_calls"),
        F.count("call_date").alias("count_days_when_called"),
        F.min("gap").alias("time_from_install_to_first_call"),
        F.avg(F.date_format("call_date", "yyyyMMdd").cast("int")).alias("avg_call_date"),
    )
