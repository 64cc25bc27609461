"""Who is scored or trained on, and which sessions belong to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from staykit.functions.keys import OPERATORS, AccountCipher, Operator, account_guid, billing_id
from staykit.functions.text import mentions
from staykit.functions.timeparts import as_date, within

ACCOUNT_COLUMNS = ["account_guid", "operator", "account_number", "billing_id", "system"]
LABEL_COLUMNS = [
    "min_agg_date", "max_agg_date", "churn", "tv_stream_tenure", "customer_tenure", "connect_date", "convert_date",
]


def label_windows(labels: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Adds each account's window: the ``days`` before its churn date, or before ``as_of`` if it has none ('')."""
    end = F.coalesce(F.nullif("churn_date", F.lit("")).cast("date"), as_date(as_of))
    return labels.withColumns({"min_agg_date": F.date_sub(end, days), "max_agg_date": end})


def with_account_guid(df: DataFrame, division: str = "division", operators=OPERATORS) -> DataFrame:
    """Adds ``account_guid`` to rows that carry ``operator``, a division (or billing system) and ``billing_id``."""
    return df.withColumn("account_guid", account_guid(F.col("operator"), F.col(division), F.col("billing_id"), operators))


def eligible_streaming(test_token: str, cipher: AccountCipher | None = None) -> Column:
    """Streaming customers by flag, without the accounts whose holder's name marks them as test accounts. Encrypted names
    are read with ``cipher``, which has a key of its own."""
    name = cipher.decrypt(F.col("customer_name")) if cipher else F.col("customer_name")
    return ~mentions(name, test_token) & (F.col("stream_flag") | F.col("choice_flag"))


def eligible_by_package(packages, excluded_types=("employee", "test"), pairs=None) -> Column:
    """Streaming customers by package name, customer type / file type pair and account type."""
    pairs = pairs or (("Commercial", "Commercial Business"), ("Residential", "Residential"))
    paired = F.lit(False)
    for customer_type, file_type in pairs:
        paired = paired | ((F.col("customer_type") == customer_type) & (F.col("file_type") == file_type))
    return paired & ~F.lower("account_type").isin(*excluded_types) & F.col("video_package_type").isin(*packages)


def operator_accounts(history: DataFrame, operator: Operator, eligible: Column, cipher=None, as_of=None) -> DataFrame:
    """One operator's eligible account rows with key and billing id; only the ``as_of`` snapshot if that is given."""
    rows = history.where(eligible)
    if as_of is not None:
        rows = rows.where(F.col("snapshot_date") == as_date(as_of))
    system = F.col("system") if operator.has_system else F.lit(None).cast("string")
    keyed = rows.select(
        F.lit(operator.name).alias("operator"),
        "account_number",
        billing_id(F.col("account_number"), operator, cipher).alias("billing_id"),
        system.alias("system"),
    )
    return with_account_guid(keyed, "system", [operator]).select(ACCOUNT_COLUMNS)


def active_accounts(histories, cipher: AccountCipher | None = None, as_of=None, labels: DataFrame | None = None):
    """Distinct active accounts over all operators.

    ``histories`` is a list of (operator, history, eligible). Scoring passes ``as_of`` to take one snapshot; training
    passes ``labels`` to keep labelled accounts only. Duplicates go before the semi join, so it sees one row per account.
    """
    found = None
    for operator, history, eligible in histories:
        rows = operator_accounts(history, operator, eligible, cipher, as_of)
        found = rows if found is None else found.unionByName(rows)
    found = found.distinct()
    if labels is not None:
        found = found.join(labels.select("account_guid"), "account_guid", "left_semi")
    return found


def sessions_in_label_window(labels: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sessions on or after the start of their account's window, with the window, label and tenure columns.

    This is what every training feature reads: the account's own features also need ``activity_date <= max_agg_date``,
    the peers' do not. Sessions are narrowed to the widest window before the join.
    """
    bounds = labels.agg(F.min("min_agg_date").alias("first")).scalar()
    carried = ["account_guid"] + [c for c in LABEL_COLUMNS if c in labels.columns]
    recent = sessions.where(F.col("activity_date") >= bounds)
    joined = recent.join(labels.select(*carried), "account_guid")
    return joined.where(F.col("activity_date") >= F.col("min_agg_date"))


def labelled_sessions(labels: DataFrame, sessions: DataFrame) -> DataFrame:
    """Labels left join sessions: all sessions of labelled accounts, and one empty row per label without any."""
    carried = ["account_guid"] + [c for c in LABEL_COLUMNS if c in labels.columns]
    labels = labels.select(*carried)
    matched = sessions.join(labels, "account_guid")
    seen = sessions.select("account_guid").distinct()
    unmatched = labels.join(seen, "account_guid", "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def exclude_accounts(
    sessions: DataFrame, active: DataFrame, training: DataFrame, legacy: bool = False
) -> DataFrame:
    """Sessions of active accounts that are not training accounts. ``legacy`` keeps every session, as the literal
    outer-join formulation does."""
    return sessions if legacy else sessions_of(sessions, scored_accounts(active, training))


def scored_accounts(active: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """Keys of the active accounts, once each, without those of ``training``."""
    keys = active.select("account_guid").distinct()
    return keys if training is None else keys.join(training.select("account_guid"), "account_guid", "left_anti")


def sessions_of(sessions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Sessions whose account is in ``accounts``."""
    keys = accounts.select("account_guid").distinct()
    return sessions.join(keys, "account_guid", "left_semi")


def sessions_between(sessions: DataFrame, first, last) -> DataFrame:
    """Sessions inside one window, or inside each row's own window when the bounds are columns."""
    return sessions.where(within(F.col("activity_date"), first, last))
