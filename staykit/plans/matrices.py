"""The training and the scoring feature matrix, from source tables to one row per account."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from staykit.functions.keys import AccountCipher, Operator
from staykit.operators.assemble import KEY, feature_matrix, one_per_account, union_features
from staykit.operators.calls import call_profile
from staykit.operators.changes import change_profile
from staykit.operators.population import (
    active_accounts, label_windows, scored_accounts, sessions_between, sessions_in_label_window, sessions_of,
    with_account_guid,
)
from staykit.operators.promo import PROMO_COLUMNS, promo_profile, promo_profile_union, promo_profiles
from staykit.operators.quality import GRAINS, account_quality, peer_compare, with_day_and_week_part
from staykit.operators.search import search_features
from staykit.operators.viewing import channel_variability, never_logged_in, top_channel, viewing_profile
from staykit.functions.timeparts import as_date
from staykit.sources.tables import Workspace, together

# The literal training job divides active days by this, whatever its window.
LEGACY_PERIOD_DAYS = 60


@dataclass(frozen=True)
class History:
    """One operator's account history, the condition that makes a row a streaming customer's, and the pattern of its
    promotion codes."""

    operator: Operator
    table: DataFrame
    eligible: Column
    promo: str


@dataclass(frozen=True)
class Inputs:
    """Source tables in the layouts of ``staykit.sources.schemas``."""

    sessions: DataFrame
    histories: list[History]
    changes: DataFrame
    calls: DataFrame
    usage: DataFrame
    labels: DataFrame | None = None
    pages: DataFrame | None = None
    cipher: AccountCipher | None = None

    def active(self, **options) -> DataFrame:
        listed = [(h.operator, h.table, h.eligible) for h in self.histories]
        return active_accounts(listed, self.cipher, **options)

    def keyed_sessions(self) -> DataFrame:
        return with_account_guid(self.sessions, "division", [h.operator for h in self.histories])

    def keyed_changes(self) -> DataFrame:
        return with_account_guid(self.changes, "system", [h.operator for h in self.histories])

    def call_history(self) -> DataFrame:
        """History of the operators whose keys need a billing system."""
        tables = [h.table.select("account_number", "system") for h in self.histories if h.operator.with_division]
        union = tables[0]
        for table in tables[1:]:
            union = union.unionByName(table)
        return union

    def call_profile(self, **options) -> DataFrame:
        operators = [h.operator for h in self.histories]
        return call_profile(self.calls, self.call_history(), operators, self.cipher, **options)

    def promo(self, legacy: bool = False, **options) -> DataFrame:
        if not legacy:
            listed = [(h.table, h.operator, h.promo, h.eligible) for h in self.histories]
            return promo_profiles(listed, cipher=self.cipher, **options).select(PROMO_COLUMNS)
        return promo_profile_union(
            [promo_profile(h.table, h.operator, h.promo, h.eligible, cipher=self.cipher, legacy=True, **options) for h in self.histories]
        )


def quality_features(sessions: DataFrame, own: Column | None = None, legacy: bool = False) -> DataFrame:
    """An account's own quality and its comparison with peers by stream, channel, week part and day part."""
    mine = sessions if own is None else sessions.where(own)
    # Windowed sessions have a date. Saying so keeps the shared aggregations of two grains equal, and so read only once.
    dated = sessions.where(F.col("activity_date").isNotNull())
    parted = with_day_and_week_part(dated, legacy=legacy)
    by_grain = [peer_compare(parted, grain, own, legacy) for grain in GRAINS]
    return union_features([by_grain[0], account_quality(mine, legacy), *by_grain[1:]], legacy)


def viewing_features(
    sessions: DataFrame, usage: DataFrame, changes: DataFrame, first, last, period_days: int, legacy: bool = False
) -> DataFrame:
    """Viewing profile, top channel, variability and the never-logged-in flag.

    Accounts that never logged in have no sessions, so they enter as rows of their own. The literal form joins the flag on
    a key that is always NULL, which ``legacy`` reproduces as a NULL flag.
    """
    tables = [viewing_profile(sessions, period_days), top_channel(sessions), channel_variability(sessions)]
    if legacy:
        return union_features(tables, legacy=True).withColumn("never_logged_in", F.lit(None).cast("int"))
    never = never_logged_in(usage, changes, first, last).drop("billing_id").distinct()
    return union_features([*tables, never])


def _tables(from_sessions, others: dict[str, DataFrame], layers: Workspace | None) -> dict[str, DataFrame]:
    """The per-account tables, written to the workspace if there is one, clustered by account, so that they are joined
    where they lie. Those that do not read sessions are built while the sessions are being windowed."""
    if layers is None:
        return {**from_sessions(), **others}
    jobs = [lambda: layers.store_all_clustered(from_sessions(), KEY), lambda: layers.store_all_clustered(others, KEY)]
    first, second = together(layers.spark, jobs)
    return {**first, **second}


def _search(inputs: Inputs, first, last) -> dict[str, DataFrame]:
    """Search features of the page events of a period, if there are any."""
    if inputs.pages is None:
        return {}
    pages = with_account_guid(inputs.pages, "division", [h.operator for h in inputs.histories])
    return {"search": search_features(pages, first, last)}


def training_matrix(
    inputs: Inputs, as_of, first_change, days: int = 90, promo_since=None, layers: Workspace | None = None,
    legacy: bool = False, week_number: str | None = None,
) -> DataFrame:
    """One row per labelled account; the columns of the scoring matrix, and ``churn`` in the place of the spine's.

    Search features cover the ``days`` before ``as_of``. ``week_number`` adds a constant column of that name.

    With ``layers`` the sessions in their label windows, which every session feature reads, and each per-account table
    (clustered by account) are written to that workspace, which the caller clears when the matrix has been read; without it
    everything stays one lazy plan.
    """
    labels = label_windows(inputs.labels, as_of, days)
    identity = inputs.active(labels=labels)
    changes = inputs.keyed_changes()
    period = LEGACY_PERIOD_DAYS if legacy else days + 1

    def from_sessions():
        sessions = sessions_in_label_window(labels, inputs.keyed_sessions())
        if layers:
            sessions = layers.store(sessions, "label-sessions")
        own = F.col("activity_date") <= F.col("max_agg_date")
        mine = sessions_between(sessions, F.col("min_agg_date"), F.col("max_agg_date"))
        return {
            "quality": quality_features(sessions, own, legacy),
            "viewing": viewing_features(mine, inputs.usage, changes, first_change, as_of, period, legacy),
        }

    others = {
        "spine": labels.select("account_guid", "churn"),
        "calls": inputs.call_profile(labels=labels, legacy=legacy),
        "changes": change_profile(changes, as_of, legacy),
        "promo": inputs.promo(since=promo_since, legacy=legacy),
        "identity": identity if legacy else one_per_account(identity),
    }
    others |= _search(inputs, F.date_sub(as_date(as_of), days), as_of)
    tables = _tables(from_sessions, others, layers)
    return feature_matrix(**tables, week_number=week_number, legacy=legacy)


def scoring_matrix(
    inputs: Inputs, first, as_of, period_days: int, training: DataFrame | None = None, layers: Workspace | None = None,
    legacy: bool = False, week_number: str | None = None,
) -> DataFrame:
    """One row per account active on ``as_of``, from sessions between ``first`` and ``as_of``.

    ``training`` accounts are left out of the sessions, because peers would otherwise include them. ``legacy`` keeps them.
    """
    active = inputs.active(as_of=as_of)
    changes = inputs.keyed_changes()

    def from_sessions():
        sessions = sessions_between(inputs.keyed_sessions(), first, as_of)
        if not legacy:
            accounts = scored_accounts(active, training)
            # Written first: their size then decides, before any session is shuffled, how the two are joined.
            sessions = sessions_of(sessions, layers.store(accounts, "scored-accounts") if layers else accounts)
        if layers:
            sessions = layers.store(sessions, "scoring-sessions")
        return {
            "quality": quality_features(sessions, legacy=legacy),
            "viewing": viewing_features(sessions, inputs.usage, changes, first, as_of, period_days, legacy),
        }

    others = {
        "spine": active if legacy else one_per_account(active),
        "calls": inputs.call_profile(as_of=as_of, legacy=legacy),
        "changes": change_profile(changes, as_of, legacy),
        "promo": inputs.promo(as_of=as_of, legacy=legacy),
    }
    others |= _search(inputs, first, as_of)
    tables = _tables(from_sessions, others, layers)
    return feature_matrix(**tables, week_number=week_number, legacy=legacy)
