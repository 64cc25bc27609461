"""The registered queries: each operator over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from staykit.catalog import views as v
from staykit.catalog.settle import settle
from staykit.functions.keys import OPERATORS, AccountCipher, billing_id
from staykit.functions.text import promo_pattern
from staykit.functions.timeparts import epoch_ms
from staykit.models import evaluation, forests, frame
from staykit.models.boruta import boruta_select
from staykit.operators import changes as ch, distinct, partials, population as pop, quality as qu, viewing as vi
from staykit.operators.assemble import union_features
from staykit.operators.search import search_features as search_job
from staykit.plans.matrices import (
    History, Inputs, quality_features as quality_plan, scoring_matrix, training_matrix, viewing_features as viewing_plan,
)
from staykit.sources.tables import (
    Workspace, read_delimited, read_names, read_table, read_tsv, rebuild_table, replace_days, run_sql, write_by_day, write_names,
    write_tsv,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

OP_A, OP_B, OP_C = OPERATORS
TEST_TOKEN = "testtool"
PACKAGES = ("Stream", "Stream Choice", "Stream Plus")
PROMOS = {"OP_A": ("URGENT", "HIGH"), "OP_B": ("LOW", "AUTOMOBILE", "MACHINERY"), "OP_C": ("MEDIUM", "BUILDING+X", "HOUSEHOLD")}
MODEL_COLUMNS = [
    "active_day_cnt", "avg_mos_acct", "mos_std_dev_acct", "weighted_avg_mos_acct", "mos_bottom_10_percentile",
    "mos_top_10_percentile",
]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, sf_dir: settle(function(spark, sf_dir))
    return function


class Source:
    """The input tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = v.view(self.spark, self.sf_dir, name)
        return self._tables[name]

    @property
    def sessions(self) -> DataFrame:
        return pop.with_account_guid(self.table("sessions"))

    @property
    def windowed(self) -> DataFrame:
        return pop.sessions_between(self.sessions, v.FIRST, v.AS_OF)

    @property
    def windowed_minutes(self) -> DataFrame:
        """Watch time in minutes: two to the power of a difference of score x milliseconds is no double any more."""
        return self.windowed.withColumn("watch_time_ms", v.in_minutes())

    @property
    def changes(self) -> DataFrame:
        return pop.with_account_guid(self.table("changes"), "system")

    @property
    def labels(self) -> DataFrame:
        return pop.label_windows(self.table("labels"), v.AS_OF, v.LABEL_DAYS)

    @property
    def training_labels(self) -> DataFrame:
        """All labels of an earlier training run: those with a window that had ended by then."""
        return pop.label_windows(v.view(self.spark, self.sf_dir, "training"), v.AS_OF, v.LABEL_DAYS)

    @property
    def label_sessions(self) -> DataFrame:
        return pop.sessions_in_label_window(self.labels, self.sessions)

    def inputs(self, legacy: bool = False) -> Inputs:
        history = self.table("history")
        eligible = {
            "OP_A": pop.eligible_streaming(TEST_TOKEN), "OP_B": pop.eligible_by_package(PACKAGES),
            "OP_C": pop.eligible_streaming(TEST_TOKEN),
        }
        histories = [
            History(o, history.where(F.col("operator") == o.name).drop("operator"), eligible[o.name],
                    promo_pattern(PROMOS[o.name], literal=not legacy))
            for o in OPERATORS
        ]
        return Inputs(
            self.table("sessions"), histories, self.table("changes"), self.table("calls"), self.table("usage"),
            self.table("labels"), self.table("pages"),
        )


def cipher_from(spark, purpose: str) -> AccountCipher:
    """A cipher whose key is in the session's setting ``spark.staykit.cipher.<purpose>``. It enters as a scalar subquery,
    so no plan shows it. Sessions without the setting, as in checks, use a key made from its name."""
    key = spark.conf.get(f"spark.staykit.cipher.{purpose}", None) or hashlib.sha256(purpose.encode()).hexdigest()[:16]
    return AccountCipher(spark.createDataFrame([(key,)], "key string").scalar())


# Windows, keys and population


@query
def label_windows(spark, sf_dir):
    return Source(spark, sf_dir).labels


@query
def session_account_key(spark, sf_dir):
    return Source(spark, sf_dir).sessions.groupBy("operator", "account_guid").agg(
        F.count(F.lit(1)).alias("sessions"), F.max("activity_date").alias("last_date")
    )


@query
def account_cipher(spark, sf_dir):
    """Encrypted numbers, their decryption, and the billing id derived under the cipher."""
    cipher = cipher_from(spark, "account")
    numbers = Source(spark, sf_dir).table("history").select("account_number", "operator").distinct()
    secret = cipher.encrypt(F.col("account_number"))
    by_operator = F
    for o in OPERATORS:
        by_operator = by_operator.when(F.col("operator") == o.name, cipher.decrypt(billing_id(secret, o, cipher)))
    return numbers.select(
        "account_number", "operator", cipher.decrypt(secret).alias("decrypted"),
        (secret == F.col("account_number")).alias("readable"), by_operator.alias("billing_id"),
    )


@query
def active_accounts(spark, sf_dir):
    return Source(spark, sf_dir).inputs().active(as_of=v.AS_OF)


@query
def active_accounts_labelled(spark, sf_dir):
    source = Source(spark, sf_dir)
    return source.inputs().active(labels=source.labels)


@query
def active_accounts_encrypted(spark, sf_dir):
    """The same accounts from encrypted numbers and holders' names, each under its own key, shown decrypted."""
    source = Source(spark, sf_dir)
    numbers, names = cipher_from(spark, "account"), cipher_from(spark, "name")
    history = source.table("history").withColumns({
        "account_number": numbers.encrypt(F.col("account_number")), "customer_name": names.encrypt(F.col("customer_name")),
    })
    streaming = pop.eligible_streaming(TEST_TOKEN, names)
    eligible = {"OP_A": streaming, "OP_B": pop.eligible_by_package(PACKAGES), "OP_C": streaming}
    histories = [(o, history.where(F.col("operator") == o.name), eligible[o.name]) for o in OPERATORS]
    active = pop.active_accounts(histories, numbers, as_of=v.AS_OF)
    return active.select(
        "operator", *[numbers.decrypt(F.col(c)).alias(c) for c in ("account_number", "billing_id")], "system"
    )


@query
def labelled_sessions(spark, sf_dir):
    source = Source(spark, sf_dir)
    joined = pop.labelled_sessions(source.labels, source.sessions)
    return joined.select(
        "account_guid", *pop.LABEL_COLUMNS, "stream_id", "activity_date", "start_timestamp", "mos_score", "watch_time_ms"
    )


@query
def label_window_sessions(spark, sf_dir):
    return _label_window_counts(Source(spark, sf_dir).label_sessions)


def _label_window_counts(label_sessions):
    rows = pop.sessions_between(label_sessions, F.col("min_agg_date"), F.col("max_agg_date"))
    return rows.groupBy("account_guid", "churn", "min_agg_date", "max_agg_date").agg(
        F.count(F.lit(1)).alias("sessions"), F.min("activity_date").alias("first_date"),
        F.max("activity_date").alias("last_date"), F.sum("watch_time_ms").alias("watched"),
    )


def _session_counts(sessions):
    return sessions.groupBy("account_guid").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("watch_time_ms").alias("watched")
    )


def _excluded(spark, sf_dir, legacy):
    source = Source(spark, sf_dir)
    active, training = source.inputs().active(as_of=v.AS_OF), source.training_labels
    return _session_counts(pop.exclude_accounts(source.sessions, active, training, legacy))


@query
def exclude_training_accounts(spark, sf_dir):
    return _excluded(spark, sf_dir, False)


@query
def exclude_training_accounts_legacy(spark, sf_dir):
    return _excluded(spark, sf_dir, True)


@query
def sessions_of_active(spark, sf_dir):
    source = Source(spark, sf_dir)
    return _session_counts(pop.sessions_of(source.sessions, source.inputs().active(as_of=v.AS_OF)))


def _part_counts(spark, sf_dir, part, legacy=False):
    parted = qu.with_day_and_week_part(Source(spark, sf_dir).sessions, legacy=legacy)
    return parted.groupBy(part).agg(
        F.count(F.lit(1)).alias("sessions"), F.min(epoch_ms(F.col("start_timestamp"))).alias("earliest_epoch_ms")
    )


@query
def day_parts(spark, sf_dir):
    return _part_counts(spark, sf_dir, "day_part")


@query
def day_parts_legacy(spark, sf_dir):
    return _part_counts(spark, sf_dir, "day_part", True)


@query
def week_parts(spark, sf_dir):
    return _part_counts(spark, sf_dir, "week_part")


# Quality


@query
def account_quality(spark, sf_dir):
    return qu.account_quality(Source(spark, sf_dir).windowed, normalised=True)


@query
def account_quality_legacy(spark, sf_dir):
    return _arrays_shown(qu.account_quality(Source(spark, sf_dir).windowed, legacy=True))


def _arrays_shown(rows):
    """One-element percentile arrays as text."""
    arrays = ("mos_bottom_10_percentile", "mos_top_10_percentile")
    return rows.withColumns({c: F.concat(F.lit("["), F.element_at(c, 1).cast("decimal(12,2)").cast("string"), F.lit("]")) for c in arrays})


@query
def account_quality_labelled(spark, sf_dir):
    sessions = Source(spark, sf_dir).label_sessions
    return qu.account_quality(pop.sessions_between(sessions, F.col("min_agg_date"), F.col("max_agg_date")))


def _peers(spark, sf_dir, grain, legacy=False):
    source = Source(spark, sf_dir)
    parted = qu.with_day_and_week_part(source.windowed_minutes if legacy else source.windowed)
    return _logged(qu.peer_compare(parted, grain, legacy=legacy)) if legacy else qu.peer_compare(parted, grain)


def _logged(df):
    """Deviations made of two to the power of a difference, as logarithms to the base of two."""
    powers = [c for c in df.columns if c.endswith("_std_dev_acct") and c.startswith("mos_comp")]
    return df.withColumns({c: F.log2(c) for c in powers})


@query
def peer_by_stream(spark, sf_dir):
    return _peers(spark, sf_dir, qu.BY_STREAM)


@query
def peer_by_channel(spark, sf_dir):
    return _peers(spark, sf_dir, qu.BY_CHANNEL)


@query
def peer_by_week_part(spark, sf_dir):
    return _peers(spark, sf_dir, qu.BY_WEEK_PART)


@query
def peer_by_day_part(spark, sf_dir):
    return _peers(spark, sf_dir, qu.BY_DAY_PART)


@query
def peer_by_stream_legacy(spark, sf_dir):
    return _peers(spark, sf_dir, qu.BY_STREAM, True)


@query
def peer_by_channel_legacy(spark, sf_dir):
    return _peers(spark, sf_dir, qu.BY_CHANNEL, True)


@query
def peer_by_week_part_legacy(spark, sf_dir):
    return _peers(spark, sf_dir, qu.BY_WEEK_PART, True)


@query
def peer_by_day_part_legacy(spark, sf_dir):
    return _peers(spark, sf_dir, qu.BY_DAY_PART, True)


@query
def peer_by_channel_labelled(spark, sf_dir):
    """Training form: an account inside its own window, peers without an upper bound."""
    return qu.peer_compare(
        Source(spark, sf_dir).label_sessions, qu.BY_CHANNEL, F.col("activity_date") <= F.col("max_agg_date")
    )


# Quality from sums per account and day


def _day_store(spark, sessions):
    store = partials.DayStore(spark, Workspace(spark).new_path("days"))
    store.build(sessions)
    return store


@query
def account_quality_by_days(spark, sf_dir):
    """From a store of all days, of which the window's partitions are read."""
    days = _day_store(spark, Source(spark, sf_dir).sessions).between(v.FIRST, v.AS_OF)
    return partials.account_quality_days(days["account"], normalised=True)


@query
def account_quality_slid(spark, sf_dir):
    """The window of a day earlier, one day added and one taken off."""
    work, accounts = Workspace(spark), _day_store(spark, Source(spark, sf_dir).sessions).tables()["account"]
    earlier = {
        "sums": (partials.account_sums, ["account_guid"]), "scores": (partials.account_scores, ["account_guid", "_score"]),
    }
    windows = {}
    for name, (reduced, keys) in earlier.items():
        before = work.store(reduced(pop.sessions_between(accounts, v.DAY_BEFORE_FIRST, v.DAY_BEFORE_LAST)), name)
        entering = reduced(pop.sessions_between(accounts, v.AS_OF, v.AS_OF))
        leaving = reduced(pop.sessions_between(accounts, v.DAY_BEFORE_FIRST, v.DAY_BEFORE_FIRST))
        windows[name] = partials.moved(before, entering, leaving, keys)
    return partials.account_quality_of(windows["sums"], windows["scores"], normalised=True)


@query
def account_quality_labelled_by_days(spark, sf_dir):
    source = Source(spark, sf_dir)
    days = _day_store(spark, source.sessions).in_label_windows(source.labels)["account"]
    return partials.account_quality_days(pop.sessions_between(days, F.col("min_agg_date"), F.col("max_agg_date")))


@query
def peer_by_channel_labelled_by_days(spark, sf_dir):
    source = Source(spark, sf_dir)
    days = _day_store(spark, source.sessions).in_label_windows(source.labels)["channel"]
    return partials.peer_compare_days(days, qu.BY_CHANNEL, F.col("activity_date") <= F.col("max_agg_date"))


def _peers_by_days(spark, sf_dir, grain):
    days = _day_store(spark, Source(spark, sf_dir).sessions).between(v.FIRST, v.AS_OF)
    return partials.peer_compare_days(days[partials.TABLE_OF[grain]], grain)


@query
def peer_by_stream_by_days(spark, sf_dir):
    return _peers_by_days(spark, sf_dir, qu.BY_STREAM)


@query
def peer_by_channel_by_days(spark, sf_dir):
    return _peers_by_days(spark, sf_dir, qu.BY_CHANNEL)


@query
def peer_by_week_part_by_days(spark, sf_dir):
    return _peers_by_days(spark, sf_dir, qu.BY_WEEK_PART)


@query
def peer_by_day_part_by_days(spark, sf_dir):
    return _peers_by_days(spark, sf_dir, qu.BY_DAY_PART)


@query
def quality_features_by_days(spark, sf_dir):
    """Own quality and all four peer comparisons; one day was replaced in the store after it was built."""
    sessions = Source(spark, sf_dir).sessions
    store = _day_store(spark, sessions.where(F.col("activity_date") != F.lit(v.AS_OF).cast("date")))
    store.add_days(sessions, [v.AS_OF])
    return partials.quality_features_days(store.between(v.FIRST, v.AS_OF))


@query
def quality_features(spark, sf_dir):
    return quality_plan(Source(spark, sf_dir).windowed)


@query
def quality_features_legacy(spark, sf_dir):
    return _logged(_arrays_shown(quality_plan(Source(spark, sf_dir).windowed_minutes, legacy=True)))


def _sparse(spark, sf_dir, legacy):
    """Three tables that each miss some accounts: callers, viewers of linear channels, accounts with changes."""
    source = Source(spark, sf_dir)
    tables = [
        source.inputs().call_profile(as_of=v.AS_OF).select("account_guid", "total_calls"),
        vi.top_channel(source.windowed).select("account_guid", "channel_watch_time"),
        ch.change_counts(source.changes).select("account_guid", "total_price_changes"),
    ]
    return union_features(tables, legacy)


@query
def union_of_sparse_tables(spark, sf_dir):
    return _sparse(spark, sf_dir, False)


@query
def union_of_sparse_tables_legacy(spark, sf_dir):
    return _sparse(spark, sf_dir, True)


# Viewing


@query
def viewing_flags(spark, sf_dir):
    return vi.viewing_flags(Source(spark, sf_dir).windowed)


@query
def viewing_devices(spark, sf_dir):
    return vi.viewing_devices(Source(spark, sf_dir).windowed)


@query
def viewing_means(spark, sf_dir):
    return vi.viewing_means(Source(spark, sf_dir).windowed)


@query
def viewing_counts(spark, sf_dir):
    return vi.viewing_counts(Source(spark, sf_dir).windowed)


@query
def viewing_distinct(spark, sf_dir):
    """Counted as bitmaps over a dictionary of the sessions' values."""
    windowed, work = Source(spark, sf_dir).windowed, Workspace(spark)
    dictionary = distinct.Dictionary(spark, work.new_path("dictionary"))
    dictionary.extend(windowed, ["activity_date", *vi.DISTINCTS], work)
    return vi.viewing_distinct(windowed, v.PERIOD_DAYS, dictionary)


@query
def viewing_profile(spark, sf_dir):
    return vi.viewing_profile(Source(spark, sf_dir).windowed, v.PERIOD_DAYS)


@query
def top_channel(spark, sf_dir):
    return vi.top_channel(Source(spark, sf_dir).windowed)


@query
def channel_variability(spark, sf_dir):
    return vi.channel_variability(Source(spark, sf_dir).windowed)


@query
def search_features(spark, sf_dir):
    return search_job(pop.with_account_guid(Source(spark, sf_dir).table("pages")), v.FIRST, v.AS_OF)


def _never(spark, sf_dir, legacy):
    source = Source(spark, sf_dir)
    return vi.never_logged_in(source.table("usage"), source.changes, v.FIRST_CHANGE, v.AS_OF, legacy)


@query
def never_logged_in(spark, sf_dir):
    return _never(spark, sf_dir, False)


@query
def never_logged_in_legacy(spark, sf_dir):
    return _never(spark, sf_dir, True)


@query
def viewing_features(spark, sf_dir):
    source = Source(spark, sf_dir)
    return viewing_plan(source.windowed, source.table("usage"), source.changes, v.FIRST_CHANGE, v.AS_OF, v.PERIOD_DAYS)


@query
def viewing_features_legacy(spark, sf_dir):
    source = Source(spark, sf_dir)
    return viewing_plan(
        source.windowed, source.table("usage"), source.changes, v.FIRST_CHANGE, v.AS_OF, v.PERIOD_DAYS, legacy=True
    )


# Changes, calls, promotions


@query
def change_latest(spark, sf_dir):
    return ch.change_latest(Source(spark, sf_dir).changes)


@query
def change_counts(spark, sf_dir):
    return ch.change_counts(Source(spark, sf_dir).changes)


@query
def change_deciles(spark, sf_dir):
    points = ch.change_deciles(Source(spark, sf_dir).changes, v.AS_OF)
    names = [f"p{k}" for k in range(10, 101, 10)]
    return points.select(*[F.get("points", F.lit(i)).alias(n) for i, n in enumerate(names)], "std_dev", "avg_price")


@query
def change_profile(spark, sf_dir):
    return ch.change_profile(Source(spark, sf_dir).changes, v.AS_OF)


@query
def change_profile_legacy(spark, sf_dir):
    return ch.change_profile(Source(spark, sf_dir).changes, v.AS_OF, legacy=True)


@query
def call_profile(spark, sf_dir):
    return Source(spark, sf_dir).inputs().call_profile(as_of=v.AS_OF)


@query
def call_profile_legacy(spark, sf_dir):
    return Source(spark, sf_dir).inputs().call_profile(as_of=v.AS_OF, legacy=True)


@query
def call_profile_before_churn(spark, sf_dir):
    source = Source(spark, sf_dir)
    return source.inputs().call_profile(labels=source.labels)


@query
def call_profile_before_churn_legacy(spark, sf_dir):
    source = Source(spark, sf_dir)
    return source.inputs().call_profile(labels=source.labels, legacy=True)


@query
def promo_profile(spark, sf_dir):
    """All operators, the ``as_of`` snapshot."""
    return Source(spark, sf_dir).inputs().promo(as_of=v.AS_OF)


@query
def promo_profile_union(spark, sf_dir):
    return Source(spark, sf_dir).inputs().promo(since=v.PROMO_SINCE)


@query
def promo_profile_legacy(spark, sf_dir):
    return Source(spark, sf_dir).inputs(legacy=True).promo(since=v.PROMO_SINCE, legacy=True)


# Matrices


@query
def feature_matrix(spark, sf_dir):
    return training_matrix(
        Source(spark, sf_dir).inputs(), v.AS_OF, v.FIRST_CHANGE, v.LABEL_DAYS, v.PROMO_SINCE,
        layers=Workspace(spark),
    )


@query
def scoring_feature_matrix(spark, sf_dir):
    source = Source(spark, sf_dir)
    return scoring_matrix(
        source.inputs(), v.FIRST, v.AS_OF, v.PERIOD_DAYS, training=source.training_labels,
        layers=Workspace(spark),
    )


def _in_minutes(spark, sf_dir):
    """Inputs of the literal matrices, with watch time in minutes (see ``windowed_minutes``)."""
    source = Source(spark, sf_dir)
    inputs = source.inputs(legacy=True)
    return source, replace(inputs, sessions=inputs.sessions.withColumn("watch_time_ms", v.in_minutes()))


@query
def feature_matrix_legacy(spark, sf_dir):
    """The literal training matrix, with all of its columns."""
    _, inputs = _in_minutes(spark, sf_dir)
    matrix = training_matrix(
        inputs, v.AS_OF, v.FIRST_CHANGE, v.LABEL_DAYS, v.PROMO_SINCE, layers=Workspace(spark), legacy=True
    )
    return _logged(_arrays_shown(matrix))


@query
def scoring_feature_matrix_legacy(spark, sf_dir):
    """The literal scoring matrix, with all of its columns."""
    source, inputs = _in_minutes(spark, sf_dir)
    matrix = scoring_matrix(
        inputs, v.FIRST, v.AS_OF, v.PERIOD_DAYS, training=source.training_labels, layers=Workspace(spark), legacy=True
    )
    return _logged(_arrays_shown(matrix))


@query
def tsv_export(spark, sf_dir):
    """Promotion profiles written as TSV to the work folder and read back as text."""
    path = Workspace(spark).new_path("export")
    write_tsv(Source(spark, sf_dir).inputs().promo(since=v.PROMO_SINCE), path)
    return read_tsv(spark, path)


# Models


def _model_input(spark, sf_dir):
    """Labelled accounts with quality features; text columns stay in to be coerced."""
    source = Source(spark, sf_dir)
    quality = qu.account_quality(source.windowed)
    return source.labels.select("account_guid", "churn", "churn_date").join(quality, "account_guid", "left")


@query
def numeric_coerce(spark, sf_dir):
    return frame.coerce_numeric(_model_input(spark, sf_dir), ["account_guid"])


@query
def hash_split(spark, sf_dir):
    return frame.hash_split(Source(spark, sf_dir).labels.select("account_guid", "churn"), "account_guid", seed=7)


@query
def exact_split(spark, sf_dir):
    """Parts of exactly 80, 10 and 10 % of the labelled accounts."""
    labels = Source(spark, sf_dir).labels.select("account_guid", "churn")
    return frame.exact_split(labels, "account_guid", Workspace(spark), seed=7)


def _scored(spark, sf_dir):
    """Labels with a rule's prediction, long-standing streaming customers stay, and a score."""
    labels = Source(spark, sf_dir).labels
    score = (3 * F.col("tv_stream_tenure") + F.col("customer_tenure")) / F.lit(176.0)
    return labels.withColumns({"prediction": (F.col("tv_stream_tenure") < 10).cast("int"), "score": score})


@query
def confusion_matrix(spark, sf_dir):
    return forests.confusion_matrix(_scored(spark, sf_dir), "churn")


@query
def model_performance(spark, sf_dir):
    return forests.performance(_scored(spark, sf_dir), "churn")


@query
def threshold_performance(spark, sf_dir):
    """AUC, losses, and the confusion matrix at the threshold of the best F1."""
    return evaluation.threshold_report(evaluation.score_histogram(_scored(spark, sf_dir), "score", "churn"))


@query
def gains_table(spark, sf_dir):
    return evaluation.gains(evaluation.score_histogram(_scored(spark, sf_dir), "score", "churn"))


@query
def category_index(spark, sf_dir):
    """Zip codes as numbers of categories, the eleven most frequent and the rest."""
    history = Source(spark, sf_dir).table("history").select("account_number", "snapshot_date", "zip_code", F.col("zip_code").alias("zip"))
    indexed = frame.index_categories(history, ["zip"], max_bins=12)
    return indexed.groupBy("zip_code", "zip").agg(F.count(F.lit(1)).alias("rows"))


@query
def constant_columns(spark, sf_dir):
    rows = _model_input(spark, sf_dir).withColumn("outage", F.lit(0)).withColumn("never", F.lit(None).cast("double"))
    return frame.constant_columns(rows, ["active_day_cnt", "avg_mos_acct", "outage", "never", "churn"])


@query
def correlations(spark, sf_dir):
    numeric = frame.coerce_numeric(_model_input(spark, sf_dir), ["account_guid"])
    return frame.correlations(numeric, MODEL_COLUMNS)


PLANTED_FEATURES = [
    "internet_package_changes", "video_package_changes", "other_package_adds", "total_price_adds", "total_price_drop",
    "change_ratio", "noise",
]


# Chosen so that the noise does not, by chance, tell anything about the label in the test tables.
NOISE_SEEDS = (49, 79)


def _planted(spark, sf_dir):
    """Change features with a label that depends on two of them, and a noise column made from the key."""
    counts = ch.change_counts(Source(spark, sf_dir).changes)
    signal = F.col("total_price_adds") + F.col("internet_package_changes") > 10
    noise = frame.bucket(F.col("account_guid"), NOISE_SEEDS[0]).alias("noise")
    return counts.select("account_guid", signal.cast("int").alias("churn"), *PLANTED_FEATURES[:-1], noise)


def _model_frames(spark, sf_dir, features=None, planted=None):
    numeric = frame.coerce_numeric(_planted(spark, sf_dir) if planted is None else planted, ["account_guid"])
    rows = frame.model_frame(frame.exact_split(numeric, "account_guid", Workspace(spark)), features or PLANTED_FEATURES, keep=["split"])
    return [rows.where(F.col("split") == part).drop("split") for part in ("train", "valid")]


SIGNALS = ("internet_package_changes", "total_price_adds")
# A model that has found the planted rule is right this often; always saying one class is right in six of ten rows.
RIGHT = 0.75


@query
def boruta_selection(spark, sf_dir):
    """What becomes of the features that the label was made from, and of noise."""
    planted = _planted(spark, sf_dir).withColumn("noise_b", frame.bucket(F.col("account_guid"), NOISE_SEEDS[1]))
    chosen = boruta_select(planted, [*SIGNALS, "noise", "noise_b"])
    found = [(f, "accepted") for f in chosen.accepted] + [(f, "rejected") for f in chosen.rejected]
    return spark.createDataFrame(found + [(f, "tentative") for f in chosen.tentative], "feature string, decision string")


def _searched(spark, found, valid, grid):
    """Each point of the grid with the number of them, whether its place follows the accuracy, whether all models that
    split come before it or it splits itself, whether the saved model is as accurate as stated, and whether it has found
    the rule."""
    rows, points, before = [], len(forests.grid_points(grid)), float("inf")
    splitting = sum(entry["params"]["maxDepth"] > 0 for entry in found)
    for place, entry in enumerate(found):
        model, params, right = forests.load_model(entry["path"]), entry["params"], entry["accuracy"]
        same = abs(forests.accuracy(model, valid) - right) < 1e-9
        splits_first = (place < splitting) == (params["maxDepth"] > 0)
        rows.append((*[params[name] for name in grid], points, right <= before, splits_first, same, right > RIGHT))
        before = right
    types = ", ".join(f"{name} {'string' if isinstance(values[0], str) else 'int'}" for name, values in grid.items())
    return spark.createDataFrame(rows, f"{types}, points int, in_order boolean, splits_first boolean, as_stated boolean, found_rule boolean")


@query
def forest_grid(spark, sf_dir):
    """A whole grid of forests, ranked by accuracy: forests without splits are no match for the rule."""
    train, valid = _model_frames(spark, sf_dir)
    grid = {"numTrees": [5, 10, 30], "maxDepth": [0, 3, 5, 6], "featureSubsetStrategy": ["2", "4"]}
    with Workspace(spark) as work:
        found = forests.search_forest(train, valid, work.new_path("models"), grid, stopping_rounds=24)
        return _searched(spark, found, valid, grid)


@query
def boosted_grid(spark, sf_dir):
    """A whole grid of boosted models, ranked by accuracy."""
    train, valid = _model_frames(spark, sf_dir)
    grid = {"maxIter": [2, 4, 20], "maxDepth": [0, 2, 3]}
    with Workspace(spark) as work:
        found = forests.search_boosted(train, valid, work.new_path("models"), grid, stopping_rounds=9)
        return _searched(spark, found, valid, grid)


@query
def boosted_grid_deep(spark, sf_dir):
    """The second grid, of deep models that stop by themselves: whether all of them found the rule with few trees."""
    train, valid = _model_frames(spark, sf_dir)
    with Workspace(spark) as work:
        found = forests.search_boosted(
            train, valid, work.new_path("models"), forests.BOOSTED_GRID_DEEP, max_models=3, stopping_rounds=9, stop_inside=True
        )
        rows = [(e["accuracy"] > RIGHT, forests.load_model(e["path"]).getNumTrees < min(forests.BOOSTED_GRID_DEEP["maxIter"])) for e in found]
    return spark.createDataFrame(rows, "found_rule boolean, stopped_inside boolean")


@query
def forest_blocks(spark, sf_dir):
    """A forest grown in blocks of trees: whether it stopped by itself, and found the rule."""
    train, valid = _model_frames(spark, sf_dir)
    with Workspace(spark) as work:
        forest = forests.grow_forest(train, valid, work, trees=400, block=20, tolerance=0.05)
        right = forests.accuracy(forest, valid) > RIGHT
    return spark.createDataFrame([(forest.trees < 400, right)], "stopped_inside boolean, found_rule boolean")


@query
def forest_summary(spark, sf_dir):
    """Trees, depth and leaves of a forest."""
    train, _ = _model_frames(spark, sf_dir)
    found = forests.model_summary(forests.fit_forest(train, trees=50, maxDepth=3))
    return spark.createDataFrame([found]).select(
        F.col("trees").cast("int").alias("trees"), F.col("max_depth").cast("int").alias("max_depth"),
        F.col("max_leaves").between(4, 8).alias("leaves_fit"), (F.col("mean_leaves") > 2).alias("splits"),
    )


@query
def forest_importance(spark, sf_dir):
    """Whether each feature is one of the two most important, its place among noise, and that scaled importances start at 1."""
    train, _ = _model_frames(spark, sf_dir)
    table = forests.importance_table(forests.fit_forest(train), PLANTED_FEATURES)
    noise = next(x for name, x, _, _ in table if name == "noise")
    rows = [(name, place < 2, x > noise, scaled == 1, share) for place, (name, x, scaled, share) in enumerate(table) if name in (*SIGNALS, "noise")]
    found = spark.createDataFrame(rows, "feature string, top boolean, above_noise boolean, largest boolean, share double")
    return found.select("feature", "top", "above_noise", (F.col("share") < 0.2).alias("small"))


@query
def useful_features(spark, sf_dir):
    """Features with any importance: a constant has none."""
    planted = _planted(spark, sf_dir).withColumn("flat", F.lit(3.0))
    features = [*SIGNALS, "flat"]
    train, _ = _model_frames(spark, sf_dir, features, planted)
    kept = forests.useful_features(forests.fit_forest(train), features)
    return spark.createDataFrame([(f, f in kept) for f in features], "feature string, kept boolean")


@query
def category_importance(spark, sf_dir):
    """A label that follows a text with many values: split by sets of categories it is found with few splits, and is the
    most important feature."""
    planted = _planted(spark, sf_dir).withColumn("segment", F.substring(F.md5("account_guid"), 1, 1))
    planted = planted.withColumn("churn", F.col("segment").isin(*"02468ace").cast("int"))
    indexed = frame.index_categories(planted, ["segment"], max_bins=32)
    features = ["segment", *SIGNALS, "noise"]
    rows = frame.model_frame(indexed, features)
    model = forests.fit_forest(rows, trees=20, maxDepth=2, featureSubsetStrategy="all")
    first = forests.importances(model, features)[0][0]
    return spark.createDataFrame([(first, forests.accuracy(model, rows) > 0.95)], "first_feature string, found_rule boolean")


def _by_class(scored):
    """Rows per actual class, and whether most of them were recognised."""
    hit = F.avg((F.col("label") == F.col("prediction")).cast("double"))
    return scored.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), (hit > 0.6).alias("mostly_right"))


@query
def boosted_fit(spark, sf_dir):
    """Up to 500 boosted trees of depth 12, of which few are grown."""
    train, valid = _model_frames(spark, sf_dir)
    model = forests.grow_boosted(train, valid)
    return _by_class(model.transform(valid)).withColumn("stopped_inside", F.lit(model.getNumTrees < 500))


@query
def model_chain(spark, sf_dir):
    """Matrix, coercion, selection, split, forest saved and loaded, test rows per class.

    The label is a rule over two columns of the matrix. Whether the selection accepted both is in the result; without any
    accepted feature the chain ends with an error.
    """
    work = Workspace(spark)
    matrix = training_matrix(
        Source(spark, sf_dir).inputs(), v.AS_OF, v.FIRST_CHANGE, v.LABEL_DAYS, v.PROMO_SINCE, layers=work
    )
    rule = F.coalesce("total_price_adds", F.lit(0)) + F.coalesce("internet_package_changes", F.lit(0)) > 10
    numeric = work.store(frame.coerce_numeric(matrix.withColumn("churn", rule.cast("int")), ["account_guid"]), "numeric")
    chosen = boruta_select(numeric, frame.feature_names(numeric, ["account_guid", "churn"]), trees=100)
    if not chosen.accepted:
        raise ValueError(f"no feature was accepted after {chosen.rounds} rounds")
    names_path, model_path = work.new_path("names"), work.new_path("model")
    write_names(spark, chosen.accepted, names_path)
    split = frame.exact_split(numeric, "account_guid", work, seed=7)
    rows = frame.model_frame(split, read_names(spark, names_path), keep=["split"])
    forests.save_model(forests.fit_forest(rows.where("split = 'train'")), model_path)
    scored = forests.load_forest(model_path).transform(rows.where("split = 'test'"))
    return _by_class(scored).withColumn("signals_accepted", F.lit(set(SIGNALS) <= set(chosen.accepted)))


# Sources


@query
def rebuilt_table(spark, sf_dir):
    """The labels written over an older table and read back."""
    path = Workspace(spark).new_path("labels")
    labels = Source(spark, sf_dir).labels
    rebuild_table(labels.select("account_guid"), path)
    rebuild_table(labels, path)
    return spark.read.parquet(path)


@query
def replaced_day(spark, sf_dir):
    """Calls by day, of which the last day is replaced by calls a day later after installing; a day without rows is emptied."""
    path, calls = Workspace(spark).new_path("calls"), Source(spark, sf_dir).table("calls")
    write_by_day(calls, path, "call_date")
    late = calls.where(F.col("call_date") == F.lit(v.AS_OF).cast("date")).withColumn("days_since_install", F.col("days_since_install") + 1)
    replace_days(late, path, [v.AS_OF, v.FIRST], "call_date")
    return read_table(spark, path)


@query
def label_window_sessions_by_day(spark, sf_dir):
    """Sessions that lie partitioned by day: the labels' window decides, at run time, which partitions are read."""
    return _label_window_counts(pop.sessions_in_label_window(Source(spark, sf_dir).labels, _sessions_by_day(spark, sf_dir)))


@query
def sessions_of_active_by_day(spark, sf_dir):
    """The scoring window on the same layout."""
    source = Source(spark, sf_dir)
    window = pop.sessions_between(_sessions_by_day(spark, sf_dir), v.FIRST, v.AS_OF)
    return _session_counts(pop.sessions_of(window, source.inputs().active(as_of=v.AS_OF)))


def _sessions_by_day(spark, sf_dir):
    path = Workspace(spark).new_path("sessions")
    write_by_day(Source(spark, sf_dir).sessions, path)
    return read_table(spark, path)


@query
def parameter_query(spark, sf_dir):
    """A query text with a parameter for the day."""
    sessions = Source(spark, sf_dir).table("sessions")
    text = "SELECT operator, count(*) AS sessions FROM {sessions} WHERE activity_date = CAST(:day AS DATE) GROUP BY operator"
    return run_sql(spark, text, {"day": v.AS_OF}, sessions=sessions)


@query
def delimited_file(spark, sf_dir):
    """Labels as text with bars between the columns, read back under new names."""
    path = Workspace(spark).new_path("delimited")
    labels = Source(spark, sf_dir).table("labels").select("account_guid", "churn", "tv_stream_tenure")
    labels.write.option("sep", "|").option("header", True).csv(path)
    return read_delimited(spark, path, ["account", "left_us", "tenure"])


@query
def names_file(spark, sf_dir):
    """The matrix' numeric model columns through a file of names, and how many accounts each has a value for."""
    path = Workspace(spark).new_path("names")
    write_names(spark, MODEL_COLUMNS, path)
    names, rows = read_names(spark, path), _model_input(spark, sf_dir)
    counts = rows.agg(*[F.count(c).alias(c) for c in names])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("accounts")) for c in names])))
