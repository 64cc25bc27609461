"""Quality features from sums per account and day, so that a new window reads no session twice.

Each day's sessions are reduced once, to counts, whole-number sums and a histogram of scores per account and viewing group.
Windows add those up: ``account_quality`` and the peer comparisons of any window, or of every account's own window, come out
as they do from the sessions. All of it is whole numbers, so days can be taken off again exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from staykit.functions.numbers import fixed_point, joined_parts, or_zero, ratio, wide
from staykit.operators.assemble import KEY, union_features
from staykit.operators.population import sessions_between, sessions_in_label_window
from staykit.operators.quality import (
    BY_CHANNEL, BY_DAY_PART, BY_STREAM, BY_WEEK_PART, DAY, GRAINS, PARTS, SCORE, SCORE_STEPS, WATCHED, Grain, compare_groups,
    score_sums, with_day_and_week_part,
)
from staykit.sources.tables import read_table, replace_days, together, write_by_day

SUMS = ("_n", "_sum", "_wn", "_whigh", "_wlow")
SQUARES = ("_squares", "_wsquares", "_watched")
# The tables of a store: what an account's sessions of a day are grouped by besides the score.
GROUPS = {"account": (), "stream": ("stream_id",), "channel": ("channel_number",), "parts": ("week_part", "day_part")}
TABLE_OF = {BY_STREAM: "stream", BY_CHANNEL: "channel", BY_WEEK_PART: "parts", BY_DAY_PART: "parts"}


def day_table(sessions: DataFrame, name: str, legacy: bool = False, score_steps: int = SCORE_STEPS) -> DataFrame:
    """One table of a store: per account, day, group and score the number of sessions and sums in whole steps.

    Scores are hundredths in ``account``, whose percentiles need them, and whole numbers elsewhere. ``account`` also has
    sums of squares. Sessions without a day are left out. The state is reduced where the sessions lie.
    """
    score = fixed_point(F.col(SCORE), score_steps)
    rows = sessions.where(F.col(DAY).isNotNull())
    if name == "parts":
        rows = with_day_and_week_part(rows, legacy=legacy)
    if name != "account":
        return rows.groupBy(KEY, DAY, *GROUPS[name], F.round(SCORE).cast("int").alias("_whole")).agg(
            F.count(F.lit(1)).alias("_rows"), *score_sums(score))
    watched = score * F.col(WATCHED)
    return rows.groupBy(KEY, DAY, F.round(F.col(SCORE) * 100).cast("int").alias("_score")).agg(
        F.count(F.lit(1)).alias("_rows"), *score_sums(score), F.sum(wide(score) * wide(score)).alias("_squares"),
        F.sum(wide(watched) * wide(watched)).alias("_wsquares"),
        F.coalesce(F.sum(F.when(score.isNotNull(), F.col(WATCHED))), F.lit(0)).cast("bigint").alias("_watched"),
    )


def _added(columns) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def account_sums(days: DataFrame) -> DataFrame:
    """Per account: ``_days`` with sessions, counts, sums and sums of squares of rows of the ``account`` table."""
    by_day = days.groupBy(KEY, DAY).agg(*_added((*SUMS, *SQUARES)))
    return by_day.groupBy(KEY).agg(F.count(DAY).alias("_days"), *_added((*SUMS, *SQUARES)))


def account_scores(days: DataFrame) -> DataFrame:
    """Per account and score in hundredths: the number of sessions."""
    return days.groupBy(KEY, "_score").agg(F.sum("_rows").alias("_rows"))


def moved(before: DataFrame, entering: DataFrame, leaving: DataFrame, keys: list[str]) -> DataFrame:
    """The sums of a window after some days came in and others went out; all three have the same columns.

    Every column but ``keys`` is added up, those of ``leaving`` with a minus. Groups of which nothing is left go.
    """
    values = [c for c in before.columns if c not in keys]
    off = leaving.select(*keys, *[(-F.col(c)).alias(c) for c in values])
    laid = reduce(DataFrame.unionByName, [before.select(*keys, *values), entering.select(*keys, *values), off])
    left = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in values if c in ("_days", "_rows")])
    kinds = dict(before.dtypes)
    return laid.groupBy(*keys).agg(*_added(values)).where(left).select(*keys, *[F.col(c).cast(kinds[c]) for c in values])


def _deviation(n: str, total: Column, squares: str, steps: int) -> Column:
    """Population deviation from whole-number sums. Squares are taken around the mean's whole part, so that equal values
    give exactly zero."""
    count, middle = wide(F.col(n)), F.floor(total / F.when(F.col(n) > 0, F.col(n)).cast("double"))
    middle = middle.cast("decimal(19,0)")
    centred = F.col(squares) - 2 * middle * total + count * middle * middle
    rest = ratio(total - count * middle, F.col(n))
    return F.sqrt(F.greatest(ratio(centred, F.col(n)) - rest * rest, F.lit(0.0))) / steps


def account_quality_of(
    sums: DataFrame, scores: DataFrame, legacy: bool = False, normalised: bool = False, score_steps: int = SCORE_STEPS
) -> DataFrame:
    """``quality.account_quality`` from ``account_sums`` and ``account_scores`` of a window."""
    total, watched = F.col("_sum").cast("decimal(19,0)"), joined_parts(F.col("_whigh"), F.col("_wlow"))
    own = sums.select(
        KEY, F.col("_days").alias("active_day_cnt"), or_zero(_deviation("_n", total, "_squares", score_steps)).alias("mos_std_dev_acct"),
        or_zero(ratio(total, F.col("_n")) / score_steps).alias("avg_mos_acct"),
        or_zero(ratio(watched, F.col("_wn")) / score_steps).alias("weighted_avg_mos_acct"),
        or_zero(_deviation("_wn", watched, "_wsquares", score_steps)).alias("weighted_std_dev_acct"),
        *([(ratio(watched, F.when(F.col("_n") > 0, F.col("_watched"))) / score_steps).alias("weighted_mean_norm")] if normalised else []),
    )
    points = scores.groupBy(KEY).agg(F.percentile("_score", F.array(F.lit(0.1), F.lit(0.9)), F.col("_rows")).alias("_points"))
    low, high = (F.get("_points", F.lit(i)) for i in (0, 1))
    points = points.select(
        KEY, (F.array(low) if legacy else low).alias("mos_bottom_10_percentile"), (F.array(high) if legacy else high).alias("mos_top_10_percentile"))
    return own.join(points, KEY)


def account_quality_days(days: DataFrame, legacy: bool = False, normalised: bool = False) -> DataFrame:
    """``quality.account_quality`` of the sessions behind some rows of the ``account`` table."""
    return account_quality_of(account_sums(days), account_scores(days), legacy, normalised)


def peer_compare_days(days: DataFrame, grain: Grain, own: Column | None = None, legacy: bool = False) -> DataFrame:
    """``quality.peer_compare`` of the sessions behind some rows of the grain's table (``TABLE_OF``)."""
    fine = list(PARTS) if set(grain.keys) <= set(PARTS) else list(grain.keys)
    mine = days if own is None else days.where(own)
    accounts = mine.groupBy(KEY, *fine).agg(*_added(SUMS))
    peers = days.groupBy(*fine, "_whole").agg(*_added(("_rows", *SUMS)))
    return compare_groups(accounts, peers, grain, legacy)


def quality_features_days(tables: dict[str, DataFrame], own: Column | None = None, legacy: bool = False) -> DataFrame:
    """An account's own quality and its comparison with peers, as ``plans.matrices.quality_features``, from the rows of
    each table that make up a window."""
    mine = tables["account"] if own is None else tables["account"].where(own)
    by_grain = [peer_compare_days(tables[TABLE_OF[g]], g, own, legacy) for g in GRAINS]
    return union_features([by_grain[0], account_quality_days(mine, legacy), *by_grain[1:]], legacy)


class DayStore:
    """A folder with the tables of ``GROUPS``, one partition per day. ``legacy`` decides the hours of the day parts."""

    def __init__(self, spark: SparkSession, path: str, legacy: bool = False):
        self.spark, self.path, self.legacy = spark, path.rstrip("/"), legacy

    def _path(self, name: str) -> str:
        return f"{self.path}/{name}"

    def build(self, sessions: DataFrame) -> None:
        """All days of the sessions, replacing what is there."""
        self._each(lambda name: write_by_day(day_table(sessions, name, self.legacy), self._path(name), DAY))

    def add_days(self, sessions: DataFrame, days: list) -> None:
        """The given days, in place of what the store has of them. Only these days are read: with sessions that lie
        partitioned by day, only their partitions."""
        own = sessions.where(F.col(DAY).isin([F.lit(d).cast("date") for d in days]))
        self._each(lambda name: replace_days(day_table(own, name, self.legacy), self._path(name), days, DAY))

    def _each(self, job) -> None:
        together(self.spark, [lambda name=name: job(name) for name in GROUPS])

    def tables(self) -> dict[str, DataFrame]:
        return {name: read_table(self.spark, self._path(name)) for name in GROUPS}

    def between(self, first, last) -> dict[str, DataFrame]:
        """The rows of a window; other partitions are not read."""
        return {name: sessions_between(table, first, last) for name, table in self.tables().items()}

    def in_label_windows(self, labels: DataFrame) -> dict[str, DataFrame]:
        """The rows of labelled accounts from the start of each one's window on (``sessions_in_label_window``)."""
        return {name: sessions_in_label_window(labels, table) for name, table in self.tables().items()}
