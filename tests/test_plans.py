"""Physical plans: what must reach the scan, and how aggregates and rankings are shuffled."""

from __future__ import annotations

import re

from staykit.catalog.queries import Source
from staykit.operators import changes as ch, quality as qu, viewing as vi
from staykit.catalog import views as v
from staykit.plans.matrices import quality_features as quality_plan, scoring_matrix, training_matrix, viewing_features as vi_plan
from staykit.sources.tables import Workspace

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(qu.account_quality(Source(spark, SF_DIR).windowed))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-11T00:00)" in text
    assert all("props" not in schema for schema in re.findall(r"ReadSchema: \S+", text))


def test_every_aggregate_combines_before_its_shuffle(spark):
    source = Source(spark, SF_DIR)
    for df in (qu.account_quality(source.windowed), vi.viewing_profile(source.windowed, 15), vi.top_channel(source.windowed)):
        text = plan(df)
        for below in re.findall(r"Exchange hashpartitioning[^\n]*\n[^\n]*", text):
            assert "partial_" in below or "HashAggregate" in below or "WindowGroupLimit" in below, below


def test_top_channel_limits_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(vi.top_channel(Source(spark, SF_DIR).windowed))


def test_code_generation_covers_the_wide_aggregates(spark):
    """More than 100 fields in one operator would fall back to interpretation."""
    text = plan(vi.viewing_profile(Source(spark, SF_DIR).windowed, 15))
    aggregates = re.findall(r"^.*HashAggregate\(.*$", text, re.M)
    assert aggregates and not [a for a in aggregates if "ObjectHash" in a or "Sort" in a]


def scans(text):
    return len(re.findall(r"FileScan parquet", text))


def test_no_sort_aggregation_of_features(spark):
    source = Source(spark, SF_DIR)
    viewing = vi_plan(source.windowed, source.table("usage"), source.changes, "2023-11-01", "2024-01-25", 15)
    for df in (viewing, ch.change_profile(source.changes, "2024-01-25"), ch.change_latest(source.changes)):
        assert "SortAggregate" not in plan(df)


def test_quality_reads_the_sessions_eight_times(spark):
    """Counted in the plan that ran, where equal shuffles are read again instead of made again."""
    df = quality_plan(Source(spark, SF_DIR).windowed)
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    assert scans(text) <= 8


def test_links_of_the_matrices_do_not_shuffle(spark):
    """The layers are clustered by account, so the chain of joins reads them where they lie."""
    inputs, limit = Source(spark, SF_DIR).inputs(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        with Workspace(spark) as work:
            training = training_matrix(inputs, v.AS_OF, v.FIRST_CHANGE, v.LABEL_DAYS, v.PROMO_SINCE, layers=work)
            scoring = scoring_matrix(inputs, v.FIRST, v.AS_OF, v.PERIOD_DAYS, layers=work)
            for matrix in (training, scoring):
                rows = matrix.count()
                text = plan(matrix)
                assert rows and text.count("SortMergeJoin") >= 5 and "Exchange" not in text, text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_scored_sessions_are_not_shuffled(spark, monkeypatch):
    """The few scored accounts are known by then, so sessions are left out where they lie, in as many tasks as read them."""
    stored, store = {}, Workspace.store

    def noted(work, df, name="table"):
        stored[name] = df
        return store(work, df, name)

    monkeypatch.setattr(Workspace, "store", noted)
    source = Source(spark, SF_DIR)
    with Workspace(spark) as work:
        scoring_matrix(source.inputs(), v.FIRST, v.AS_OF, v.PERIOD_DAYS, training=source.training_labels, layers=work)
        text = plan(stored["scoring-sessions"])
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text, text


def test_promotion_profiles_read_each_history_once(spark):
    """Three operators' histories, each of two test tables, and one shuffle for all of them."""
    text = plan(Source(spark, SF_DIR).inputs().promo(since=v.PROMO_SINCE))
    assert scans(text) == 6 and "Window" not in text
    assert len(re.findall(r"Exchange hashpartitioning\(account_guid", text)) == 1
