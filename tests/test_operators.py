"""Operators on hand-made rows: one test per edge of the feature definitions."""

from __future__ import annotations

from datetime import date
import math

from pyspark.sql import functions as F
import pytest

from staykit.functions.keys import OPERATORS
from staykit.operators import changes as ch, quality as qu, viewing as vi
from staykit.operators.assemble import attach, one_per_account, union_features
from staykit.operators.calls import call_profile
from staykit.operators.population import (
    active_accounts, eligible_by_package, eligible_streaming, exclude_accounts, label_windows, labelled_sessions,
    sessions_in_label_window, sessions_of, with_account_guid,
)
from staykit.operators.promo import promo_profile
from staykit.operators.search import search_features
from staykit.sources import schemas

DAY = date(2024, 1, 10)


def table(spark, schema, *rows):
    """Rows given as dicts; absent columns are NULL."""
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def sessions(spark, *rows):
    base = {"operator": "OP_B", "activity_date": DAY, "playback_type": "linear", "start_timestamp": 1517400000}
    return with_account_guid(table(spark, schemas.SESSIONS, *[{**base, **r} for r in rows]))


def by_account(df, column=None):
    rows = {r["account_guid"]: r for r in df.collect()}
    return {k: r[column] for k, r in rows.items()} if column else rows


def test_label_windows(spark):
    labels = table(spark, schemas.LABELS, {"account_guid": "a", "churn_date": ""}, {"account_guid": "b", "churn_date": "2024-01-05"})
    found = by_account(label_windows(labels, "2024-01-31"))
    assert (found["a"]["min_agg_date"], found["a"]["max_agg_date"]) == (date(2023, 11, 2), date(2024, 1, 31))
    assert (found["b"]["min_agg_date"], found["b"]["max_agg_date"]) == (date(2023, 10, 7), date(2024, 1, 5))


def test_labelled_sessions_keep_labels_without_sessions(spark):
    labels = label_windows(table(spark, schemas.LABELS, {"account_guid": "OP_B::1", "churn_date": ""}, {"account_guid": "OP_B::2", "churn_date": ""}), "2024-01-31")
    rows = sessions(spark, *[{"billing_id": "1", "stream_id": str(i)} for i in range(5)], {"billing_id": "3"})
    joined = labelled_sessions(labels, rows)
    assert sorted((r["account_guid"], r["activity_date"]) for r in joined.collect()) == [("OP_B::1", DAY)] * 5 + [("OP_B::2", None)]
    assert sessions_in_label_window(labels, rows).count() == 5


def test_excluded_accounts(spark):
    rows = sessions(spark, {"billing_id": "1"}, {"billing_id": "2"}, {"billing_id": "3"})
    active = spark.createDataFrame([("OP_B::1",), ("OP_B::2",)], "account_guid string")
    training = spark.createDataFrame([("OP_B::2",)], "account_guid string")
    assert set(by_account(exclude_accounts(rows, active, training))) == {"OP_B::1"}
    assert len(by_account(exclude_accounts(rows, active, training, legacy=True))) == 3
    assert set(by_account(sessions_of(rows, active))) == {"OP_B::1", "OP_B::2"}


def test_active_accounts(spark):
    a, b, c = OPERATORS
    streaming = table(
        spark, schemas.HISTORY,
        {"account_number": "77712", "customer_name": "x", "system": "9", "stream_flag": True, "choice_flag": False, "snapshot_date": DAY},
        {"account_number": "77712", "customer_name": "x", "system": "8", "stream_flag": True, "choice_flag": False, "snapshot_date": DAY},
        {"account_number": "77713", "customer_name": "A TestTool", "stream_flag": True, "choice_flag": False, "snapshot_date": DAY},
        {"account_number": "77714", "customer_name": "x", "stream_flag": False, "choice_flag": False, "snapshot_date": DAY},
        {"account_number": "77715", "customer_name": "x", "stream_flag": False, "choice_flag": True, "snapshot_date": date(2024, 1, 1)},
    )
    package = table(
        spark, schemas.HISTORY,
        {"account_number": "1", "customer_type": "Residential", "file_type": "Residential", "account_type": "x", "video_package_type": "S", "snapshot_date": DAY},
        {"account_number": "2", "customer_type": "Residential", "file_type": "Commercial Business", "account_type": "x", "video_package_type": "S", "snapshot_date": DAY},
        {"account_number": "3", "customer_type": "Commercial", "file_type": "Commercial Business", "account_type": "TEST", "video_package_type": "S", "snapshot_date": DAY},
        {"account_number": "4", "customer_type": "Commercial", "file_type": "Commercial Business", "account_type": None, "video_package_type": "S", "snapshot_date": DAY},
    )
    histories = [(a, streaming, eligible_streaming("testtool")), (b, package, eligible_by_package(["S"]))]
    now = active_accounts(histories, as_of=DAY)
    assert sorted(map(tuple, now.collect())) == [("OP_A::12", "OP_A", "77712", "12", None), ("OP_B::1", "OP_B", "1", "1", None)]
    labels = spark.createDataFrame([("OP_A::15",)], "account_guid string")
    assert set(by_account(active_accounts(histories, labels=labels))) == {"OP_A::15"}
    keyed = active_accounts([(c, streaming, eligible_streaming("testtool"))], as_of=DAY)
    assert set(by_account(keyed)) == {"OP_C::9::000077712", "OP_C::8::000077712"}


def test_account_quality_edges(spark):
    rows = sessions(
        spark, {"billing_id": "one", "mos_score": 3.5, "watch_time_ms": 10}, {"billing_id": "none", "watch_time_ms": 10},
        {"billing_id": "two", "mos_score": 1.0, "watch_time_ms": 10}, {"billing_id": "two", "mos_score": 2.0, "watch_time_ms": 40},
    )
    found = by_account(qu.account_quality(rows, normalised=True))
    one, none, two = (found[f"OP_B::{n}"] for n in ("one", "none", "two"))
    assert one["mos_std_dev_acct"] == 0 and one["mos_bottom_10_percentile"] == one["mos_top_10_percentile"] == 350
    assert (none["avg_mos_acct"], none["weighted_std_dev_acct"], none["mos_top_10_percentile"]) == (0, 0, None)
    assert (two["avg_mos_acct"], two["weighted_avg_mos_acct"], two["weighted_mean_norm"]) == (1.5, 45.0, 1.8)
    assert two["mos_bottom_10_percentile"] == pytest.approx(110)
    legacy = by_account(qu.account_quality(rows, legacy=True))
    assert legacy["OP_B::one"]["mos_top_10_percentile"] == [350.0]


def brute_peers(rows, key, inclusive, legacy):
    """The definition, over Python rows (account, key, day, score, watch)."""
    def mean(values):
        return sum(values) / len(values) if values else None

    def percentile(values, p):
        values = sorted(values)
        at = (len(values) - 1) * p
        low, high = values[math.floor(at)], values[math.ceil(at)]
        return low + (high - low) * (at - math.floor(at))

    out = {}
    for account in {r[0] for r in rows}:
        groups = {(r[1], r[2]) for r in rows if r[0] == account}
        bigger = total = below = above = 0
        powers, means = [], 0
        for g in groups:
            own = [r[3] for r in rows if r[0] == account and (r[1], r[2]) == g and r[3] is not None]
            peers = [r[3] for r in rows if (r[1], r[2]) == g and r[3] is not None] if None not in g else []
            m, p = mean(own), mean(peers)
            if m is None:
                continue
            means += 1
            if p is None:
                continue
            bigger += m > p
            total += sum(own) - sum(peers)
            powers.append(2 ** (m - p) if legacy else (m - p) ** 2)
            tails = [math.floor(x + 0.5) for x in peers]
            low, high = percentile(tails, 0.1), percentile(tails, 0.9)
            if legacy:
                low, high = high, None
            below += m <= low if inclusive else m < low
            above += 0 if high is None else (m >= high if inclusive else m > high)
        days = len({r[2] for r in rows if r[0] == account})
        out[account] = (bigger / days, total / days if powers else None, math.sqrt(sum(powers) / means) if powers else None, below, above)
    return out


@pytest.mark.parametrize("grain, key", [(qu.BY_STREAM, "stream_id"), (qu.BY_CHANNEL, "channel_number")])
@pytest.mark.parametrize("legacy", [False, True])
def test_peer_compare_against_brute_force(spark, grain, key, legacy):
    """A third of the rows sit in one group on one day."""
    raw = []
    for i in range(240):
        hot = i % 3 == 0
        raw.append((
            f"OP_B::{i % 17}", "g0" if hot else (None if i % 29 == 1 else f"g{i % 7}"), date(2024, 1, 1 if hot else 1 + i % 5),
            None if i % 13 == 5 else 1 + (i * 37 % 400) / 100, i * 1000,
        ))
    rows = sessions(spark, *[
        {"billing_id": a[6:], key: g, "activity_date": d, "mos_score": s, "watch_time_ms": w} for a, g, d, s, w in raw
    ])
    found = by_account(qu.peer_compare(rows, grain, legacy=legacy))
    names = ["cnt_acct_bigger", "avg_acct_bigger", "std_dev_acct", "avg_mos_bottom_10", "avg_mos_top_10"]
    for account, values in brute_peers(raw, key, grain.inclusive, legacy).items():
        mine = [found[account][f"mos_comp_{grain.name}_{n}"] for n in names]
        assert mine == pytest.approx(list(values), rel=1e-9), account


def test_peers_outside_the_own_window(spark):
    rows = sessions(
        spark, {"billing_id": "1", "channel_number": "5", "mos_score": 4.0, "watch_time_ms": 1},
        {"billing_id": "2", "channel_number": "5", "mos_score": 2.0, "watch_time_ms": 1},
    )
    found = by_account(qu.peer_compare(rows, qu.BY_CHANNEL, own=F.col("billing_id") == "1"))
    assert set(found) == {"OP_B::1"}
    assert found["OP_B::1"]["mos_comp_channel_std_dev_acct"] == 1.0


def test_viewing_edges(spark):
    rows = sessions(
        spark, {"billing_id": "1", "watch_time_ms": 5, "level2_downshifts": 0, "user_cancels_stream": True},
        {"billing_id": "1", "watch_time_ms": 5, "level2_downshifts": 0, "playback_type": "vod"},
    )
    found = by_account(vi.viewing_profile(rows, 10))["OP_B::1"]
    assert len(found) == 1 + 73
    assert found["watch_time_per_level2_downshift"] is None
    assert (found["sum_user_stream_cancel"], found["sum_user_stream_not_cancel"]) == (1, 0)
    assert found["sum_linear"] + found["sum_vod"] <= found["total_stream_count_date"] == 2
    assert found["dist_date_percent"] == 0.1


def test_top_channel_tie_and_variability(spark):
    rows = sessions(spark, *[{"billing_id": "1", "guide_id": g, "watch_time_ms": 7} for g in ("9", "3", "5")],
                    {"billing_id": "1", "guide_id": None, "watch_time_ms": 99})
    assert by_account(vi.top_channel(rows), "top_channel_watch_time") == {"OP_B::1": "3"}
    assert by_account(vi.channel_variability(rows), "avg_std_channel") == {"OP_B::1": 0.0}


def change_rows(spark, *rows):
    base = {"operator": "OP_A", "billing_id": "1", "account_number": "7771", "change_event_date": DAY}
    return with_account_guid(table(spark, schemas.CHANGES, *[{**base, **r} for r in rows]), "system")


def test_never_logged_in_is_null_safe(spark):
    changes = change_rows(spark, {"tv_stream_package": 1}, {"tv_stream_package": 1, "billing_id": "2"}, {"billing_id": "3"})
    usage = table(spark, schemas.USAGE, {"operator": "OP_A", "billing_id": "1"})
    args = (usage, changes, date(2024, 1, 1), DAY)
    assert by_account(vi.never_logged_in(*args), "never_logged_in") == {"OP_A::2": 1}
    assert set(by_account(vi.never_logged_in(*args, legacy=True))) == {"OP_A::1", "OP_A::2"}


def test_change_profile_ties_and_systems(spark):
    changes = change_rows(
        spark, {"internet_package": 1, "total_price": 1}, {"internet_package": -1},
        {"internet_package": 1, "change_event_date": date(2023, 1, 1)},
    )
    found = by_account(ch.change_profile(changes, DAY))
    assert len(found["OP_A::1"]) == 1 + 43
    assert found["OP_A::1"]["most_recent_internet_package_change"] == 1
    assert (found["OP_A::1"]["internet_package_adds"], found["OP_A::1"]["internet_package_drop"]) == (2, 1)
    assert ch.change_profile(changes, DAY, legacy=True).count() == 0  # no billing system
    with_system = changes.withColumn("system", F.lit("5"))
    assert ch.change_profile(with_system, DAY, legacy=True).count() == 2  # the tie stays


def test_calls(spark):
    calls = table(spark, schemas.CALLS, *[
        {"company_code": code, "subaccount": n, "call_date": d, "days_since_install": g}
        for code, n, d, g in [("C", "12", DAY, 5), ("C", "12", DAY, 3), ("C", "99", DAY, 1), ("B", "7", DAY, 2), ("Z", "8", DAY, 2), ("B", "7", date(2024, 1, 12), 4)]
    ])
    history = table(spark, schemas.HISTORY, *[{"account_number": "12", "system": "4"}] * 3)
    found = by_account(call_profile(calls, history, as_of="2024-01-31"))
    assert set(found) == {"OP_C::4::000000012", "OP_B::7"}
    c, b = found["OP_C::4::000000012"], found["OP_B::7"]
    assert (c["total_calls"], c["total_same_day_calls"], c["time_from_install_to_first_call"]) == (2, 1, 3)
    assert (b["call_tenure"], b["count_days_when_called"], b["avg_call_date"]) == (2, 2, 20240111.0)
    legacy = by_account(call_profile(calls, history, as_of="2024-01-31", legacy=True), "total_calls")
    assert legacy == {"OP_C::4::000000012": 6, "OP_C": 1, "OP_B::7": 2, None: 1}
    labels = label_windows(table(spark, schemas.LABELS, {"account_guid": "OP_B::7", "churn_date": ""}), "2024-01-12")
    assert by_account(call_profile(calls, history, labels=labels), "total_calls") == {"OP_B::7": 1}
    assert call_profile(calls, history, labels=labels, legacy=True).count() == 0


def test_promo_newest_row(spark):
    rows = [
        {"snapshot_date": date(2024, 1, d), "promotion_description": p, "dwelling": w, "zip_code": z, "zip_code_4": "0", "truck_call_count": 2}
        for d, p, w, z in [(1, "AR", "flat", "1"), (2, "no", "house", "2"), (2, "AY", "flat", "2"), (2, "Unkown", "tent", "9"), (2, None, "yurt", "9")]
    ]
    history = table(spark, schemas.HISTORY, *[{"account_number": "5", **r} for r in rows])
    found = promo_profile(history, OPERATORS[1], "(.*)(AR|AY)(.*)", F.lit(True)).collect()
    assert [tuple(r) for r in found] == [("OP_B::5", "5", "OP_B", 2, 6, 2, "yurt", 0)]
    legacy = promo_profile(history, OPERATORS[1], "(.*)(AR|AY)(.*)", F.lit(True), legacy=True)
    assert legacy.count() == 4  # one per distinct newest state
    only_unknown = history.where("promotion_description = 'Unkown'")
    assert promo_profile(only_unknown, OPERATORS[1], "(.*)(AR)(.*)", F.lit(True)).count() == 0


def test_search(spark):
    pages = with_account_guid(table(
        spark, schemas.PAGES,
        {"operator": "OP_B", "billing_id": "1", "visit_id": "v", "search_id": "s", "operation_type": "searchEntered", "activity_date": DAY,
         "search_text_list": ["op||q||0||10", "op||q||3||x", None, "bad"]},
        {"operator": "OP_B", "billing_id": "1", "visit_id": "w", "search_id": None, "operation_type": "searchEntered", "activity_date": DAY,
         "search_text_list": ["op||q||0||10"]},
        {"operator": "OP_B", "billing_id": "1", "visit_id": "w", "search_id": "t", "operation_type": "pageView", "activity_date": DAY,
         "search_text_list": ["op||q||0||10"]},
    ))
    r = by_account(search_features(pages, DAY, DAY))["OP_B::1"]
    assert (r["sum_unique_searches"], r["sum_search_entered_returned_no_results"], r["sum_search_entered_selected_results"]) == (1, 1, 1)
    assert (r["sum_search_response_time_ms"], r["avg_search_response_time_ms"]) == (10.0, 10.0)


def test_union_has_one_row_per_account_in_every_subset(spark):
    """Accounts 1..7 are in the tables their bits name."""
    tables = [
        spark.createDataFrame([(str(i), i * 10 + b) for i in range(1, 8) if i >> b & 1], f"account_guid string, c{b} int")
        for b in range(3)
    ]
    rows = {r["account_guid"]: tuple(r)[1:] for r in union_features(tables).collect()}
    assert rows == {str(i): tuple(i * 10 + b if i >> b & 1 else None for b in range(3)) for i in range(1, 8)}
    assert union_features(tables).count() == 7
    assert union_features(tables, legacy=True).where("account_guid IS NULL").count() > 0


def test_attach_keeps_the_spine(spark):
    spine = spark.createDataFrame([("1",), ("2",)], "account_guid string")
    a = spark.createDataFrame([("2", 5)], "account_guid string, a int")
    b = spark.createDataFrame([("1", 6), ("9", 7)], "account_guid string, b int")
    assert {tuple(r) for r in attach(spine, [a, b]).collect()} == {("1", None, 6), ("2", 5, None)}
    assert {tuple(r) for r in attach(spine, [a, b], legacy=True).collect()} == {("1", None, None), ("2", 5, None)}


def test_gaps_of_literal_joins_are_spread(spark):
    """Of 2,000 accounts ten are in the second table: the others have no key to go on with, and stay where they are."""
    def ids(n, name):
        return spark.range(n).select(F.concat(F.lit("a"), "id").alias("account_guid"), F.col("id").alias(name))

    many, few, all_ = ids(2000, "a"), ids(10, "b"), ids(2000, "c")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, value in settings.items():
        spark.conf.set(k, value)
    try:
        chained = attach(many, [few, all_], legacy=True)
        assert sorted(map(tuple, chained.collect())) == sorted((f"a{i}", i, *[i if i < 10 else None] * 2) for i in range(2000))
        whole = union_features([many, few, all_], legacy=True)
        rows = [(f"a{i}", i, *[i if i < 10 else None] * 2) for i in range(2000)] + [(None, None, None, i) for i in range(10, 2000)]
        assert sorted(map(tuple, whole.collect()), key=str) == sorted(rows, key=str)
        for df, limit in ((chained, 600), (whole, 1200)):
            most = df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
            assert most < limit
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)


def test_one_per_account(spark):
    rows = spark.createDataFrame([("1", "a", None), ("1", "a", "z"), ("2", "b", "c")], "account_guid string, o string, s string")
    assert {tuple(r) for r in one_per_account(rows).collect()} == {("1", "a", "z"), ("2", "b", "c")}
