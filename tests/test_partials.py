"""Day stores, sliding windows, pruned scans and bitmap counts."""

from __future__ import annotations

from datetime import date, timedelta
import os
import random
import statistics

from pyspark.sql import functions as F
import pytest

from staykit.catalog import views as v
from staykit.catalog.queries import Source
from staykit.catalog.settle import settle
from staykit.operators import partials, population as pop, quality as qu, viewing as vi
from staykit.operators.distinct import Dictionary, distinct_counts
from staykit.sources.tables import Workspace, read_table, write_by_day

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture()
def work(spark):
    with Workspace(spark) as made:
        yield made


def rows_of(df):
    return sorted(map(str, settle(df).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scan_metric(df, name):
    """A metric of each file scan of the plan that ran."""
    found = []

    def visit(node):
        if node.nodeName().startswith("Scan parquet") and node.metrics().contains(name):
            found.append(node.metrics().apply(name).value())
        if "AdaptiveSparkPlan" in node.nodeName():
            visit(node.executedPlan())
        if "QueryStage" in node.nodeName():
            visit(node.plan())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))
        subqueries = node.subqueries()
        for i in range(subqueries.size()):
            visit(subqueries.apply(i))

    visit(df._jdf.queryExecution().executedPlan())
    return found


# Pruned scans


def test_the_labels_window_decides_which_files_are_read(spark, work):
    source, path = Source(spark, SF_DIR), work.new_path("sessions")
    write_by_day(source.sessions, path)
    days = [d for d in os.listdir(path.removeprefix("file:")) if d.startswith("activity_date=")]
    labels = work.store(source.labels.withColumn("min_agg_date", F.lit(date(2024, 1, 27))), "labels")
    found = pop.sessions_in_label_window(labels, read_table(spark, path))
    assert "PartitionFilters: [isnotnull(activity_date" in plan(found) and "subquery" in plan(found)
    found.collect()
    late = [d for d in days if d >= "activity_date=2024-01-27" and "HIVE" not in d]
    assert 0 < len(late) < len(days) / 3 and len(late) in scan_metric(found, "numPartitions")
    assert sum(len([f for f in os.listdir(f"{path.removeprefix('file:')}/{d}") if f.endswith(".parquet")]) for d in late) in scan_metric(found, "numFiles")


def test_a_fixed_window_prunes_too(spark, work):
    path = work.new_path("sessions")
    write_by_day(Source(spark, SF_DIR).sessions, path)
    window = pop.sessions_between(read_table(spark, path), v.FIRST, v.AS_OF)
    window.collect()
    assert scan_metric(window, "numPartitions") == [15]


# Day stores


def sessions_frame(spark, seed=1, count=400):
    r, first = random.Random(seed), date(2024, 1, 1)
    rows = [
        (f"a{r.randint(0, 9)}", first + timedelta(r.randint(0, 5)), r.choice([None, 1.0, 2.5, 3.33, 4.99, 5.0]), r.choice([None, 0, 1000, 3_600_000]),
         r.choice([None, "s1", "s2"]), r.choice(["c1", "c2"]), 1_704_000_000 + r.randint(0, 500_000))
        for _ in range(count)
    ]
    rows += [("same", first, 4.2, 86_400_000, "s1", "c1", 1_704_000_000)] * 50 + [("none", first, None, None, None, None, None), ("dayless", None, 1.0, 1, "s1", "c1", 1)]
    schema = "account_guid string, activity_date date, mos_score double, watch_time_ms long, stream_id string, channel_number string, start_timestamp long"
    return spark.createDataFrame(rows, schema), rows


def test_a_store_gives_what_the_sessions_give(spark, work):
    sessions, rows = sessions_frame(spark)
    store = partials.DayStore(spark, work.new_path("days"))
    store.build(sessions)
    dated = sessions.where("activity_date IS NOT NULL")
    for legacy in (False, True):
        assert rows_of(partials.account_quality_days(store.tables()["account"], legacy, True)) == rows_of(qu.account_quality(dated, legacy, True))
    parted = qu.with_day_and_week_part(dated)
    for grain in qu.GRAINS:
        assert rows_of(partials.peer_compare_days(store.tables()[partials.TABLE_OF[grain]], grain)) == rows_of(qu.peer_compare(parted, grain))
    found = {r.account_guid: r for r in partials.account_quality_days(store.tables()["account"]).collect()}
    assert found["same"].mos_std_dev_acct == 0 and found["same"].weighted_std_dev_acct == 0 and found["none"].active_day_cnt == 1
    scores = [r[2] for r in rows if r[0] == "a3" and r[2] is not None]
    assert found["a3"].mos_std_dev_acct == pytest.approx(statistics.pstdev(scores), abs=1e-9)


def test_windows_slide_exactly(spark, work):
    sessions, _ = sessions_frame(spark, 2)
    store = partials.DayStore(spark, work.new_path("days"))
    store.build(sessions)
    days = store.tables()["account"]
    whole = lambda first, last: pop.sessions_between(days, first, last)
    for reduced, keys in ((partials.account_sums, ["account_guid"]), (partials.account_scores, ["account_guid", "_score"])):
        before, entering, leaving = (reduced(whole(*w)) for w in (("2024-01-01", "2024-01-04"), ("2024-01-05", "2024-01-06"), ("2024-01-01", "2024-01-02")))
        slid = partials.moved(before, entering, leaving, keys)
        wanted = reduced(whole("2024-01-03", "2024-01-06"))
        assert slid.dtypes == wanted.select(*slid.columns).dtypes and rows_of(slid) == rows_of(wanted.select(*slid.columns))


def test_adding_a_day_reads_that_day_only(spark, work):
    """Sessions that lie by day: the files of all other days are broken, and still the day is added."""
    sessions, _ = sessions_frame(spark, 3)
    dated, path = sessions.where("activity_date IS NOT NULL"), work.new_path("sessions")
    write_by_day(dated, path)
    store = partials.DayStore(spark, work.new_path("days"))
    store.build(dated.where("activity_date <> '2024-01-03'"))
    folder = path.removeprefix("file:")
    by_day = read_table(spark, path)
    for day in os.listdir(folder):
        if day.startswith("activity_date=") and day != "activity_date=2024-01-03":
            for name in os.listdir(f"{folder}/{day}"):
                if name.endswith(".parquet"):
                    os.chmod(f"{folder}/{day}/{name}", 0o644)
                    with open(f"{folder}/{day}/{name}", "wb") as file:
                        file.write(b"broken")
                    os.path.exists(f"{folder}/{day}/.{name}.crc") and os.remove(f"{folder}/{day}/.{name}.crc")
    with pytest.raises(Exception):
        by_day.agg(F.sum("mos_score")).collect()
    store.add_days(by_day, ["2024-01-03"])
    assert rows_of(partials.account_quality_days(store.tables()["account"])) == rows_of(qu.account_quality(dated))


def test_a_day_is_replaced_not_added_twice(spark, work):
    sessions, _ = sessions_frame(spark, 4)
    dated, store = sessions.where("activity_date IS NOT NULL"), partials.DayStore(spark, work.new_path("days"))
    store.build(dated)
    for _ in range(2):
        store.add_days(dated, [date(2024, 1, 2), "2024-01-05"])
    assert rows_of(partials.account_quality_days(store.tables()["account"])) == rows_of(qu.account_quality(dated))
    window = store.between("2024-01-02", "2024-01-02")["account"]
    window.collect()
    assert scan_metric(window, "numPartitions") == [1]


# Bitmap counts


@pytest.mark.parametrize("values", [3, 700, 5_000, 70_000])
def test_bitmaps_count_what_count_distinct_counts(spark, work, values):
    rows = spark.range(200_000).select(
        (F.col("id") % 7).cast("string").alias("k"), F.when(F.col("id") % 11 > 0, F.concat(F.lit("v"), F.pmod(F.xxhash64("id"), F.lit(values)))).alias("x"),
        F.expr("CAST(NULL AS STRING)").alias("y"), F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 90).cast("int")).alias("d"))
    dictionary = Dictionary(spark, work.new_path("ids")).extend(rows, ["x", "y", "d"], work)
    found = distinct_counts(rows, ["k"], {"x": "nx", "y": "ny", "d": "nd"}, dictionary)
    wanted = rows.groupBy("k").agg(F.count_distinct("x").alias("nx"), F.count_distinct("y").alias("ny"), F.count_distinct("d").alias("nd"))
    assert rows_of(found) == rows_of(wanted)
    assert "Expand" not in plan(found)


def test_ids_stay_when_the_dictionary_grows(spark, work):
    frame = lambda values: spark.createDataFrame([(x,) for x in values], "x string")
    dictionary = Dictionary(spark, work.new_path("ids")).extend(frame(["b", "a", None, "b"]), ["x"], work)
    assert sorted(tuple(r) for r in dictionary.table().collect()) == [("x", "a", 0), ("x", "b", 1)]
    dictionary.extend(frame(["c", "a", "0"]), ["x"], work)
    assert sorted((r.value, r.id) for r in dictionary.table().collect()) == [("0", 2), ("a", 0), ("b", 1), ("c", 3)]
    dictionary.extend(frame([None]), ["x"], work)
    assert dictionary.sizes(["x", "other"]) == {"x": 4, "other": 0}


def test_viewing_distinct_does_not_expand(spark, work):
    windowed = Source(spark, SF_DIR).windowed
    dictionary = Dictionary(spark, work.new_path("ids")).extend(windowed, ["activity_date", *vi.DISTINCTS], work)
    found = vi.viewing_distinct(windowed, 15, dictionary)
    assert "Expand" not in plan(found) and "Expand" in plan(vi.viewing_distinct(windowed, 15))
    assert rows_of(found) == rows_of(vi.viewing_distinct(windowed, 15))
    assert rows_of(vi.viewing_profile(windowed, 15, dictionary)) == rows_of(vi.viewing_profile(windowed, 15))
