"""Readers, writers and the work folder."""

from __future__ import annotations

from datetime import date
import os

from pyspark.sql import functions as F
import pytest

from staykit.sources import schemas, tables


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "k string, n int, t string")
    tables.write_tsv(df, str(tmp_path / "t"))
    assert {tuple(r) for r in tables.read_tsv(spark, str(tmp_path / "t"), df.schema).collect()} == {("a", 1, None), ("b", 2, "x")}


def test_delimited_with_new_names(spark, tmp_path):
    (tmp_path / "f").write_text("x|y\n1|2\n3|4\n")
    df = tables.read_delimited(spark, str(tmp_path / "f"), ["churn", "id"])
    assert df.columns == ["churn", "id"] and df.count() == 2


def test_rebuild_and_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(20).select("id", F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 4).cast("int")).alias("d"))
    for _ in range(2):
        tables.rebuild_table(df, path, partition_by="d")
    day = tables.on_date(tables.read_table(spark, path), "d", "2024-01-02")
    assert day.count() == 5
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan
    assert tables.since_date(tables.read_table(spark, path), "d", date(2024, 1, 3)).count() == 10


def test_sql_with_parameters(spark):
    df = spark.range(10)
    assert tables.run_sql(spark, "SELECT * FROM {t} WHERE id > :low", {"low": 6}, t=df).count() == 3


def test_conform(spark):
    raw = spark.createDataFrame([("7", "2024-01-01", "1")], "acct string, day string, flag string")
    changes = tables_row = schemas.conform(raw, schemas.CHANGES, {"acct": "billing_id", "day": "change_event_date", "flag": "total_price"})
    row = changes.first()
    assert tables_row.schema == schemas.CHANGES
    assert (row["billing_id"], row["change_event_date"], row["total_price"], row["system"]) == ("7", date(2024, 1, 1), 1, None)


def test_session_layout_has_every_metric():
    assert len(schemas.SESSIONS.fields) == 14 + 1 + 3 + 3 + 8 + 24 + 3


def test_workspace_cuts_lineage_and_clears(spark, tmp_path):
    with tables.Workspace(spark) as work:
        df = work.store(spark.range(5).withColumn("x", F.col("id") * 2), "t")
        assert "Range" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 5 and tables.work_folder(spark) in df.inputFiles()[0]
        folder = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_work_folder_follows_the_session(spark):
    assert tables.work_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_failed_rebuild_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.rebuild_table(spark.range(5), path)
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no")).cast("long")).alias("id"))
    for name in (path, "rebuilt_numbers"):
        tables.rebuild_table(spark.range(5), name)
        with pytest.raises(Exception, match="no"):
            tables.rebuild_table(broken, name)
        assert rows_of(tables.read_table(spark, name)) == [(i,) for i in range(5)]
    assert os.listdir(tmp_path) == ["t"] and not [t for t in spark.catalog.listTables() if t.name.startswith("rebuilt_numbers_")]
    tables.rebuild_table(spark.range(2), "rebuilt_numbers")
    assert spark.table("rebuilt_numbers").count() == 2
    spark.sql("DROP TABLE rebuilt_numbers")


def test_a_table_can_be_rebuilt_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.rebuild_table(spark.range(5), path)
    tables.rebuild_table(tables.read_table(spark, path).where("id > 2"), path)
    assert rows_of(tables.read_table(spark, path)) == [(3,), (4,)]


def test_a_rebuild_cut_short_is_put_back(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.rebuild_table(spark.range(3), path)
    os.rename(path, path + ".old-1")  # the state between the two renames
    spark.range(7).write.parquet(path + ".new-1")
    assert tables.read_table(spark, path).count() == 3


DAYS = [date(2024, 1, d) for d in (1, 2, 3, 4)]


def by_day(spark, extra=0):
    return spark.range(40).select((F.col("id") + extra).alias("id"), F.element_at(F.lit(DAYS), (F.col("id") % 4 + 1).cast("int")).alias("day"))


def test_one_day_is_replaced_and_others_are_not_touched(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_by_day(by_day(spark), path, "day")
    times = {d: max(os.stat(f"{path}/day={d}/{f}").st_mtime_ns for f in os.listdir(f"{path}/day={d}")) for d in DAYS}
    new = by_day(spark, 100).where(F.col("day") == DAYS[1])
    tables.replace_days(new, path, [DAYS[1], "2024-01-04"], "day")
    expected = [r for r in rows_of(by_day(spark)) if r[1] not in (DAYS[1], DAYS[3])] + rows_of(new)
    assert rows_of(tables.read_table(spark, path)) == sorted(expected)
    for d in (DAYS[0], DAYS[2]):
        assert times[d] == max(os.stat(f"{path}/day={d}/{f}").st_mtime_ns for f in os.listdir(f"{path}/day={d}"))


def test_rows_of_another_day_are_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_by_day(by_day(spark), path, "day")
    with pytest.raises(Exception, match="a row of a day that is not replaced"):
        tables.replace_days(by_day(spark, 100), path, [DAYS[1]], "day")
    with pytest.raises(Exception, match="NULL"):
        tables.replace_days(by_day(spark).withColumn("day", F.lit(None).cast("date")), path, [DAYS[1]], "day")
    assert rows_of(tables.read_table(spark, path)) == rows_of(by_day(spark))


def test_clustered_tables_join_without_a_shuffle(spark):
    work, limit = tables.Workspace(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = spark.range(500).select((F.col("id") % 50).cast("string").alias("k"), "id")
        made = work.store_all_clustered({"one": rows, "two-parts": rows.select("k", F.lit(1).alias("n")).distinct()}, "k")
        joined = made["one"].join(made["two-parts"], "k", "left").groupBy("k").agg(F.sum("n").alias("n"))
        assert rows_of(joined) == rows_of(rows.groupBy("k").count())
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        databases = [d.name for d in spark.catalog.listDatabases()]
        work.clear()
        assert len(spark.catalog.listDatabases()) == len(databases) - 1 and not os.path.exists(work.path)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_one_table_of_a_workspace_is_dropped(spark):
    with tables.Workspace(spark) as work:
        one, two = work.store(spark.range(3), "one"), work.store(spark.range(4), "two")
        work.drop(one, spark.read.parquet("/root/testdata/sf0.001/nation.parquet"))
        assert len(os.listdir(work.path)) == 1 and two.count() == 4 and os.path.exists("/root/testdata/sf0.001/nation.parquet")
