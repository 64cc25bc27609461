"""Model frame, selection, search and evaluation on planted data."""

from __future__ import annotations

import inspect
import math
import os

import duckdb
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, RandomForestClassificationModel
from pyspark.sql import functions as F
import pytest

from staykit.catalog import oracles, queries
from staykit.models import forests, frame
from staykit.models.evaluation import gains, score_histogram, threshold_report
from staykit.models.boruta import _blocks, binomial_tail, boruta_select, can_decide, false_discovery, tree_count, with_shadows
from staykit.operators.ranking import exact_rank
from staykit.sources.tables import Workspace, read_names, write_names

FEATURES = ["signal", "other", "noise_a", "noise_b"]


@pytest.fixture()
def work(spark):
    with Workspace(spark) as made:
        yield made


@pytest.fixture(scope="module")
def planted(spark):
    """``churn`` follows ``signal`` and ``other``; the noise columns come from unrelated hashes, chosen so that their
    sample correlation with the label is below 0.01."""
    def uniform(salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1000)) / 1000

    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("account_guid"),
        *[uniform(salt).alias(name) for salt, name in zip((0, 1, 4, 5), FEATURES)],
    )
    return rows.withColumn("churn", (F.col("signal") + 0.5 * F.col("other") > 0.8).cast("int")).cache()


def test_split_is_disjoint_covering_and_stable(planted):
    split = frame.hash_split(planted, "account_guid", seed=3)
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(counts.values()) == 3000 and set(counts) == {"train", "valid", "test"}
    assert 0.75 < counts["train"] / 3000 < 0.85
    again = frame.hash_split(planted.repartition(5), "account_guid", seed=3)
    assert split.select("account_guid", "split").exceptAll(again.select("account_guid", "split")).isEmpty()


def test_boruta_keeps_signal_and_drops_noise(planted, spark, tmp_path):
    chosen = boruta_select(planted, FEATURES, max_rounds=12, trees=20)
    assert set(chosen.accepted) == {"signal", "other"}
    assert not set(chosen.accepted) & set(chosen.rejected)
    again = boruta_select(planted, FEATURES, max_rounds=12, trees=20)
    assert again == chosen
    write_names(spark, ["churn", *chosen.accepted], str(tmp_path / "keep"))
    assert read_names(spark, str(tmp_path / "keep")) == ["churn", *chosen.accepted]


def test_model_chain_has_rounds_enough_to_decide(planted, monkeypatch, spark):
    """With all hits or none the selection's test passes for the least favoured of several features."""
    def caught(*args, **named):
        call = inspect.signature(boruta_select).bind(*args, **named)
        call.apply_defaults()
        raise StopIteration(call.arguments["max_rounds"], len(call.arguments["features"]))

    ruled = planted.withColumns({c: F.lit(1) for c in queries.SIGNALS})
    monkeypatch.setattr(queries, "training_matrix", lambda *_, **__: ruled)
    monkeypatch.setattr(queries, "boruta_select", caught)
    with pytest.raises(StopIteration) as stopped:
        queries.model_chain(spark, "/root/testdata/sf0.001")
    rounds, features = stopped.value.args
    assert binomial_tail(rounds, rounds) <= 0.05 / max(rounds, features)


def test_rounds_that_cannot_decide_are_not_run():
    """Against every number of hits that the rounds left can bring."""
    for done, hits in ((1, 0), (7, 7), (8, 4), (60, 30), (80, 40), (80, 55), (99, 65), (99, 60), (100, 50)):
        ends = [(n, h) for n in range(done + 1, 101) for h in range(hits, hits + n - done + 1)]
        passed = any(min(binomial_tail(h, n), binomial_tail(n - h, n)) <= 0.05 / n for n, h in ends)
        assert can_decide(hits, done, 100, 0.05) == passed
    assert can_decide(30, 60, 100, 0.05) and not can_decide(40, 80, 100, 0.05)


def test_shadows_hold_the_same_values_in_another_order(spark):
    rows = spark.range(500).select(F.col("id").cast("double").alias("label"), F.array(*[(F.col("id") * k).cast("double") for k in (1, 2)]).alias("values")).coalesce(1)
    both = with_shadows(rows, 2, [0, 1], [0, 1], 5).collect()
    assert [r["values"][:2] for r in both] == [[float(i), 2.0 * i] for i in range(500)]
    for k in (2, 3):
        shadow = [r["values"][k] for r in both]
        assert sorted(shadow) == [float(i) * (k - 1) for i in range(500)]
        assert shadow != sorted(shadow)
    assert [r["values"][2] * 2 for r in both] != [r["values"][3] for r in both]


def test_statistics():
    assert binomial_tail(0, 5) == 1 and binomial_tail(5, 5) == 1 / 32
    assert false_discovery([0.001, 0.9, 0.02], 0.05) == [True, False, True]
    assert false_discovery([0.9, 0.8], 0.05) == [False, False]
    assert tree_count(100, 5) == 282


def test_grid_points_refuse_what_mllib_cannot_take():
    with pytest.raises(ValueError, match="maxDepth"):
        forests.grid_points(forests.FOREST_GRID)
    kept = forests.supported(forests.FOREST_GRID, width=35)
    assert max(kept["maxDepth"]) == 30 and kept["featureSubsetStrategy"] == ["10", "20", "30"]
    assert len(forests.grid_points(kept, 35)) == 4 * 4 * 5 * 5 * 3
    with pytest.raises(ValueError, match="featureSubsetStrategy"):
        forests.grid_points({"featureSubsetStrategy": ["10", "20"]}, 15)
    assert len(forests.grid_points({"maxDepth": [3, 3, 4]})) == 2


def test_shadow_blocks_do_not_follow_arrow_batches():
    def batches(sizes):
        values = iter(range(10**6))
        for n in sizes:
            own = [float(next(values)) for _ in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.float64()), pa.array([[x, -x] for x in own], pa.list_(pa.float64()))], names=["label", "values"]
            )

    for sizes in ([1] * 95, [95], [40, 55], [10, 0, 85]):
        found = [labels.tolist() for labels, _ in _blocks(batches(sizes), 2, size=20)]
        assert [len(x) for x in found] == [20, 20, 20, 35] and sum(found, []) == [float(i) for i in range(95)]


@pytest.fixture(scope="module")
def frames(planted):
    rows = frame.model_frame(frame.hash_split(planted, "account_guid"), FEATURES, keep=["split"])
    return [rows.where(F.col("split") == part).drop("split").cache() for part in ("train", "valid", "test")]


def test_registered_forest_grid_is_whole():
    """All combinations are in the result that the query is checked against."""
    found = duckdb.sql(oracles.build()["forest_grid"]).fetchall()
    points = {row[:3] for row in found}
    assert len(found) == len(points) == 24 and {(n, d, s) for n in (5, 10) for d in (3, 5) for s in ("2", "4")} < points


def test_registered_boosted_grid_is_whole():
    found = duckdb.sql(oracles.build()["boosted_grid"]).fetchall()
    points = {row[:2] for row in found}
    assert len(found) == len(points) == 9 and {(n, d) for n in (2, 4) for d in (2, 3)} < points


def test_forest_search_stops_early_and_ranks(frames, tmp_path):
    train, valid, _ = frames
    grid = {"numTrees": [3, 4, 5, 6], "maxDepth": [4], "featureSubsetStrategy": ["2", "3"]}
    found = forests.search_forest(train, valid, str(tmp_path), grid, max_models=8, stopping_rounds=1, tolerance=1.0, rank_by="auc")
    assert len(found) == 2  # the first model, and one without a gain of 1
    assert found[0]["auc"] >= found[1]["auc"] > 0.8
    best = forests.load_forest(found[0]["path"])
    assert forests.area_under_roc(best, valid) == pytest.approx(found[0]["auc"])
    assert 0 < forests.log_loss(best.transform(valid)) < 0.7


def test_single_models(frames, tmp_path):
    train, valid, test = frames
    forest = forests.fit_forest(train, trees=20)
    assert forests.area_under_roc(forest, valid) > 0.9
    assert forests.importances(forest, FEATURES)[0][0] == "signal"
    boosted = forests.fit_boosted(train, rounds=5, depth=3)
    scored = boosted.transform(test)
    matrix = {(r["label"], r["prediction"]): r["rows"] for r in forests.confusion_matrix(scored).collect()}
    assert sum(matrix.values()) == test.count()
    right = matrix.get((0.0, 0.0), 0) + matrix.get((1.0, 1.0), 0)
    row = forests.performance(scored).first()
    assert row["accuracy"] == pytest.approx(right / test.count()) and row["f1"] > 0.8
    forests.save_model(forest, str(tmp_path / "forest"))
    assert RandomForestClassificationModel.load(str(tmp_path / "forest")).getNumTrees == 20


def test_boosted_search(frames, tmp_path):
    train, valid, _ = frames
    found = forests.search_boosted(train, valid, str(tmp_path), {"maxIter": [2, 3], "maxDepth": [2]})
    assert len(found) == 2 and found[0]["accuracy"] >= found[1]["accuracy"]


def test_useful_features_drop_a_constant(planted):
    rows = frame.model_frame(planted.withColumn("flat", F.lit(1.0)), ["signal", "flat"])
    assert forests.useful_features(forests.fit_forest(rows, trees=5), ["signal", "flat"]) == ["signal"]


def test_feature_names():
    class Frame:
        columns = ["b", "churn", "a"]

    assert frame.feature_names(Frame, ["churn"]) == ["a", "b"]


# Evaluation


def scored_rows(spark, seed, count, ties):
    import random

    r = random.Random(seed)
    rows = [(round(r.random(), 2) if ties else r.random(), r.random()) for _ in range(count)]
    return [(s, int(x < s)) for s, x in rows]


@pytest.mark.parametrize("ties", [True, False])
def test_threshold_report_equals_brute_force(spark, ties):
    rows = scored_rows(spark, 1, 300, ties)
    row = threshold_report(score_histogram(spark.createDataFrame(rows, "s double, y int"), "s", "y")).first()
    bins = [(int(s * 10_000), y) for s, y in rows]
    wins = [(a > b) + 0.5 * (a == b) for a, y in bins if y for b, z in bins if not z]
    assert row["auc"] == pytest.approx(sum(wins) / len(wins))
    assert row["mse"] == pytest.approx(sum((s - y) ** 2 for s, y in rows) / len(rows))
    assert row["log_loss"] == pytest.approx(-sum(math.log(s if y else 1 - s) for s, y in rows if 0 < s < 1) / len(rows), abs=0.2)
    best = max((2 * sum(y for b, y in bins if b >= t) / (sum(b >= t for b, _ in bins) + sum(y for _, y in bins)), t) for t, _ in bins)
    assert (row["f1"], row["threshold"]) == (pytest.approx(best[0]), best[1] / 10_000)
    said = [(b >= best[1], y) for b, y in bins]
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == tuple(said.count(c) for c in ((True, 1), (True, 0), (False, 1), (False, 0)))


def test_report_of_odd_scores(spark):
    rows = spark.createDataFrame([(None, 1), (0.5, None), (1.5, 1), (-1.0, 0), (float("nan"), 1)], "s double, y int")
    row = threshold_report(score_histogram(rows, "s", "y")).first()
    assert row["auc"] == 1 and row["tp"] == row["tn"] == 1 and row["log_loss"] < 1e-9
    empty = threshold_report(score_histogram(rows.limit(0), "s", "y")).first()
    assert empty["auc"] is None and empty["tp"] == empty["tn"] == 0
    assert threshold_report(score_histogram(rows.where("s > 1"), "s", "y")).first()["auc"] is None


def test_gains_rise_to_everything(spark):
    rows = scored_rows(spark, 2, 500, True)
    found = gains(score_histogram(spark.createDataFrame(rows, "s double, y int"), "s", "y")).orderBy("share").collect()
    assert [r["share"] for r in found] == [i / 10 for i in range(1, 11)]
    for r in found:
        taken = [y for s, y in rows if int(s * 10_000) >= round(r["threshold"] * 10_000)]
        assert len(taken) == r["rows"] >= r["share"] * 500 and sum(taken) == r["positives"]
        assert r["lift"] == pytest.approx(sum(taken) / len(taken) / (sum(y for _, y in rows) / 500))
    assert found[-1]["capture"] == 1 and found[-1]["lift"] == pytest.approx(1)


# Exact split and categories


@pytest.mark.parametrize("count", [0, 1, 7, 1005])
def test_exact_split_has_exact_counts(spark, work, count):
    rows = spark.range(count).select(F.col("id").cast("string").alias("account_guid"), F.lit("x").alias("split"))
    split = frame.exact_split(rows, "account_guid", work, seed=3)
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    first, second = round(0.8 * count), round(0.1 * count)
    assert {k: n for k, n in zip(("train", "valid", "test"), (first, second, count - first - second)) if n} == counts
    again = frame.exact_split(rows.repartition(7), "account_guid", work, seed=3)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, again.collect()))


def test_exact_rank_numbers_every_row_once(spark, work):
    rows = spark.range(5000).select((F.col("id") % 7).alias("k"), "id").repartition(13)
    found = exact_rank(rows, [F.col("k").desc(), F.col("id")], work).orderBy("rank").collect()
    assert [r["rank"] for r in found] == list(range(1, 5001))
    assert [(r["k"], r["id"]) for r in found] == sorted(((r["k"], r["id"]) for r in found), key=lambda x: (-x[0], x[1]))
    assert exact_rank(rows.limit(0), [F.col("id")], work).count() == 0


def test_categories_are_split_by_sets(spark, planted):
    rows = planted.withColumn("place", F.concat(F.lit("p"), F.pmod(F.xxhash64("account_guid"), F.lit(40))))
    rows = rows.withColumn("churn", F.col("place").isin(*[f"p{i}" for i in range(0, 40, 2)]).cast("int"))
    indexed = frame.index_categories(rows, ["place"], max_bins=64)
    features = frame.model_frame(indexed, ["place", "signal"])
    found = forests.fit_forest(features, trees=5, maxDepth=2, maxBins=64, featureSubsetStrategy="all")
    assert forests.accuracy(found, features) == 1 and forests.importances(found, ["place", "signal"])[0][0] == "place"
    ordered = frame.model_frame(indexed.withColumn("place", F.col("place") * 1.0), ["place", "signal"])
    assert forests.accuracy(forests.fit_forest(ordered, trees=5, maxDepth=2, maxBins=64, featureSubsetStrategy="all"), ordered) < 0.9
    with pytest.raises(Exception, match="maxBins"):
        forests.fit_forest(features, trees=2, maxBins=8)


def test_rare_categories_are_one(spark):
    rows = spark.createDataFrame([("b",)] * 3 + [("a",)] * 3 + [("c",)] * 2 + [("d",), (None,), ("(other)",)], "t string")
    found = {(r["t"], r["n"]) for r in frame.index_categories(rows.withColumn("n", F.col("t")), ["n"], max_bins=3).collect()}
    assert found == {("a", 0.0), ("b", 1.0), ("c", 2.0), ("d", 2.0), (None, 2.0), ("(other)", 2.0)}
    assert {r["n"] for r in frame.index_categories(rows.select(F.lit(None).cast("string").alias("n")), ["n"]).collect()} == {0.0}
    assert frame.index_categories(rows.limit(0), ["t"]).count() == 0


# Growing and searching


def test_a_block_forest_is_the_sum_of_its_blocks(frames, work):
    train, valid, _ = frames
    forest = forests.grow_forest(train, valid, work, trees=25, block=10, stopping_rounds=9)
    assert [h["trees"] for h in forest.history] == [10, 20, 25] and forest.trees == 25
    votes = [forests.fit_forest(train, n, 12345 + i).transform(valid).select("features", "rawPrediction").collect() for i, n in enumerate((10, 10, 5))]
    expected = {}
    for rows in votes:
        for r in rows:
            at = expected.setdefault(tuple(r["features"]), [0.0, 0.0])
            at[0], at[1] = at[0] + r["rawPrediction"][0], at[1] + r["rawPrediction"][1]
    for r in forest.transform(valid).collect():
        a, b = expected[tuple(r["features"])]
        assert r["probability"] == pytest.approx([a / (a + b), b / (a + b)]) and r["prediction"] == float(b > a)
    assert forest.history[-1]["auc"] == pytest.approx(threshold_report(score_histogram(forest.transform(valid), F.get("probability", F.lit(1)))).first()["auc"])
    assert sum(forest.importances()) == pytest.approx(1) and forest.importances()[0] == max(forest.importances())


def test_a_forest_stops_growing_without_loss(frames, work):
    train, valid, _ = frames
    short = forests.grow_forest(train, valid, work, trees=120, block=10, tolerance=0.02)
    full = forests.fit_forest(train, 120)
    assert short.trees < 120 and short.history[-1]["auc"] > forests.area_under_roc(full, valid) - 0.01


def test_boosted_trees_stop_growing(frames):
    train, valid, _ = frames
    short = forests.grow_boosted(train, valid, rounds=60, depth=3)
    assert short.getNumTrees < 60 and forests.area_under_roc(short, valid) > 0.95


def test_points_that_differ_only_in_rounds_share_a_fit_that_stopped(frames, tmp_path, monkeypatch):
    train, valid, _ = frames
    fits, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, rows: fits.append((self.getMaxIter(), self.getMaxDepth())) or fit(self, rows))
    grid = {"maxIter": [2, 150, 170], "maxDepth": [2, 3]}
    found = forests.search_boosted(train, valid, str(tmp_path), grid, stopping_rounds=9, stop_inside=True)
    # Of 150 and 170 rounds one fit per depth; two rounds end before the trees stop by themselves.
    assert len(found) == 6 and len(fits) == len(set(fits)) == 4 and {(2, 2), (2, 3)} < set(fits)
    rows = forests._dealt(forests.with_validation(train, valid)).persist()
    for entry in found:
        alone = fit(GBTClassifier(seed=12345, validationIndicatorCol=forests.VALIDATION, **entry["params"]), rows)
        model = forests.load_model(entry["path"])
        assert model.getMaxIter() == entry["params"]["maxIter"] and model.getNumTrees == alone.getNumTrees
        trees = [[t.toDebugString.split("\n", 1)[1] for t in m.trees] for m in (model, alone)]
        assert trees[0] == trees[1] and forests.accuracy(model, valid) == pytest.approx(entry["accuracy"])
    rows.unpersist()


def test_rows_of_both_parts_lie_in_every_task(frames, monkeypatch):
    train, valid, _ = frames
    monkeypatch.setattr(forests, "LEAST_VALUES", 100)
    monkeypatch.setattr(forests, "MOST_VALUES", 300)
    rows = forests._dealt(forests.with_validation(train, valid))
    sizes = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count_if(F.col(forests.VALIDATION)).alias("valid"), F.count("label").alias("rows")).collect()
    assert sum(s["rows"] for s in sizes) == train.count() + valid.count() and len(sizes) == rows.rdd.getNumPartitions()
    assert all(0 < s["valid"] < s["rows"] and s["rows"] <= 100 for s in sizes)


def test_searching_side_by_side_finds_what_one_by_one_finds(frames, tmp_path):
    train, valid, _ = frames
    grid = {"numTrees": [2, 3, 4], "maxDepth": [2, 3]}
    runs = [
        forests.search_forest(train, valid, str(tmp_path / f"p{n}"), grid, parallel=n, stopping_rounds=2, tolerance=0.005) for n in (1, 3)
    ]
    short = [[{k: x for k, x in e.items() if k != "path"} for e in run] for run in runs]
    assert short[0] == short[1]
    kept = [sorted(os.listdir(tmp_path / f"p{n}")) for n in (1, 3)]
    assert kept[0] == kept[1] == sorted(os.path.basename(e["path"]) for e in runs[0])


def test_summary_and_importance_table(frames):
    train, _, _ = frames
    model = forests.fit_forest(train, trees=7, maxDepth=2)
    found = forests.model_summary(model)
    assert found["trees"] == 7 and found["max_depth"] == 2 and 2 <= found["min_leaves"] <= found["mean_leaves"] <= found["max_leaves"] <= 4
    table = forests.importance_table(model, FEATURES)
    assert table[0][2] == 1 and sum(t[3] for t in table) == pytest.approx(1) and [t[1] for t in table] == sorted((t[1] for t in table), reverse=True)
