"""The forest over binned rows: as MLlib's where both must agree, and independent of how rows lie."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F
import pytest

from staykit.models import boruta, frame
from staykit.models.boruta import with_shadows
from staykit.models.histograms import bags, best_split, binned, cut_points, forest_importances, summed, thresholds

WIDTH = 7


@pytest.fixture(scope="module")
def rows(spark):
    """Columns with many values, few, one, mostly zeros, negative ones, and a label of three classes."""
    h = [F.pmod(F.xxhash64("id", F.lit(k)), F.lit(3000)).cast("double") for k in range(4)]
    values = F.array(
        h[0], F.floor(h[1] / 750), F.lit(3.0), F.when(h[2] > 2700, h[2]).otherwise(0.0), -h[3] / 7, F.when(h[0] > 1200, 1.0).otherwise(-1.0),
        F.col("id") % 3,
    )
    signal = h[0] + 1200 * F.floor(h[1] / 750) - h[3]
    label = F.when(signal > 2700, 2.0).when(signal > 600, 1.0).otherwise(0.0)
    return spark.range(0, 6000, 1, 6).select("id", label.alias("label"), values.cast("array<double>").alias("values")).cache()


def _binned(rows, parts=6, trees=1):
    """Rows in a fixed order in ``parts`` partitions, bags that depend on the row only, and the thresholds."""
    cuts, classes = cut_points(rows.select("label", "values"), WIDTH, 3)
    coded = binned(rows, cuts)
    bag = F.concat(*[F.unhex(F.format_string("%02x", F.pmod(F.xxhash64("id", F.lit(100 + t)), F.lit(3)).cast("int"))) for t in range(trees)])
    bag = F.lit(bytearray([1])) if trees == 1 else bag
    return coded.withColumn("bags", bag).repartition(parts, "id").select("label", "values", "bags"), cuts, classes


@pytest.mark.parametrize("depth", [1, 3, 5])
def test_a_single_tree_has_the_importances_of_mllibs(rows, depth):
    coded, cuts, classes = _binned(rows)
    assert classes == 3 and [len(c) + 1 for c in cuts][1:3] == [4, 1]
    found = forest_importances(coded, [len(c) + 1 for c in cuts], classes, 1, depth, 3, 6, 0)
    vectors = rows.select("label", array_to_vector("values").alias("features"))
    theirs = DecisionTreeClassifier(maxDepth=depth).fit(vectors).featureImportances.toArray()
    assert np.allclose(found, theirs, rtol=1e-9, atol=1e-12)


def test_importances_do_not_depend_on_tasks(rows):
    def found(parts, tasks):
        coded, cuts, classes = _binned(rows, parts, 5)
        return forest_importances(coded, [len(c) + 1 for c in cuts], classes, 5, 4, tasks, parts, 7).tolist()

    assert found(6, 6) == found(6, 1) == found(3, 2) == found(1, 2)


def test_forest_ranks_columns_as_mllibs(rows):
    """Of many bagged trees: the same order of the columns that tell something, nothing for the constant."""
    cuts, classes = cut_points(rows.select("label", "values"), WIDTH, 3)
    coded = binned(rows.select("label", "values"), cuts)
    both = with_shadows(coded, WIDTH, list(range(WIDTH)), [], 3, 60)
    found = forest_importances(both, [len(c) + 1 for c in cuts], classes, 60, 5, 4, 6, 11)
    vectors = rows.select("label", array_to_vector("values").alias("features"))
    theirs = RandomForestClassifier(numTrees=60, maxDepth=5, seed=1).fit(vectors).featureImportances.toArray()
    assert found[2] == theirs[2] == 0 and abs(found - theirs).max() < 0.06
    assert [i for i in found.argsort()[::-1] if i in (0, 1, 4)] == [i for i in theirs.argsort()[::-1] if i in (0, 1, 4)]


def test_selection_bins_its_rows_once(spark, monkeypatch):
    """MLlib's forest binned and copied all rows again in each round."""
    calls = []
    monkeypatch.setattr(boruta, "binned", lambda *a: calls.append(1) or binned(*a))
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda *_: pytest.fail("a forest that bins all rows again"))
    made = spark.range(500).select(F.col("id").cast("string").alias("account_guid"), (F.col("id") % 10).alias("a"), (F.col("id") % 10 > 4).cast("int").alias("churn"))
    chosen = boruta.boruta_select(made, ["a"], max_rounds=9, trees=5)
    assert calls == [1] and chosen.accepted == ["a"]


def test_shadows_of_binned_rows_hold_the_same_bins(rows):
    cuts, _ = cut_points(rows.select("label", "values"), WIDTH, 3)
    both = with_shadows(binned(rows.select("label", "values"), cuts), WIDTH, [0, 1], [0, 1, 4], 5, 9).collect()
    found = np.array([list(r["values"]) for r in both])
    assert found.shape == (6000, 5) and all(len(r["bags"]) == 9 for r in both)
    for shadow, column in ((2, 0), (3, 1)):
        assert sorted(found[:, shadow]) == sorted(found[:, column]) and (found[:, shadow] != found[:, column]).any()


def test_values_that_mllib_refuses_are_refused(spark):
    for bad in ("double('NaN')", "double('Infinity')"):
        with pytest.raises(Exception, match="must not be NaN or infinite"):
            cut_points(spark.sql(f"SELECT 1.0D AS label, array({bad}) AS values"), 1, 1)
    for bad in ("CAST(NULL AS DOUBLE)", "-1.0D", "0.5D"):
        with pytest.raises(ValueError, match="labels must be"):
            cut_points(spark.sql(f"SELECT {bad} AS label, array(1.0D) AS values"), 1, 1)
    with pytest.raises(ValueError, match="no rows"):
        cut_points(spark.sql("SELECT 1.0D AS label, array(1.0D) AS values WHERE false"), 1, 1)


def test_thresholds_and_summaries():
    assert thresholds(np.array([1.0, 2.0, 5.0]), np.array([1, 1, 8])).tolist() == [1.5, 3.5]
    assert thresholds(np.arange(100.0), np.ones(100), 4).tolist() == [24.5, 49.5, 74.5]
    values, counts = summed(np.arange(10_000.0)[::-1], np.ones(10_000), 100)
    assert values.tolist() == list(np.arange(99.0, 10_000, 100)) and counts.tolist() == [100] * 100
    values, counts = summed(np.array([2.0, 1.0, 2.0]), np.array([3, 4, 5]))
    assert values.tolist() == [1, 2] and counts.tolist() == [4, 8]


def test_splits_and_bags():
    counts = np.array([[[5, 5], [5, 5]], [[9, 1], [1, 9]]])
    place, bin_, gain, left, right = best_split(counts)
    assert (place, bin_) == (1, 0) and left.tolist() == [9, 1] and right.tolist() == [1, 9] and abs(gain - 6.4) < 1e-12
    assert best_split(counts[:1]) is None
    drawn = bags(20_000, 5, np.random.default_rng(1))
    assert abs(drawn.mean() - 1) < 0.02 and abs((drawn == 0).mean() - np.exp(-1)) < 0.01 and abs(drawn.var() - 1) < 0.05
    assert (bags(10, 1, np.random.default_rng(1)) == 1).all()


def test_numbers_are_coerced_without_text(spark):
    text = """SELECT 'k' AS account_guid, * FROM VALUES
     (1, 2L, double('NaN'), float(0.1), date'2024-01-01', '7.5', true, 12.50BD), (NULL, 9007199254740993L, double('-Infinity'), NULL, NULL, 'x', false, NULL)
     AS t(i, l, d, f, day, s, b, m)"""
    numeric = frame.coerce_numeric(spark.sql(text), ["account_guid"])
    assert [tuple(r)[1:] for r in numeric.collect()] == [
        (1.0, 2.0, 0.0, 0.1, 0.0, 7.5, 1.0, 12.5), (0.0, 9007199254740992.0, float("-inf"), 0.0, 0.0, 0.0, 0.0, 0.0),
    ]
    # Whole numbers and doubles went through text.
    plan = frame.coerce_numeric(spark.range(1).selectExpr("id", "double(id) AS d", "int(id) AS i"), [])._jdf.queryExecution().analyzed().toString()
    assert "string" not in plan.lower()
