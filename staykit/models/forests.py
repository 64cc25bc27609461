"""Forest and boosted-tree models: random search, single fits, evaluation and importances."""

from __future__ import annotations

from collections import deque
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product
import random
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from staykit.functions.numbers import ratio
from staykit.models.evaluation import positive_chance, score_histogram, threshold_report
from staykit.sources.tables import Workspace, remove_path

MAX_DEPTH = 30  # MLlib's limit

# The search spaces.
FOREST_GRID = {
    "numTrees": [500, 850, 900, 950],
    "maxDepth": [7, 8, 20, 30, 50, 70, 100],
    "minInstancesPerNode": [1, 5, 20, 50, 100],
    "maxBins": [2, 20, 100, 300, 600],
    "featureSubsetStrategy": ["10", "20", "30", "50", "70"],
}
BOOSTED_GRID = {"maxIter": [10, 30, 50, 70, 90, 110, 130], "maxDepth": [3, 4, 6, 7, 8]}
BOOSTED_GRID_DEEP = {"maxIter": [130, 150, 170], "maxDepth": [8, 10, 18]}


def supported(grid: dict[str, list], width: int | None = None) -> dict[str, list]:
    """The grid without values that MLlib cannot take: depths above 30, and subsets of more columns than there are."""
    kept = dict(grid)
    if "maxDepth" in kept:
        kept["maxDepth"] = [d for d in kept["maxDepth"] if d <= MAX_DEPTH]
    if width and "featureSubsetStrategy" in kept:
        kept["featureSubsetStrategy"] = [s for s in kept["featureSubsetStrategy"] if not s.isdigit() or int(s) <= width]
    return kept


def grid_points(grid: dict[str, list], width: int | None = None) -> list[dict]:
    """All different combinations. Values that MLlib cannot take are an error; ``supported`` leaves them out."""
    for name, values in supported(grid, width).items():
        if len(values) < len(grid[name]):
            raise ValueError(f"{name}: MLlib cannot take {sorted(set(grid[name]) - set(values))}")
    points = []
    for values in product(*grid.values()):
        point = dict(zip(grid, values))
        if point not in points:
            points.append(point)
    return points


def area_under_roc(model, frame: DataFrame) -> float:
    return BinaryClassificationEvaluator(metricName="areaUnderROC").evaluate(model.transform(frame))


def accuracy(model, frame: DataFrame) -> float:
    hit = (F.col("label") == F.col("prediction")).cast("double")
    return model.transform(frame).agg(F.avg(hit)).first()[0]


def random_search(
    estimator,
    grid: dict[str, list],
    train: DataFrame,
    valid: DataFrame,
    folder: str,
    max_models: int = 100,
    seed: int = 12345,
    stopping_rounds: int = 5,
    tolerance: float = 1e-4,
    rank_by: str = "accuracy",
    parallel: int = 4,
) -> list[dict]:
    """Fits a random sample of the grid, writes each model below ``folder``, and returns the entries, best first.

    An entry has ``params``, ``path``, ``auc`` and ``accuracy``; ``rank_by`` names the metric to sort by, and only the model
    at hand is in the driver's memory. Stops early once ``stopping_rounds`` different points in a row failed to improve the
    best validation AUC by ``tolerance``. ``parallel`` fits run side by side; fits begun ahead of an early stop are thrown
    away, so the result does not depend on it. Points that differ only in ``maxIter`` share a fit that stopped by itself
    (``_besides_rounds``).
    """
    points = grid_points(grid, _width(train))
    random.Random(seed).shuffle(points)
    points = points[:max_models]
    train, valid = train.persist(), valid.persist()
    spark = train.sparkSession
    sharing, shared, turns = _stops_inside(estimator) and "maxIter" in grid, {}, {_besides_rounds(p): Lock() for p in points}

    def fit_alone(params: dict, path: str) -> tuple[dict, int]:
        model = estimator.copy({estimator.getParam(k): v for k, v in params.items()}).fit(train)
        entry = {"params": params, "path": path, "auc": area_under_roc(model, valid), "accuracy": accuracy(model, valid)}
        save_model(model, path)
        return entry, model.getNumTrees

    def fit(number: int) -> dict:
        params, path = points[number], f"{folder}/model-{number}"
        if not sharing:
            return fit_alone(params, path)[0]
        group = _besides_rounds(params)
        with turns[group]:
            if group in shared and shared[group][1] <= params["maxIter"]:
                model = load_model(shared[group][0]["path"])
                save_model(model.copy({model.maxIter: params["maxIter"]}), path)
                return {**shared[group][0], "params": params, "path": path}
            entry, trees = fit_alone(params, path)
            if trees < params["maxIter"]:
                shared[group] = entry, trees
            return entry

    found, best, stale = [], float("-inf"), 0
    try:
        with ThreadPoolExecutor(parallel) as pool:
            # Only so many fits are under way; what they find is judged in the sampled order, as if they had run one by one.
            running = deque()
            for number in range(len(points)):
                while len(running) < parallel and number + len(running) < len(points):
                    running.append(pool.submit(_in_pool(spark, fit, number + len(running))))
                entry = running.popleft().result()
                found.append(entry)
                best, stale = (entry["auc"], 0) if entry["auc"] > best + tolerance else (best, stale + 1)
                if stale >= stopping_rounds:
                    # All of them have ended before the first goes: one may be reading what another wrote.
                    for entry in [ahead.result() for ahead in running if not ahead.cancel()]:
                        remove_path(spark, entry["path"])
                    break
    finally:
        train.unpersist()
        valid.unpersist()
    return sorted(found, key=lambda entry: entry[rank_by], reverse=True)


def _stops_inside(estimator) -> bool:
    """Whether boosted trees of ``estimator`` end with the first one that does not lower the validation rows' error enough.
    Without a tolerance MLlib goes on after trees that change nothing."""
    return isinstance(estimator, GBTClassifier) and estimator.isSet("validationIndicatorCol") and estimator.getValidationTol() > 0


def _besides_rounds(params: dict) -> tuple:
    """What a point's trees depend on. ``maxIter`` only ends their row: a model that stopped by itself is, tree by tree, what
    every point of the same settings finds that allows as many trees."""
    return tuple((name, value) for name, value in params.items() if name != "maxIter")


def _in_pool(spark, fit, number: int):
    """The fit as a job of its own scheduler pool, so that with ``spark.scheduler.mode`` FAIR fits share the executors."""

    def job():
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"search-{number}")
        return fit(number)

    return inheritable_thread_target(spark)(job)


def _width(frame: DataFrame) -> int | None:
    return frame.schema["features"].metadata.get("ml_attr", {}).get("num_attrs")


def search_forest(train: DataFrame, valid: DataFrame, folder: str, grid=None, seed: int = 12345, **options) -> list[dict]:
    """By default the part of FOREST_GRID that MLlib and the number of columns allow."""
    grid = grid or supported(FOREST_GRID, _width(train))
    return random_search(RandomForestClassifier(seed=seed), grid, train, valid, folder, seed=seed, **options)


def search_boosted(
    train: DataFrame, valid: DataFrame, folder: str, grid=None, seed: int = 12345, stop_inside: bool = False, **options
) -> list[dict]:
    """Boosted trees; BOOSTED_GRID by default, BOOSTED_GRID_DEEP for a second, deeper search. With ``stop_inside`` each
    model stops growing when the validation rows' error no longer falls (``grow_boosted``)."""
    grid, estimator = grid or supported(BOOSTED_GRID, _width(train)), GBTClassifier(seed=seed)
    if stop_inside:
        estimator.setValidationIndicatorCol(VALIDATION)
        train = _dealt(with_validation(train, valid))
    return random_search(estimator, grid, train, valid, folder, seed=seed, **options)


VALIDATION = "_valid"


def with_validation(train: DataFrame, valid: DataFrame) -> DataFrame:
    """Both, told apart by the column ``VALIDATION``."""
    marked = valid.select(*train.columns).withColumn(VALIDATION, F.lit(True))
    return train.withColumn(VALIDATION, F.lit(False)).unionByName(marked)


# A boosted fit passes over its rows once per level of each tree. Values (rows x columns) that are worth a task of their own in
# such a pass, and that one task should hold at most.
LEAST_VALUES, MOST_VALUES = 200_000, 10_000_000


def _dealt(frame: DataFrame) -> DataFrame:
    """The rows dealt evenly over as many tasks as there are cores: fewer where a task would have next to no work, more where
    it would have too much. A union of training and validation rows as it comes has tasks without rows in each pass."""
    values = frame.count() * (_width(frame) or 1)
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(max(1, min(cores, values // LEAST_VALUES), -(-values // MOST_VALUES)))


def fit_forest(train: DataFrame, trees: int = 200, seed: int = 12345, **params):
    """One forest: 200 trees on 63.2 % samples, square root of the columns tried per split."""
    settings = {"numTrees": trees, "subsamplingRate": 0.632, "featureSubsetStrategy": "sqrt", "seed": seed, **params}
    return RandomForestClassifier(**settings).fit(train)


def fit_boosted(train: DataFrame, rounds: int = 500, depth: int = 12, seed: int = 12345, **params):
    """One boosted model: 500 trees of depth 12."""
    return GBTClassifier(maxIter=rounds, maxDepth=depth, seed=seed, **params).fit(train)


@dataclass
class BlockForest:
    """A forest grown in blocks of trees. Its votes are the sum of its blocks' votes."""

    blocks: list[RandomForestClassificationModel]
    history: list[dict]  # trees, auc and log_loss on the validation rows after each block

    @property
    def trees(self) -> int:
        return sum(block.getNumTrees for block in self.blocks)

    def transform(self, frame: DataFrame) -> DataFrame:
        """``frame`` with ``probability`` (array of two numbers) and ``prediction``."""
        rows = frame.withColumn("_votes", F.array(F.lit(0.0), F.lit(0.0)))
        for block in self.blocks:
            rows = _add_votes(rows, block)
        return rows.select(*frame.columns, *_voted())

    def importances(self) -> list[float]:
        """Mean of the blocks' importances, by their numbers of trees."""
        width = len(self.blocks[0].featureImportances)
        total = [0.0] * width
        for block in self.blocks:
            for i, x in enumerate(block.featureImportances.toArray().tolist()):
                total[i] += x * block.getNumTrees / self.trees
        return total

    def save(self, folder: str) -> None:
        for number, block in enumerate(self.blocks):
            save_model(block, f"{folder}/block-{number:05d}")


def _add_votes(rows: DataFrame, block: RandomForestClassificationModel) -> DataFrame:
    """Adds a block's votes to ``_votes``."""
    block = block.copy({block.rawPredictionCol: "_raw", block.probabilityCol: "_chance", block.predictionCol: "_said"})
    scored = block.transform(rows)
    added = F.zip_with("_votes", vector_to_array("_raw"), lambda a, b: a + b)
    return scored.withColumn("_votes", added).drop("_raw", "_chance", "_said")


def _voted() -> list:
    all_votes = F.get("_votes", F.lit(0)) + F.get("_votes", F.lit(1))
    chance = F.transform("_votes", lambda v: v / all_votes)
    return [chance.alias("probability"), (F.get("_votes", F.lit(1)) > F.get("_votes", F.lit(0))).cast("double").alias("prediction")]


def grow_forest(
    train: DataFrame, valid: DataFrame, work: Workspace, trees: int = 200, block: int = 100, stopping_rounds: int = 2,
    tolerance: float = 1e-4, seed: int = 12345, **params,
) -> BlockForest:
    """A forest of up to ``trees`` trees, scored on ``valid`` after every ``block`` of them.

    It stops once ``stopping_rounds`` blocks in a row did not improve the best log loss by the share ``tolerance``. Votes
    of earlier blocks are kept beside the validation rows, so each block scores them once. Binary labels only.
    """
    train, forest, best, stale = train.persist(), BlockForest([], []), float("inf"), 0
    votes = work.store(valid.withColumn("_votes", F.array(F.lit(0.0), F.lit(0.0))), "votes")
    try:
        while forest.trees < trees and stale < stopping_rounds:
            number = min(block, trees - forest.trees)
            forest.blocks.append(fit_forest(train, number, seed + len(forest.blocks), **params))
            before, votes = votes, work.store(_add_votes(votes, forest.blocks[-1]), "votes")
            work.drop(before)
            scored = votes.select("label", *_voted())
            row = threshold_report(score_histogram(scored, F.get("probability", F.lit(1)))).first()
            forest.history.append({"trees": forest.trees, "auc": row["auc"], "log_loss": row["log_loss"]})
            best, stale = (row["log_loss"], 0) if row["log_loss"] < best * (1 - tolerance) else (best, stale + 1)
    finally:
        train.unpersist()
    return forest


def grow_boosted(train: DataFrame, valid: DataFrame, rounds: int = 500, depth: int = 12, tolerance: float = 0.01, seed: int = 12345, **params):
    """Boosted trees that stop when the validation rows' error no longer falls by ``tolerance`` (MLlib's rule)."""
    settings = {"maxIter": rounds, "maxDepth": depth, "seed": seed, "validationIndicatorCol": VALIDATION, "validationTol": tolerance}
    return GBTClassifier(**{**settings, **params}).fit(_dealt(with_validation(train, valid)))


def model_summary(model) -> dict:
    """Number of trees, and least, mean and most depth and leaves of them."""
    depths, leaves = [t.depth for t in model.trees], [(t.numNodes + 1) // 2 for t in model.trees]
    summary = {"trees": len(depths)}
    for name, values in (("depth", depths), ("leaves", leaves)):
        summary |= {f"min_{name}": min(values), f"mean_{name}": sum(values) / len(values), f"max_{name}": max(values)}
    return summary


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per actual and predicted class."""
    return scored.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("rows"))


def performance(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, precision, recall and F1 of the positive class at the model's own predictions.

    ``evaluation.threshold_report`` has AUC, losses and the best threshold.
    """
    actual, said = F.col(label) == 1, F.col(prediction) == 1
    hit, wrong, missed = F.count_if(actual & said), F.count_if(~actual & said), F.count_if(actual & ~said)
    return scored.agg(
        F.avg((actual == said).cast("double")).alias("accuracy"),
        ratio(hit, hit + wrong).alias("precision"),
        ratio(hit, hit + missed).alias("recall"),
        ratio(2 * hit, 2 * hit + wrong + missed).alias("f1"),
    )


def importances(model, features: list[str]) -> list[tuple[str, float]]:
    """(feature, importance), largest first."""
    return sorted(zip(features, model.featureImportances.toArray().tolist()), key=lambda pair: (-pair[1], pair[0]))


def importance_table(model, features: list[str]) -> list[tuple[str, float, float, float]]:
    """(feature, relative importance, scaled to the largest, share of all), largest first."""
    found = importances(model, features)
    top, total = max((x for _, x in found), default=0), sum(x for _, x in found)
    return [(name, x, x / top if top else 0.0, x / total if total else 0.0) for name, x in found]


def useful_features(model, features: list[str]) -> list[str]:
    """The features with any importance, in their given order."""
    used = {name for name, value in importances(model, features) if value > 0}
    return [f for f in features if f in used]


def log_loss(scored: DataFrame, label: str = "label", probability: str = "probability") -> float:
    """Mean negative log likelihood of the actual class; probabilities are kept 1e-15 away from 0 and 1."""
    return threshold_report(score_histogram(scored, positive_chance(probability), label)).first()["log_loss"]


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_forest(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


def load_model(path: str):
    """A forest or a boosted model, whichever was saved there."""
    kind = SparkSession.active().read.text(f"{path}/metadata").first()[0]
    return (GBTClassificationModel if "GBTClassificationModel" in kind else RandomForestClassificationModel).load(path)
