"""All-relevant feature selection with shadow features (Kursa and Rudnicki, 2010), run as Spark jobs."""

from __future__ import annotations

from dataclasses import dataclass, field
from math import comb, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from staykit.models.frame import bucket
from staykit.models.histograms import as_bytes, bags, binned, cut_points, forest_importances, rows_of
from staykit.sources.tables import Workspace

MIN_SHADOWS = 5
# Rows over which shadow values are mixed; the number of partitions follows from it.
BLOCK_ROWS = 10_000


@dataclass
class Selection:
    """Names of accepted, undecided and rejected features, and how often each beat the best shadow."""

    accepted: list[str]
    tentative: list[str]
    rejected: list[str]
    hits: dict[str, int] = field(default_factory=dict)
    rounds: int = 0


def tree_count(features: int, depth: int) -> int:
    """Enough trees for each of ``features`` columns to be used about a hundred times."""
    return max(1, int(100 * features * 2 / (sqrt(features * 2) * depth)))


def binomial_tail(hits: int, rounds: int) -> float:
    """Chance of at least ``hits`` heads in ``rounds`` fair tosses."""
    return sum(comb(rounds, k) for k in range(hits, rounds + 1)) / 2**rounds


def false_discovery(chances: list[float], alpha: float) -> list[bool]:
    """Which tests pass at false discovery rate ``alpha`` (Benjamini and Hochberg, 1995)."""
    order = np.argsort(chances)
    passed = np.array(chances)[order] <= alpha * np.arange(1, len(chances) + 1) / max(1, len(chances))
    last = np.nonzero(passed)[0].max() + 1 if passed.any() else 0
    keep = np.zeros(len(chances), dtype=bool)
    keep[order[:last]] = True
    return keep.tolist()


def can_decide(hits: int, done: int, max_rounds: int, alpha: float) -> bool:
    """Whether a feature could still pass a test in the rounds left, if it hit in all of them or in none."""
    return any(
        binomial_tail(max(hits + n - done, n - hits), n) <= alpha / n for n in range(done + 1, max_rounds + 1)
    )


def with_shadows(frame: DataFrame, width: int, columns: list[int], shadows: list[int], seed: int, trees: int = 0) -> DataFrame:
    """Columns ``columns`` of ``values`` (an array of ``width`` numbers, or binary with a byte for each) followed by shuffled
    copies of ``shadows``; with ``trees``, in ``bags`` how often each of so many trees sees the row.

    Each copy is permuted on its own inside the Arrow batches of a partition. Rows were dealt to partitions by a hash of
    their key, so a batch is a random sample and no further shuffle is needed; the random stream depends only on seed,
    partition and batch, so a repeated task produces the same copies.
    """
    coded = dict(frame.dtypes)["values"] == "binary"

    def permute(batches):
        part = TaskContext.get().partitionId()
        for number, (labels, values) in enumerate(_blocks(batches, width)):
            random = np.random.default_rng([seed, part, number])
            by_column = np.ascontiguousarray(values.T)
            mixed = [by_column[i].take(random.permutation(len(labels))) for i in shadows]
            both = np.vstack([by_column[columns], *mixed]).T
            if coded:
                kept = as_bytes(both)
            else:
                ends = pa.array(np.arange(len(labels) + 1, dtype=np.int32) * both.shape[1])
                kept = pa.ListArray.from_arrays(ends, pa.array(both.ravel()))
            seen = [as_bytes(bags(len(labels), trees, random))] if trees else []
            yield pa.RecordBatch.from_arrays([pa.array(labels), kept, *seen], names=["label", "values", "bags"][: 2 + len(seen)])

    return frame.mapInArrow(permute, f"label double, values {'binary' if coded else 'array<double>'}" + ", bags binary" * bool(trees))


def _blocks(batches, width: int, size: int = BLOCK_ROWS):
    """The rows in blocks of ``size``, the last one of up to twice as many: whatever size Arrow batches have, shadows are
    mixed over the same rows, and never over a few left-over ones."""
    labels, values = np.zeros(0), None
    for batch in batches:
        labels = np.concatenate([labels, batch.column("label").to_numpy(zero_copy_only=False)])
        own = rows_of(batch, width)
        values = own if values is None else np.concatenate([values, own])
        while len(labels) >= 2 * size:
            yield labels[:size], values[:size]
            labels, values = labels[size:], values[size:]
    if len(labels):
        yield labels, values


def boruta_select(
    df: DataFrame,
    features: list[str],
    label: str = "churn",
    key: str = "account_guid",
    max_rounds: int = 100,
    max_depth: int = 5,
    trees: int | None = None,
    alpha: float = 0.05,
    seed: int = 1,
) -> Selection:
    """Features whose forest importance beats the best shadow's more often than chance.

    Every round is one forest on real and shadow columns. After it, features are accepted or rejected by a two-sided
    binomial test on their hits, corrected for the number of features (false discovery rate) and of rounds; rejected ones
    leave the pool. Features still open after ``max_rounds`` are tentative and not selected; rounds that can no longer
    decide any of them are not run.
    """
    features = list(features)
    place = bucket(F.col(key), seed)
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    rows = df.select(F.col(label).cast("double").alias("label"), values.alias("values"), place.alias("_place"))
    work = Workspace(df.sparkSession)
    blocks, tasks = max(1, rows.count() // BLOCK_ROWS), df.sparkSession.sparkContext.defaultParallelism
    stored = work.store(rows.repartition(blocks, "_place").sortWithinPartitions("_place"), "selection")
    # Values are binned once, for all rounds: a shuffled copy has the thresholds of its column.
    cuts, classes = cut_points(stored.select("label", "values"), len(features), tasks)
    coded = binned(stored, cuts).repartition(blocks, "_place").sortWithinPartitions("_place").select("label", "values").persist()
    hits = np.zeros(len(features), dtype=int)
    state = np.zeros(len(features), dtype=int)
    done = 0
    for done in range(1, max_rounds + 1):
        pool = [i for i in range(len(features)) if state[i] >= 0]
        shadows = (pool * (-(-MIN_SHADOWS // len(pool))))[: max(len(pool), MIN_SHADOWS)]
        grown = trees or tree_count(len(pool), max_depth)
        both = with_shadows(coded, len(features), pool, shadows, seed * 100_003 + done, grown).persist()
        bins = [len(cuts[i]) + 1 for i in [*pool, *shadows]]
        importance = forest_importances(both, bins, classes, grown, max_depth, tasks, blocks, seed + done)
        both.unpersist()
        bar = importance[len(pool):].max()
        for place, i in enumerate(pool):
            hits[i] += importance[place] > bar
        open_ = [i for i in pool if state[i] == 0]
        level = alpha / done
        good = [binomial_tail(hits[i], done) for i in open_]
        bad = [binomial_tail(done - hits[i], done) for i in open_]
        for i, up, down, g, b in zip(open_, false_discovery(good, alpha), false_discovery(bad, alpha), good, bad):
            if up and g <= level:
                state[i] = 1
            elif down and b <= level:
                state[i] = -1
        if not (state >= 0).any() or not any(can_decide(hits[i], done, max_rounds, alpha) for i in pool if state[i] == 0):
            break
    coded.unpersist()
    work.clear()
    named = {s: [f for f, x in zip(features, state) if x == s] for s in (1, 0, -1)}
    return Selection(named[1], named[0], named[-1], dict(zip(features, hits.tolist())), done)
