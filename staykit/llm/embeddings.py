"""Near-duplicate vectors by a pivot-permutation index (Chavez, Figueroa and Navarro, 2008).

Reference points (pivots) that lie apart are drawn from the vectors. A vector is described by its nearest pivots; vectors that
are close to each other have nearly the same ones. Inverted lists by pairs of pivots bring together all vectors of one label
that share at least two of them; each such pair of vectors is verified by its cosine, once. How many pivots there are and how
many describe a vector follows from the share of links found on a sample.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from staykit.llm.arrow import map_arrow, numpy_of
from staykit.llm.components import components
from staykit.sources.tables import Workspace

THRESHOLD = 0.93
# Nearest pivots that describe a vector, at least, and how many of them two vectors must share to be compared.
NEAREST = 6
SHARED = 2
# More nearest pivots are tried up to so many, then fewer pivots, until this share of a sample's links is found.
MOST_NEAREST = 10
RECALL = 0.97
# Cosine that two pivots have at most; a higher one is tried only while there are too few pivots.
APART = (0.5, 0.6, 0.7, 0.8)
# Vectors the pivots are drawn from, at most; the number of pivots grows with the root of the number of vectors.
PIVOT_SAMPLE = 50_000
# Vectors of one list that are compared in one task at once; a longer list is cut into blocks that meet in pairs.
BLOCK = 2_000


@dataclass(frozen=True)
class NearDuplicates:
    vectors: DataFrame  # vec_id, n_links, component_id, kept
    links: DataFrame  # a, b: verified links that hold the components together


def usable(vector: Column) -> Column:
    """Not NULL, not empty, no NULL or non-finite component, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def _draw(vectors: DataFrame, count: int, wanted: int, sample: int = PIVOT_SAMPLE) -> np.ndarray:
    """The ``wanted`` vectors with the smallest hashes of at most ``sample`` vectors that a hash draws from all."""
    share = min(1.0, sample / max(1, count))
    drawn = vectors.where(F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(2**20)) <= F.lit(int(share * 2**20)))
    rows = drawn.orderBy(F.xxhash64("vec_id", F.lit(12)), "vec_id").limit(wanted).select("_unit").toArrow()
    return _unit_vectors(rows.column(0).combine_chunks())


def spread(points: np.ndarray, wanted: int, bound: float) -> np.ndarray:
    """The first ``wanted`` of ``points`` whose cosine to each one taken before is at most ``bound``."""
    taken = points[:0]
    for start in range(0, len(points), 512):
        block = points[start:start + 512]
        block = block[(block @ taken.T <= bound).all(axis=1)]
        near, keep = block @ block.T > bound, []
        free = np.ones(len(block), dtype=bool)
        for i in range(len(block)):
            if free[i]:
                keep.append(i)
                free &= ~near[i]
        taken = np.concatenate([taken, block[keep]])
        if len(taken) >= wanted:
            break
    return taken[:wanted]


def _sample_links(points: np.ndarray, threshold: float, most: int = 5_000) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs to try an index on: links among ``points`` that are no exact copies, and pairs at exactly ``threshold`` that are
    made by moving a point along the difference of two others."""
    random, found = np.random.default_rng(13), []
    for start in range(0, min(len(points), 2_048), 512):
        cosines = points[start:start + 512] @ points.T
        a, b = np.nonzero((cosines >= threshold) & (cosines < 1 - 1e-9))
        a += start
        found.append(np.stack([a[a < b], b[a < b]]))
    a, b = np.hstack(found)
    chosen = random.permutation(len(a))[:most]
    own, one, other = random.integers(len(points), size=(3, min(most, 4 * len(points))))
    way = points[one] - points[other]
    way -= (way * points[own]).sum(axis=1, keepdims=True) * points[own]
    length = np.sqrt((way**2).sum(axis=1))
    own, way, length = own[length > 1e-6], way[length > 1e-6], length[length > 1e-6, None]
    moved = threshold * points[own] + sqrt(max(0.0, 1 - threshold**2)) * way / length
    return [pair for pair in ((points[a[chosen]], points[b[chosen]]), (points[own], moved)) if len(pair[0])]


def _nearest_pivots(units: np.ndarray, pivots: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the ``width`` nearest pivots, the nearest first. Cosine is the measure: they have the largest products."""
    return np.argsort(-(units @ pivots.T), axis=1, kind="stable")[:, :width]


def choose_pivots(
    vectors: DataFrame, count: int, threshold: float = THRESHOLD, nearest: int = NEAREST, shared: int = SHARED,
    recall: float = RECALL,
) -> tuple[np.ndarray, int]:
    """Pivots, and how many nearest ones describe a vector.

    Pivots are ``ceil(sqrt(count))`` drawn vectors, at least 32, that lie apart: a group of near copies has one of them and
    not its share, as the order of pivots inside a group is noise to its members. Few enough to hold: a billion vectors have
    32 thousand. Of ``nearest`` to ``MOST_NEAREST`` the least number is taken that finds the share ``recall`` of a sample's
    links; where none does, the pivots are halved. Two pivots are shared by all vectors and find every link.
    """
    wanted = max(32, ceil(sqrt(count)))
    points = _draw(vectors, count, 4 * wanted)
    for bound in APART:
        pivots = spread(points, wanted, bound)
        if len(pivots) >= wanted:
            break
    tried = _sample_links(points, threshold)
    while len(pivots) > nearest:
        most = max(nearest, min(MOST_NEAREST, len(pivots) - 1))
        orders = [[_nearest_by_part(side, pivots, most) for side in pair] for pair in tried]
        for width in range(nearest, most + 1):
            if all(_share_found(a[:, :width], b[:, :width], shared) >= recall for a, b in orders):
                return pivots, width
        pivots = pivots[:len(pivots) // 2]
    return pivots[:shared], shared


def _nearest_by_part(units: np.ndarray, pivots: np.ndarray, width: int) -> np.ndarray:
    return np.concatenate([_nearest_pivots(units[i:i + 500], pivots, width) for i in range(0, len(units), 500)])


def _share_found(a: np.ndarray, b: np.ndarray, shared: int) -> float:
    return float(((a[:, :, None] == b[:, None, :]).sum(axis=(1, 2)) >= shared).mean())


def _unit_vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _units(vectors: DataFrame) -> DataFrame:
    """Vectors of length one, in double precision. Dividing by the largest component first keeps the squares of very large
    and very small numbers in range."""

    def step(batches):
        for batch in batches:
            values, ends = batch.column(2).flatten().to_numpy(zero_copy_only=False), batch.column(2).offsets.to_numpy()
            starts, sizes = ends[:-1] - ends[0], np.diff(ends)
            if len(sizes):
                values = values / np.repeat(np.maximum.reduceat(np.abs(values), starts), sizes)
                values /= np.repeat(np.sqrt(np.add.reduceat(values**2, starts)), sizes)
            yield {
                "vec_id": batch.column(0), "label": batch.column(1),
                "_unit": pa.ListArray.from_arrays((ends - ends[0]).astype(np.int32), values),
            }

    return map_arrow(vectors.select("vec_id", "label", "v"), step, "vec_id long, label long, _unit array<double>")


def _postings(vectors: DataFrame, pivots: np.ndarray, nearest: int, shared: int) -> DataFrame:
    """One row per vector and pair of its nearest pivots: label, list, vec_id, the nearest pivots in order of their number,
    and the vector."""
    known = vectors.sparkSession.sparkContext.broadcast(pivots)

    def step(batches):
        points = known.value
        width = min(nearest, len(points))
        choices = np.array(list(combinations(range(width), min(shared, width))))
        weights = (len(points) + 1) ** np.arange(choices.shape[1])
        for batch in batches:
            units = _unit_vectors(batch.column(2))
            near = _nearest_by_part(units, points, width)
            near.sort(axis=1)
            lists = (near[:, choices] * weights).sum(axis=2)
            times, rows = lists.shape[1], np.repeat(np.arange(len(units)), lists.shape[1])
            at = pa.array(rows)
            yield {
                "label": batch.column(1).take(at), "list": lists.ravel(), "vec_id": batch.column(0).take(at),
                "near": pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * width, near[rows].astype(np.int32).ravel()),
                "unit": batch.column(2).take(at),
            }

    return map_arrow(
        vectors.select("vec_id", "label", "_unit"), step,
        "label long, list long, vec_id long, near array<int>, unit array<double>",
    )


def _blocks(postings: DataFrame, block: int) -> DataFrame:
    """The postings of lists with two vectors or more, with ``left`` and ``right``: the blocks that meet in a task.

    A list is cut into as many blocks as its length asks for, and each vector goes to every pair of blocks that its own
    block is part of; a list of at most ``block`` vectors is a single pair, so its rows are not repeated."""
    lengths = postings.groupBy("label", "list").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    lengths = lengths.select("label", "list", F.ceil(F.col("length") / block).cast("int").alias("parts"))
    placed = postings.join(lengths, ["label", "list"]).withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts").cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(
        F.least("part", j).alias("left"), F.greatest("part", j).alias("right")
    ))
    return placed.withColumn("meet", F.explode(others)).select(
        "label", "list", "meet.left", "meet.right", "vec_id", "part", "near", "unit"
    )


def _compare(blocks: DataFrame, threshold: float, shared: int, width: int, pivots: int) -> DataFrame:
    """vec_id, links, other: how many links of a vector this list reports, and one vector of the connected piece it is in
    there (itself without any). A pair is reported in the first of the lists that it shares, and by one pair of blocks."""
    ordered = blocks.repartition("label", "list", "left", "right").sortWithinPartitions("label", "list", "left", "right", "vec_id")
    weights = np.array([(pivots + 1) ** i for i in range(shared)])

    def compare(run: dict) -> dict | None:
        ids, near, units, part = run["vec_id"], run["near"], run["unit"], run["part"]
        if len(ids) < 2:
            return None
        own = run["list"][0]
        counts, piece = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        apart = run["left"][0] != run["right"][0]
        for start in range(0, len(ids), 512):
            rows = slice(start, start + 512)
            close = units[rows] @ units.T >= threshold
            close[np.arange(close.shape[0]), np.arange(start, start + close.shape[0])] = False
            if apart:
                close &= part[rows, None] != part[None, :]
            a, b = np.nonzero(close)
            if not len(a):
                continue
            a += start
            mine = _first_list(near[a], near[b], weights, shared) == own
            a, b = a[mine], b[mine]
            counts += np.bincount(a, minlength=len(ids))
            piece = _joined(piece, a, b)
        linked = counts > 0
        return {"vec_id": ids[linked], "links": counts[linked], "other": ids[piece[linked]]} if linked.any() else None

    def step(batches):
        names = ("label", "list", "left", "right", "vec_id", "part")
        waiting = None
        for batch in batches:
            rows = {n: numpy_of(batch.column(i)) for i, n in enumerate(names)}
            rows["near"], rows["unit"] = _unit_vectors(batch.column(6)), _unit_vectors(batch.column(7))
            if waiting is not None:
                rows = {n: np.concatenate([waiting[n], v]) for n, v in rows.items()}
            change = np.zeros(len(rows["list"]) - 1, dtype=bool)
            for n in names[:4]:
                change |= rows[n][1:] != rows[n][:-1]
            edges = np.concatenate([[0], np.flatnonzero(change) + 1])
            for begin, end in zip(edges[:-1], edges[1:]):
                found = compare({n: v[begin:end] for n, v in rows.items()})
                if found:
                    yield found
            waiting = {n: v[edges[-1]:] for n, v in rows.items()}
        if waiting is not None and (found := compare(waiting)):
            yield found

    return map_arrow(ordered, step, "vec_id long, links long, other long")


def _first_list(a: np.ndarray, b: np.ndarray, weights: np.ndarray, shared: int) -> np.ndarray:
    """The list of the first ``shared`` pivots that two descriptions (sorted) have in common."""
    common = (a[:, :, None] == b[:, None, :]).any(axis=2)
    order = np.argsort(~common, axis=1, kind="stable")[:, :shared]
    return (np.take_along_axis(a, order, axis=1) * weights).sum(axis=1)


def _joined(piece: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pieces after joining those of ``a`` and ``b``; a piece is named after its smallest member."""
    while True:
        least = np.minimum(piece[a], piece[b])
        before = piece.copy()
        np.minimum.at(piece, a, least)
        np.minimum.at(piece, b, least)
        np.minimum.at(piece, before[a], least)
        np.minimum.at(piece, before[b], least)
        piece = piece[piece]
        if (piece == before).all():
            return piece


def near_duplicates(
    vectors: DataFrame, work: Workspace, threshold: float = THRESHOLD, nearest: int = NEAREST, shared: int = SHARED,
    block: int = BLOCK,
) -> NearDuplicates:
    """Links between vectors of one label with cosine ``threshold`` or more, from columns vec_id, embedding and label.

    ``vectors`` of the result has a row per vec_id: n_links, component_id (the smallest vec_id that links reach) and kept
    (it names its component). Rows that repeat a vec_id are one vector, the smallest by label and embedding. Vectors that
    are NULL, empty or zero, hold NULL or non-finite components or have no label link with nothing; vectors link with
    vectors of their own length only, and each length has an index of its own, so the lengths should be few. Labels may have
    any type; those that are no whole numbers enter by a 64-bit hash. Rows with a NULL vec_id have no links and a NULL
    component, and are not kept. An empty table gives no rows. Whatever is linked has been verified; a link is missed when the two vectors share fewer than ``shared``
    of their nearest pivots, of which each has ``nearest`` or more.
    """
    whole = isinstance(vectors.schema["label"].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    label = F.col("one.label").cast("long") if whole else F.when(F.col("one.label").isNotNull(), F.xxhash64("one.label"))
    named = vectors.where(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(
        F.min(F.struct("label", F.col("embedding").cast("array<double>").alias("v"))).alias("one")
    ).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("one.v").alias("v"))
    good = work.store(_units(named.where(F.col("label").isNotNull() & usable(F.col("v")))), "units")
    lengths = good.groupBy(F.size("_unit").alias("length")).count().where("count > 1").orderBy("length").collect()
    every = named.select("vec_id")
    if not lengths:
        links = work.spark.createDataFrame([], "a long, b long")
        found = every.withColumns({"n_links": F.lit(0).cast("long"), "component_id": F.col("vec_id")})
    else:
        parts = []
        for length in lengths:
            own = good.where(F.size("_unit") == length["length"])
            pivots, described = choose_pivots(own, length["count"], threshold, nearest, shared)
            common = min(shared, described, len(pivots))
            blocks = _blocks(_postings(own, pivots, described, common), block)
            parts.append(work.store(_compare(blocks, threshold, common, described, len(pivots)), "compared"))
        compared = reduce(DataFrame.unionByName, parts)
        links = work.store(compared.where("vec_id <> other").select(F.col("vec_id").alias("a"), F.col("other").alias("b")).distinct(), "pieces")
        counts = compared.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
        roots = components(links, work).select(F.col("node").alias("vec_id"), "root")
        found = every.join(counts, "vec_id", "left").join(roots, "vec_id", "left").select(
            "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "vec_id").alias("component_id")
        )
    unnamed = vectors.where(F.col("vec_id").isNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id")
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return NearDuplicates(found.unionByName(unnamed).withColumn("kept", kept), links)
