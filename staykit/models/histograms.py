"""Importances of a random forest, grown over rows that are binned once and lie as one byte per column.

The forest is MLlib's, step by step: thresholds between values by equal numbers of rows, Poisson bags, the square root of the
columns tried per node, Gini gains, leaves of one class or without gain, siblings that say the same cut off, and importances as
gains weighted by rows, each tree's adding up to 1. What differs is the layout: MLlib bins and copies all rows for each forest
and walks through all trees row by row; here a task goes through its rows tree by tree and node by node, one column at a time,
so that the counts at hand stay in the processor's cache. Counts are whole numbers: the order of tasks and rows changes nothing.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MAX_BINS = 32
MAX_CLASSES = 100  # MLlib's limit
# A column's distinct values up to this many are counted one by one, beyond it by as many ranges of about equal numbers of rows.
VALUES = 4096
# Rows that a task looks at together, and blocks of rows that it gets at most: few enough for its memory, many enough for the
# counts that it hands on to be small beside them.
CHUNK_ROWS, TASK_BLOCKS = 131_072, 32
# Bytes of counts that are worth a task of their own when those of several tasks are added up.
LEAST_COUNTS = 500_000


def rows_of(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """``values`` of a batch as rows of ``width`` numbers: an array column, or binary with one byte per column."""
    column = batch.column("values")
    if pa.types.is_binary(column.type):
        return bytes_of(column, width)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)


def bytes_of(column: pa.Array, width: int) -> np.ndarray:
    """Binary values of ``width`` bytes each as rows of bytes."""
    _, ends, data = column.buffers()
    first = np.frombuffer(ends, dtype=np.int32)[column.offset] if len(column) else 0
    return np.frombuffer(data or b"", dtype=np.uint8)[first : first + len(column) * width].reshape(len(column), width)


def as_bytes(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary column."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def summed(values: np.ndarray, counts: np.ndarray, most: int = VALUES) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order with their counts. Where there are more than ``most``, a value that is kept stands for those
    below it, too."""
    values, place = np.unique(values, return_inverse=True)
    counts = np.bincount(place, weights=counts, minlength=len(values)).astype(np.int64)
    if len(values) <= most:
        return values, counts
    reached = np.cumsum(counts)
    span = (reached - 1) * most // reached[-1]
    last = np.append(np.flatnonzero(np.diff(span)), len(values) - 1)
    return values[last], np.diff(reached[last], prepend=0)


def thresholds(values: np.ndarray, counts: np.ndarray, bins: int = MAX_BINS) -> np.ndarray:
    """At most ``bins`` - 1 values between the given ones that divide the rows about equally (MLlib's rule)."""
    between = (values[:-1] + values[1:]) / 2
    if len(between) < bins:
        return between
    reached, stride = np.cumsum(counts), counts.sum() / bins
    target, found = stride, []
    for i in range(len(between)):
        if abs(reached[i] - target) < abs(reached[i + 1] - target):
            found.append(between[i])
            target += stride
    return np.array(found[: bins - 1])


def cut_points(frame: DataFrame, width: int, tasks: int) -> tuple[list[np.ndarray], int]:
    """Thresholds of each of the ``width`` columns of ``values``, from all rows, and the number of classes in ``label``."""

    def count(batches):
        kept = {}
        for batch in batches:
            labels, values = batch.column("label").to_numpy(zero_copy_only=False), rows_of(batch, width)
            if not np.isfinite(values).all():
                raise ValueError("values must not be NaN or infinite")
            for i in range(-1, width):
                found, n = np.unique(labels if i < 0 else values[:, i], return_counts=True)
                old = kept.get(i, (found[:0], n[:0]))
                kept[i] = summed(np.concatenate([old[0], found]), np.concatenate([old[1], n]))
        for i, (found, n) in kept.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([found]), pa.array([n])], names=["feature", "found", "n"])

    def cut(batches):
        parts = defaultdict(list)
        for batch in batches:
            for i, found, n in zip(*(batch.column(k) for k in ("feature", "found", "n"))):
                parts[i.as_py()].append((found.values.to_numpy(), n.values.to_numpy()))
        for i, own in parts.items():
            values, counts = (np.concatenate(x) for x in zip(*own))
            values, counts = summed(values, counts)
            found = values if i < 0 else thresholds(values, counts, min(MAX_BINS, counts.sum()))
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([found], pa.list_(pa.float64()))], names=["feature", "found"])

    counted = frame.mapInArrow(count, "feature int, found array<double>, n array<bigint>")
    found = counted.repartition(tasks, "feature").mapInArrow(cut, "feature int, found array<double>").collect()
    cuts = {r["feature"]: np.array(r["found"]) for r in found}
    labels = cuts.pop(-1, np.zeros(0))
    if not len(labels):
        raise ValueError("there are no rows")
    if np.isnan(labels).any() or (labels < 0).any() or (labels % 1 > 0).any() or labels.max() >= MAX_CLASSES:
        raise ValueError(f"labels must be whole numbers from 0 to {MAX_CLASSES - 1}")
    return [cuts[i] for i in range(width)], int(labels.max()) + 1


def binned(frame: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """``values`` as binary, each column's bin in one byte; the other columns as they are."""

    def place(batches):
        for batch in batches:
            values = rows_of(batch, len(cuts))
            bins = np.empty(values.shape, dtype=np.uint8)
            for i, points in enumerate(cuts):
                bins[:, i] = np.searchsorted(points, values[:, i])
            at = batch.schema.get_field_index("values")
            yield batch.set_column(at, pa.field("values", pa.binary()), as_bytes(bins))

    kinds = ", ".join(f"`{c}` {'binary' if c == 'values' else kind}" for c, kind in frame.dtypes)
    return frame.mapInArrow(place, kinds)


# Chances of 0, 1, 2 ... copies of a row in a bag, in steps of 2**-16.
_COPIES = np.searchsorted(np.cumsum([np.exp(-1) / np.prod(np.arange(1, k + 1)) for k in range(9)]), (np.arange(2**16) + 0.5) / 2**16)
_COPIES = _COPIES.astype(np.uint8)


def bags(rows: int, trees: int, random: np.random.Generator) -> np.ndarray:
    """How often each of ``trees`` trees sees each row: Poisson numbers of mean 1. A single tree sees all rows once."""
    if trees == 1:
        return np.ones((rows, 1), dtype=np.uint8)
    return _COPIES[random.integers(0, 2**16, (rows, trees), dtype=np.uint16)]


@dataclass
class Trees:
    """Splits of all trees, by tree and node; node n has the children 2 n + 1 and 2 n + 2. A node without a split has the
    feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray  # weighted by rows
    says: np.ndarray  # the class that most rows of a node have
    open: np.ndarray  # whether the node may be split

    @staticmethod
    def planted(trees: int, depth: int) -> Trees:
        nodes = 2 ** (depth + 1) - 1
        numbers, classes = np.full((trees, nodes), -1, dtype=np.int32), np.zeros((trees, nodes), dtype=np.int32)
        started = np.zeros((trees, nodes), dtype=bool)
        started[:, :1] = depth > 0
        return Trees(numbers, numbers.copy(), np.zeros((trees, nodes)), classes, started)

    def split(self, rows) -> None:
        """Enters splits, rows of ``_SPLIT``."""
        for tree, node, column, bin_, gain, says_left, says_right, open_left, open_right in rows:
            self.feature[tree, node], self.cut[tree, node], self.gain[tree, node] = column, bin_, gain
            self.says[tree, 2 * node + 1 : 2 * node + 3] = says_left, says_right
            self.open[tree, 2 * node + 1 : 2 * node + 3] = open_left, open_right

    def importances(self, width: int) -> np.ndarray:
        """Sum of gains per column, of splits whose halves differ in what they say, each tree and their mean scaled to 1."""
        total = np.zeros(width)
        for feature, gain, says in zip(self.feature.copy(), self.gain, self.says):
            own = np.zeros(width)
            for node in range(len(feature) - 1, -1, -1):
                if feature[node] < 0:
                    continue
                left, right = 2 * node + 1, 2 * node + 2
                if feature[left] < 0 and feature[right] < 0 and says[left] == says[right]:
                    feature[node] = -1
            for node in np.flatnonzero(feature >= 0):
                own[feature[node]] += gain[node]
            total += own / (own.sum() or 1)
        return total / (total.sum() or 1)


def _rows_at(codes: np.ndarray, rows: np.ndarray, feature, cut, step: int, level: int) -> dict[int, np.ndarray]:
    """The rows of one tree by node of ``level``, those that end in a leaf above it left out. A bin is ``step`` codes wide."""
    nodes = {0: rows}
    for _ in range(level):
        below = {}
        for node, own in nodes.items():
            if feature[node] >= 0:
                left = codes[feature[node]].take(own) < (int(cut[node]) + 1) * step
                below[2 * node + 1], below[2 * node + 2] = own.compress(left), own.compress(~left)
        nodes = below
    return nodes


def _repeated(copies: np.ndarray) -> np.ndarray:
    """Numbers of rows, each as often as ``copies`` says."""
    rows, found = np.flatnonzero(copies), []
    while len(rows):
        found.append(rows)
        rows = rows.compress(copies.take(rows) > len(found))
    return np.concatenate(found) if found else rows


def best_split(counts: np.ndarray) -> tuple[int, int, float, np.ndarray, np.ndarray] | None:
    """The place of the column and the last bin to the left that lower the Gini impurity most, by how much times the rows, and
    the classes of both halves. ``counts``: rows by column, bin and class."""
    left = counts.cumsum(axis=1)[:, :-1].astype(float)
    right = counts[0].sum(axis=0) - left
    n_left, n_right = left.sum(axis=2), right.sum(axis=2)
    whole = counts[0].sum(axis=0).astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        kept = (left**2).sum(axis=2) / n_left + (right**2).sum(axis=2) / n_right
    gain = np.where((n_left > 0) & (n_right > 0), kept - (whole**2).sum() / max(1.0, whole.sum()), -1.0)
    place, bin_ = np.unravel_index(gain.argmax(), gain.shape) if gain.size else (0, 0)
    # A gain that rounding makes out of halves with the same shares is none.
    if not gain.size or gain[place, bin_] <= 1e-12 * whole.sum():
        return None
    return int(place), int(bin_), float(gain[place, bin_]), left[place, bin_], right[place, bin_]


@dataclass
class Forest:
    """What all tasks need to know of a forest: bins of each column, classes, trees, depth, and the seed of the columns tried."""

    bins: list[int]
    classes: int
    trees: int
    depth: int
    seed: int

    def __post_init__(self):
        self.width, self.most = len(self.bins), max(self.bins)
        self.tried = self.width if self.trees == 1 else int(np.ceil(np.sqrt(self.width)))
        self.size = self.most * self.classes
        # A bin and class has several counters, which rows take in turn: increasing one that was just written would wait for it.
        self.lanes = max(1, min(4, 256 // self.size))

    def level(self, grown: Trees, level: int) -> Level | None:
        """The nodes of a level that may be split, with the columns that each tries; None if there is no such node."""
        first, nodes = 2**level - 1, 2**level
        wanted = [[first + int(n) for n in np.flatnonzero(own[first : first + nodes])] for own in grown.open]
        if not any(wanted):
            return None
        columns = np.broadcast_to(np.arange(self.width), (self.trees, nodes, self.width))
        if self.tried < self.width:
            drawn = np.random.default_rng([self.seed, level]).random(columns.shape)
            columns = drawn.argpartition(self.tried - 1, axis=2)[:, :, : self.tried]
        return Level(level, wanted, columns.astype(np.int32), grown.feature[:, :first].copy(), grown.cut[:, :first].copy())

    def codes(self, labels: np.ndarray, values: np.ndarray) -> np.ndarray:
        """By column and row: bin, class and counter in one number."""
        codes = np.ascontiguousarray(values.T).astype(np.min_scalar_type(self.size * self.lanes - 1))
        codes *= self.classes * self.lanes
        codes += (labels * self.lanes + np.arange(len(labels)) % self.lanes).astype(codes.dtype)
        return codes

    def count(self, at: Level, sums: list[np.ndarray], codes: np.ndarray, copies: np.ndarray) -> None:
        """Adds some rows to ``sums``, by tree: rows by node, column tried, and bin and class."""
        for tree, own in enumerate(at.wanted):
            if own:
                rows = _rows_at(codes, _repeated(copies[tree]), at.feature[tree], at.cut[tree], self.classes * self.lanes, at.level)
                for place, node in enumerate(own):
                    found = np.zeros((self.tried, self.size * self.lanes), dtype=np.int64)
                    for slot, i in enumerate(at.tried(tree, node)):
                        if self.bins[i] > 1:
                            found[slot] = np.bincount(codes[i].take(rows[node]), minlength=self.size * self.lanes)
                    sums[tree][place] += found.reshape(self.tried, self.size, self.lanes).sum(axis=2)

    def nothing(self, at: Level) -> list[np.ndarray]:
        return [np.zeros((len(own), self.tried, self.size), dtype=np.int64) for own in at.wanted]

    def splits(self, at: Level, tree: int, counts: np.ndarray):
        """Rows of ``_SPLIT`` for the nodes of a tree that gain by a split."""
        counts = counts.reshape(len(at.wanted[tree]), self.tried, self.most, self.classes)
        for place, node in enumerate(at.wanted[tree]):
            columns = at.tried(tree, node)
            # Columns of one bin were not counted and cannot be split.
            usable = [slot for slot, i in enumerate(columns) if self.bins[i] > 1]
            found = best_split(counts[place, usable]) if usable else None
            if found:
                slot, cut, gain, left, right = found
                open_ = [bool((half > 0).sum() > 1) for half in (left, right)]
                yield tree, node, int(columns[usable[slot]]), cut, gain, int(left.argmax()), int(right.argmax()), *open_


@dataclass
class Level:
    """Nodes by tree that may be split, the columns they try, and the splits above them."""

    level: int
    wanted: list[list[int]]
    columns: np.ndarray
    feature: np.ndarray
    cut: np.ndarray

    def tried(self, tree: int, node: int) -> np.ndarray:
        return self.columns[tree, node - 2**self.level + 1]


def forest_importances(
    frame: DataFrame, bins: list[int], classes: int, trees: int, depth: int, tasks: int, blocks: int, seed: int
) -> np.ndarray:
    """Importances of the columns of a forest of ``trees`` trees.

    ``frame`` has ``label``, ``values`` (bins, one byte per column, of which column i has ``bins[i]``) and ``bags`` (a byte per
    tree); it is read once per level. ``tasks`` count at a time, more where one would get too many of the ``blocks``. What they
    count is added up by tree on the executors, and only splits reach the driver. A single block is one task, which has all
    rows and so grows the forest by itself.
    """
    forest, grown = Forest(bins, classes, trees, depth, seed), Trees.planted(trees, depth)
    counting = max(1, min(tasks, blocks), -(-blocks // TASK_BLOCKS))
    frame = frame.coalesce(counting)
    if blocks == 1:
        return np.array(frame.mapInArrow(_grown(forest), "importances array<double>").collect()[0][0])
    for level in range(depth):
        at = forest.level(grown, level)
        if at is None:
            break
        counted = frame.mapInArrow(_counted(forest, at), "tree int, counts binary")
        if counting > 1:
            held = sum(map(len, at.wanted)) * forest.tried * forest.size * 8
            counted = counted.repartition(max(1, min(trees, tasks, held // LEAST_COUNTS)), "tree")
        grown.split(counted.mapInArrow(_splits(forest, at), _SPLIT_ROW).collect())
    return grown.importances(forest.width)


def _counted(forest: Forest, at: Level):
    def count(batches):
        sums = forest.nothing(at)
        for labels, values, copies in _chunks(batches, forest.width, forest.trees):
            forest.count(at, sums, forest.codes(labels, values), np.ascontiguousarray(copies.T))
        for tree, own in enumerate(at.wanted):
            if own:
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([sums[tree].tobytes()])], names=["tree", "counts"])

    return count


def _splits(forest: Forest, at: Level):
    def split(batches):
        sums = {}
        for batch in batches:
            for tree, counts in zip(batch.column("tree").to_pylist(), batch.column("counts")):
                found = np.frombuffer(counts.as_buffer(), dtype=np.int64)
                sums[tree] = sums[tree] + found if tree in sums else found
        rows = [row for tree, counts in sums.items() for row in forest.splits(at, tree, counts)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), _SPLIT.types)], names=_SPLIT.names)

    return split


def _grown(forest: Forest):
    def grow(batches):
        grown = Trees.planted(forest.trees, forest.depth)
        held = [(forest.codes(labels, values), np.ascontiguousarray(copies.T)) for labels, values, copies in _chunks(batches, forest.width, forest.trees)]
        for level in range(forest.depth):
            at = forest.level(grown, level)
            if at is None:
                break
            sums = forest.nothing(at)
            for codes, copies in held:
                forest.count(at, sums, codes, copies)
            grown.split([row for tree, own in enumerate(at.wanted) if own for row in forest.splits(at, tree, sums[tree])])
        yield pa.RecordBatch.from_arrays([pa.array([grown.importances(forest.width)], pa.list_(pa.float64()))], names=["importances"])

    return grow


_SPLIT_ROW = "tree int, node int, feature int, cut int, gain double, says_left int, says_right int, open_left boolean, open_right boolean"
_SPLIT = pa.schema(
    [(name, {"int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}[kind]) for name, kind in (x.split() for x in _SPLIT_ROW.split(", "))]
)


def _chunks(batches, width: int, trees: int):
    """Labels, bins and bags of up to about ``CHUNK_ROWS`` rows at a time."""
    held, rows = [], 0
    for batch in batches:
        held.append((batch.column("label").to_numpy(zero_copy_only=False), rows_of(batch, width), bytes_of(batch.column("bags"), trees)))
        rows += batch.num_rows
        if rows >= CHUNK_ROWS:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, rows = [], 0
    if rows:
        yield tuple(np.concatenate(x) for x in zip(*held))
