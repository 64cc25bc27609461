"""Importance resampling towards a target: documents whose hashed word n-grams look like the target's are drawn more often.

N-grams are interned batch by batch in an open-addressed table of numpy arrays: xxhash64 keys, linear probing, and the bytes
compared wherever two keys agree. A slot holds its n-gram's bucket and its count in the batch; each occurrence keeps the
number of its slot, through which counts are summed up and gains are gathered.
"""

from __future__ import annotations

from dataclasses import dataclass
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F
import xxhash

from staykit.llm.arrow import map_arrow, numpy_of, with_bytes
from staykit.operators.ranking import exact_rank
from staykit.sources.tables import Workspace

BUCKETS = 10_000
# Words interned at a time, and text brought together for it: they bound a task's memory, whatever the length of the texts.
SLICE_WORDS = 250_000
SLICE_BYTES = 2_000_000
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
# The five primes of xxHash64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in
    (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)
# Longer n-grams are hashed one by one by the library.
_SHORT = 32


@dataclass
class Words:
    """The words of some texts, one space behind each, in one buffer; ``doc`` numbers the text of each word."""

    buffer: np.ndarray  # bytes, with eight zeros at the end
    start: np.ndarray
    length: np.ndarray
    doc: np.ndarray


def find_words(texts: list[bytes]) -> Words:
    """Maximal runs of digits, ASCII letters (lower-cased) and bytes beyond ASCII."""
    raw = np.frombuffer(b"\n".join(texts).translate(_WORD_BYTES) + b" ", np.uint8)
    inside = raw != 32
    before = np.concatenate([[False], inside[:-1]])
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    doc = np.searchsorted(np.cumsum(sizes + 1), start, side="right")
    length = end - start
    buffer = np.concatenate([raw[inside | before], np.zeros(8, np.uint8)])
    return Words(buffer, np.concatenate([[0], np.cumsum(length + 1)[:-1]]) if len(length) else length, length, doc)


def word_runs(words: Words, begin: int, end: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text number of every run of 1 to ``longest`` words that starts at words ``begin`` to ``end``."""
    starts, lengths, docs = [], [], []
    for more in range(longest):
        first = np.arange(begin, min(end, len(words.start) - more))
        first = first[words.doc[first] == words.doc[first + more]]
        starts.append(words.start[first])
        lengths.append(words.start[first + more] + words.length[first + more] - words.start[first])
        docs.append(words.doc[first])
    return np.concatenate(starts), np.concatenate(lengths), np.concatenate(docs)


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _lanes(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    return np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))


def _hash_alike(buffer: np.ndarray, lanes: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """xxhash64 (seed 0) of n-grams that all have ``length`` bytes, fewer than 32."""
    h = np.full(len(start), _P5 + np.uint64(length), np.uint64)
    at = 0
    while at + 8 <= length:
        h ^= _rotated(lanes[start + at] * _P2, 31) * _P1
        h = _rotated(h, 27) * _P1 + _P4
        at += 8
    if at + 4 <= length:
        h ^= (lanes[start + at] & np.uint64(0xFFFFFFFF)) * _P1
        h = _rotated(h, 23) * _P2 + _P3
        at += 4
    for place in range(at, length):
        h ^= buffer[start + place].astype(np.uint64) * _P5
        h = _rotated(h, 11) * _P1
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    return h ^ (h >> np.uint64(32))


def hash_runs(buffer: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """xxhash64 of each n-gram's bytes."""
    hashes, lanes = np.empty(len(start), np.uint64), _lanes(buffer)
    capped = np.minimum(length, _SHORT).astype(np.uint8)
    order = np.argsort(capped, kind="stable")
    ends = np.cumsum(np.bincount(capped, minlength=_SHORT + 1))
    for size in range(_SHORT):
        own = order[ends[size - 1] if size else 0:ends[size]]
        if len(own):
            hashes[own] = _hash_alike(buffer, lanes, start[own], size)
    rest, data = order[ends[_SHORT - 1]:], memoryview(buffer)
    for i in rest.tolist():
        hashes[i] = xxhash.xxh64_intdigest(data[start[i]:start[i] + length[i]])
    return hashes


class GramTable:
    """An open-addressed table over the n-grams of one batch. ``slot`` is the place of each occurrence's n-gram; ``used``
    lists the places in use, ``count`` how often each of them occurs, ``bucket`` its bytes' crc32 modulo the buckets."""

    def __init__(self, buffer: np.ndarray, start: np.ndarray, length: np.ndarray, buckets: int = BUCKETS, hashes=None):
        hashes = hash_runs(buffer, start, length) if hashes is None else hashes
        size = 1 << max(4, (2 * len(start)).bit_length())
        owner = np.full(size, -1, np.int32)  # the occurrence that first took the slot
        mask = np.uint64(size - 1)
        self.slot = (hashes & mask).astype(np.int64)
        lanes, waiting = _lanes(buffer), np.arange(len(start), dtype=np.int32)
        while len(waiting):
            slot = self.slot[waiting]
            holder = owner[slot]
            free = holder < 0
            owner[slot[free]] = waiting[free]  # one of several stays; the others compare themselves with it
            holder = owner[slot]
            same = hashes[holder] == hashes[waiting]
            same[same] = _same_bytes(lanes, start, length, holder[same], waiting[same])
            waiting = waiting[~same]
            self.slot[waiting] = (self.slot[waiting] + 1) & (size - 1)
        self.used = np.flatnonzero(owner >= 0)
        self.count = np.bincount(self.slot, minlength=size)[self.used]
        data, first = memoryview(buffer), owner[self.used]
        places = map(slice, start[first].tolist(), (start[first] + length[first]).tolist())
        crc = np.fromiter(map(zlib.crc32, map(data.__getitem__, places)), np.int64, len(first))
        self.bucket = np.zeros(size, np.int64)
        self.bucket[self.used] = crc % buckets

    def gather(self, values: np.ndarray) -> np.ndarray:
        """The value of each occurrence's bucket."""
        held = np.zeros(len(self.bucket), values.dtype)
        held[self.used] = values[self.bucket[self.used]]
        return held[self.slot]


def _same_bytes(lanes, start, length, a, b) -> np.ndarray:
    """Whether n-grams ``a`` and ``b`` have the same bytes, pair by pair."""
    same = length[a] == length[b]
    left, x, y, size = np.flatnonzero(same), start[a], start[b], length[a]
    at = 0
    while len(left):
        bits = np.minimum(size[left] - at, 8).astype(np.uint64) * np.uint64(8)
        differ = (lanes[x[left] + at] ^ lanes[y[left] + at]) << (np.uint64(64) - bits)
        same[left[differ != 0]] = False
        at += 8
        left = left[(differ == 0) & (size[left] > at)]
    return same


def _chunks(column, limit: int = SLICE_BYTES):
    """Row numbers and texts, cut where ``limit`` bytes are reached; a longer text comes alone."""
    begin, texts, size = 0, [], 0
    for row, value in enumerate(column):
        text = value.as_buffer().to_pybytes() if value.is_valid else b""
        if texts and size + len(text) > limit:
            yield begin, texts
            begin, texts, size = row, [], 0
        texts.append(text)
        size += len(text) + 1
    if texts:
        yield begin, texts


def _tables(words: Words, longest: int, buckets: int):
    """The n-grams of some words, interned in slices of bounded size: text numbers of the occurrences and their table."""
    for begin in range(0, len(words.start), SLICE_WORDS):
        start, length, doc = word_runs(words, begin, begin + SLICE_WORDS, longest)
        yield doc, GramTable(words.buffer, start, length, buckets)


def count_buckets(texts: DataFrame, longest: int = 2, buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """``bucket`` and ``n``: occurrences of all runs of 1 to ``longest`` words, by bucket. Tasks add up before anything is
    shuffled, so at most ``buckets`` rows of each are. NULL and empty texts have none; an empty table gives no rows."""

    def step(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, chunk in _chunks(batch.column(0)):
                for _, table in _tables(find_words(chunk), longest, buckets):
                    total += np.bincount(table.bucket[table.used], table.count, buckets).astype(np.int64)
        found = np.flatnonzero(total)
        yield {"bucket": found, "n": total[found]}

    counted = map_arrow(with_bytes(texts.select(text), text), step, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``gain``, floor(1000 ln of target share over source share), of every bucket, one added to each count.

    ``source`` and ``target`` are tables of ``count_buckets``.
    """
    every = source.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    both = every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    both = both.fillna(0, ["s", "t"])
    all_s, all_t = (table.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar() for table in (source, target))
    top = (F.col("t") + 1).cast("double") * (all_s + buckets)
    bottom = (F.col("s") + 1).cast("double") * (all_t + buckets)
    return both.select("bucket", F.floor(1000 * F.log(top / bottom)).alias("gain"))


def weigh(docs: DataFrame, gains: DataFrame, longest: int = 2, buckets: int = BUCKETS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_words, n_features and weight (the floored mean of the gains of a text's n-grams, 0 without any).

    The gains, one number per bucket, are sent to the tasks; nothing is shuffled.
    """
    values = np.zeros(buckets, np.int64)
    for row in gains.toLocalIterator():
        values[row.bucket] = row.gain
    shared = docs.sparkSession.sparkContext.broadcast(values)

    def step(batches):
        for batch in batches:
            n_words, n_features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for first, chunk in _chunks(batch.column(1)):
                words, rows = find_words(chunk), slice(first, first + len(chunk))
                n_words[rows] = np.bincount(words.doc, minlength=len(chunk))
                for doc, table in _tables(words, longest, buckets):
                    n_features[rows] += np.bincount(doc, minlength=len(chunk))
                    # Whole numbers far below 2**53: exact as doubles.
                    total[rows] += np.bincount(doc, table.gather(shared.value), len(chunk)).astype(np.int64)
            weight = np.where(n_features > 0, total // np.maximum(n_features, 1), 0)
            yield {key: batch.column(0), "n_words": n_words, "n_features": n_features, "weight": weight}

    kind = docs.schema[key].dataType.simpleString()
    made = f"`{key}` {kind}, n_words long, n_features long, weight long"
    return map_arrow(with_bytes(docs.select(key, text), text), step, made)


def draw(weighed: DataFrame, work: Workspace, percent: int = 25, least_words: int = 20, seed: int = 7, key: str = "doc_id") -> DataFrame:
    """Rows of ``weigh`` with score (weight plus Gumbel noise from a hash of the key) and rank.

    The floor(percent * N / 100) best of the N texts of ``least_words`` words are drawn: rank 1, 2, 3 and so on by falling
    score, ties to the smaller key; other rows have none. Adding Gumbel noise and taking the best draws without replacement
    in proportion to the exponential of the weights.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    scored = work.store(weighed.withColumn("score", F.col("weight") + noise), "scored")
    able = F.col("n_words") >= least_words
    drawn = scored.where(able).count() * percent // 100
    order = [F.when(able, 0).otherwise(1), F.col("score").desc(), F.col(key).asc_nulls_last()]
    ranked = exact_rank(scored, order, work)
    return ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))


def resample(
    docs: DataFrame, target: DataFrame, work: Workspace, percent: int = 25, longest: int = 2, buckets: int = BUCKETS,
    least_words: int = 20, seed: int = 7, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``key``, n_words, n_features, weight, score and rank of every document (``draw``), towards the texts of ``target``.

    NULL and empty texts have no n-grams, weight 0, and are not drawn. A NULL key counts as empty in the noise and comes
    last among ties. Repeated rows are counted and ranked each. An empty target or table of documents gives every bucket
    its smoothed share; no documents, no rows. Further columns are ignored, so their names do not matter. Very long texts
    are interned slice by slice, so memory stays bounded but for the text itself.
    """
    counts = work.store_all({
        "source": count_buckets(docs, longest, buckets, text), "target": count_buckets(target, longest, buckets, text)
    })
    gains = bucket_gains(counts["source"], counts["target"], buckets)
    return draw(weigh(docs, gains, longest, buckets, key, text), work, percent, least_words, seed, key)
