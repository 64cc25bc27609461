"""Jaccard join of documents on word shingles by a size-aware split into light and heavy sets.

Documents with the same set are one class, and the classes are joined. A set's shingles are put in one order for all sets,
rare ones first, so that two sets that link share shingles in their prefixes. Small (light) sets enumerate all pairs of
their prefix as keys: whoever shares a key shares two rare shingles. Large (heavy) sets, for which the pairs would be too
many, post single shingles and scan the inverted lists. The boundary is the size at which the estimated cost is lowest.

Only links that can change the components are verified. Lists propose few pairs first; once those are verified and
components known, only pairs of different components are left, and in the last round all of those are verified.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
import xxhash

from staykit.llm.arrow import map_arrow, numpy_of, with_bytes
from staykit.llm.components import components
from staykit.sources.tables import Workspace

SHINGLE = 5
PERCENT = 75
# Counters of the frequency sketch that orders the shingles. It only has to tell very frequent ones from the rest; the join
# is exact whatever it says.
SKETCH = 2**17
# Bits of the map that says which classes' sets are needed. A false hit costs a set that is joined away.
NEED_BITS = 2**24
REMEMBERED_WORDS = 300_000
# Postings of one list that wait in a task to be compared with one another. A longer list is handed on as it comes.
LONG_LIST = 200_000
# One in so many shingles is counted exactly, to tell how long lists are; and so many of those reach the driver at most.
SAMPLED = 1024
SAMPLE_ROWS = 200_000
# Odd constants of the shingle hash.
_BASE, _OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
# Texts that are shingled at once, for bounded memory whatever the size of an Arrow batch.
TEXTS_AT_ONCE = 500


def mixed(values: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    return values ^ (values >> np.uint64(33))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


class Shingler:
    """Sets of shingle hashes of texts (UTF-8 bytes). Words are runs of anything but ASCII white space, A-Z lower-cased."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.known = _WordHashes()

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """Per text the sorted distinct hashes; one for the whole sequence if it is shorter than a shingle; none without
        words. All texts are hashed in one go."""
        words = [t.lower().split() for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        total, size, known = int(counts.sum()), self.size, self.known.__getitem__
        hashes = np.fromiter((h for own in words for h in map(known, own)), np.uint64, total)
        rolled = np.zeros(max(0, total - size + 1), dtype=np.uint64)
        for i in range(size if len(rolled) else 0):
            rolled = rolled * _BASE + hashes[i:i + len(rolled)]
        rolled = mixed(rolled)
        ends, sets = np.cumsum(counts), []
        for end, n in zip(ends.tolist(), counts.tolist()):
            if n >= size:
                sets.append(_distinct(rolled[end - n:end - size + 1]))
            elif n:
                whole = np.array([n], dtype=np.uint64)
                for h in hashes[end - n:end]:
                    whole = whole * _OTHER + h
                sets.append(mixed(whole))
            else:
                sets.append(np.zeros(0, dtype=np.uint64))
        return sets


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    keep = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def _in_parts(batches, column: int):
    """(batch, offset, texts) in parts of bounded length."""
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            part = batch.slice(at, TEXTS_AT_ONCE)
            yield part, part.column(column).to_pylist()


def class_of(shingles: np.ndarray) -> int:
    """64-bit name of a set."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - 2**63


def text_hash(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - 2**63


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Shared shingles that any partner of a set of ``n`` must have."""
    return -(-percent * n // 100)


def _signatures(rows: DataFrame, kind: str, size: int) -> DataFrame:
    """One pass over the texts: rows of kind 0 with key, set size, class and, as ``count``, a hash of the text; rows of kind 1 with counter and count of the
    frequency sketch, one per counter and task; rows of kind 2 with a sampled shingle and a class that has it. Copies within
    a task are counted once."""

    def step(batches):
        shingler, counters, seen = Shingler(size), np.zeros(SKETCH, dtype=np.int64), set()
        for batch, texts in _in_parts(batches, 1):
            sizes, classes, sampled, owners = [], [], [], []
            hashes = [text_hash(t) for t in texts]
            for shingles in shingler(texts):
                name = class_of(shingles)
                sizes.append(len(shingles))
                classes.append(name)
                if name not in seen:
                    seen.add(name)
                    drawn = shingles[(shingles >> np.uint64(40)) % np.uint64(SAMPLED) == 0].view(np.int64)
                    sampled.append(drawn)
                    owners.append(np.full(len(drawn), name, np.int64))
                    counters += np.bincount((shingles & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
            yield {"kind": np.zeros(len(sizes), np.int32), "key": batch.column(0), "n": sizes, "cls": classes, "count": hashes}
            if sampled:
                drawn = np.concatenate(sampled)
                yield {"kind": np.full(len(drawn), 2, np.int32), "key": [None] * len(drawn), "n": drawn, "cls": np.concatenate(owners), "count": np.zeros(len(drawn), np.int64)}
        used = np.flatnonzero(counters)
        for i in range(0, len(used), 10_000):
            own = used[i:i + 10_000]
            yield {"kind": np.ones(len(own), np.int32), "key": [None] * len(own), "n": own, "cls": np.zeros(len(own), np.int64), "count": counters[own]}

    return map_arrow(rows, step, f"kind int, key {kind}, n long, cls long, count long")


def _prefix_sizes(n: Column, percent: int) -> tuple[Column, Column]:
    """Posted keys of a set: as pairs of a light set, as single shingles of a heavy one."""
    over = n - F.ceil(n * percent / 100)
    light = F.least(over + 2, n)
    return light * (light - 1) / 2, over + 1


def choose_boundary(sizes: DataFrame, scan: float, percent: int = PERCENT) -> int:
    """The largest size of a light set, from a table of set sizes ``n``: where the keys of light sets and the keys and list
    scans of heavy ones cost least together. Sets just below the boundary have partners above and post both."""
    grid = [0, *(2**i for i in range(1, 21))]
    light, heavy = _prefix_sizes(F.col("n"), percent)
    costs = []
    for boundary in grid:
        own = F.when(F.col("n") <= boundary, light).otherwise(0.0)
        single = F.when(F.col("n") >= F.ceil(F.lit(boundary + 1) * percent / 100), heavy * (1 + scan)).otherwise(0.0)
        costs.append(F.sum(own + single).alias(f"c{boundary}"))
    found = sizes.where("n > 0").agg(*costs).first()
    return min(grid, key=lambda b: (found[f"c{b}"] or 0.0, b))


def _postings(rows: DataFrame, sketch: np.ndarray, boundary: int, percent: int, size: int) -> DataFrame:
    """key, cls, n, pos: the keys of each class, once per task. ``pos`` is the place in the set's order, -1 for pairs."""
    shared = rows.sparkSession.sparkContext.broadcast(sketch)
    both_from = least_overlap(boundary + 1, percent)

    def step(batches):
        shingler, counts, seen = Shingler(size), shared.value, set()
        for _, texts in _in_parts(batches, 0):
            keys, classes, sizes, places = [], [], [], []
            for shingles in shingler(texts):
                n, name = len(shingles), class_of(shingles)
                if not n or name in seen:
                    continue
                seen.add(name)
                over = n - least_overlap(n, percent)
                order = np.argsort(counts[(shingles & np.uint64(SKETCH - 1)).astype(np.int64)], kind="stable")
                ordered = shingles[order]
                if n <= boundary and n > 1:
                    prefix = ordered[:over + 2]
                    i, j = np.triu_indices(len(prefix), 1)
                    pairs = mixed(np.minimum(prefix[i], prefix[j]) * _BASE + np.maximum(prefix[i], prefix[j]) * _OTHER)
                    keys.append(pairs)
                    places.append(np.full(len(pairs), -1, np.int32))
                    classes.append(np.full(len(pairs), name, np.int64))
                    sizes.append(np.full(len(pairs), n, np.int32))
                if n >= both_from:
                    prefix = ordered[:over + 1]
                    keys.append(prefix)
                    places.append(np.arange(len(prefix), dtype=np.int32))
                    classes.append(np.full(len(prefix), name, np.int64))
                    sizes.append(np.full(len(prefix), n, np.int32))
            if keys:
                yield {
                    "key": np.concatenate(keys).view(np.int64), "cls": np.concatenate(classes), "n": np.concatenate(sizes),
                    "pos": np.concatenate(places),
                }

    return map_arrow(rows.select("_text"), step, "key long, cls long, n int, pos int")


def _shared_lists(postings: DataFrame, percent: int) -> DataFrame:
    """The postings whose key another class has as well, with ``least`` (see ``_least_shared``). Rows come sorted by key; the last list of a batch waits
    for the next batch, and of a list longer than ``LONG_LIST`` all are kept as they come."""
    ordered = postings.repartition("key").sortWithinPartitions("key", "cls")
    names = ("key", "cls", "n", "pos")

    def kept_of(rows, begins, *long_keys):
        least = _least_shared(rows, begins, percent, *long_keys)
        lone = np.diff(np.append(begins, len(rows[0]))) == 1
        kept = (~np.repeat(lone, np.diff(np.append(begins, len(rows[0]))))) | (least > 0)
        return {**dict(zip(names, (r[kept] for r in rows))), "least": least[kept]}

    def step(batches):
        waiting, long_key = [np.zeros(0, dtype=np.int64) for _ in names], None
        for batch in batches:
            rows = [np.concatenate([w, numpy_of(batch.column(i))]) for i, w in enumerate(waiting)]
            # The same class from several tasks counts once.
            first = np.ones(len(rows[0]), dtype=bool)
            first[1:] = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
            rows = [r[first] for r in rows]
            begins = np.flatnonzero(np.concatenate([[True], rows[0][1:] != rows[0][:-1]]))
            last = int(begins[-1])
            if len(rows[0]) - last > LONG_LIST:
                yield kept_of(rows, begins, long_key, rows[0][last])
                # One row stays behind, so that a repetition of it is noticed.
                waiting, long_key = [r[-1:] for r in rows], rows[0][last]
                continue
            done = [r[:last] for r in rows]
            if last:
                yield kept_of(done, begins[:-1], long_key)
            waiting = [r[last:] for r in rows]
        if len(waiting[0]):
            yield kept_of(waiting, np.zeros(1, dtype=np.int64), long_key)

    found = map_arrow(ordered, step, "key long, cls long, n int, pos int, least int")
    return found.groupBy("key", "cls", "n", "pos").agg(F.min("least").alias("least"))


def _often_enough(lists: DataFrame) -> DataFrame:
    """The postings that could link, of classes that are in as many lists as the easiest partner there asks for. A class
    that shares a shingle with another one by chance is in few lists, while two that link share much of their prefixes."""
    counts = lists.groupBy("cls").agg(F.count(F.lit(1)).alias("lists"))
    kept = lists.where("least > 0").join(counts, "cls").where(F.col("least") <= F.col("lists"))
    return kept.select("key", "cls", "n", "pos")


def _asked(a, b, percent: int):
    """How many prefix keys sets of sizes ``a`` and ``b`` share at least if they link.

    Of two sets, the one whose prefix ends first in the common order shares only what both prefixes share, and what is
    behind its prefix: fewer than ``least_overlap`` shingles. So the prefixes share at least the rest of the overlap needed.
    """
    needed = -(-percent * (a + b) // (100 + percent))
    return np.maximum(1, needed - -(-percent * np.maximum(a, b) // 100) + 1)


def _least_shared(rows, begins, percent: int, *long_keys) -> np.ndarray:
    """Per posting, sorted by key and with the places where lists begin, 0 if it could link with no other one of its list,
    else how many keys it must share with the easiest partner it could link with there.

    A partner's size is at least ``percent`` of the own, at most so much that the own size is ``percent`` of it, and what
    is left of the own set from this place on covers the overlap needed. Of the sizes in the list that fit, the smallest
    or the largest asks for least, so two searches in the list's sorted sizes tell. Lists of pairs of shingles, and the
    ``long_keys``, ask for one.
    """
    keys, _, n, pos = rows
    sizes = np.diff(np.append(begins, len(keys)))
    number = np.repeat(np.arange(len(begins)), sizes)
    smallest = -(-percent * n // 100)
    largest = 100 * n // percent
    single = pos >= 0
    rest = (n - pos) * (100 + percent) // percent - n
    largest = np.where(single, np.minimum(largest, rest), largest)
    wide = int(n.max()) + 2 if len(n) else 2
    codes = np.sort(number * wide + n)
    low = np.searchsorted(codes, number * wide + smallest)
    high = np.searchsorted(codes, number * wide + np.minimum(largest, wide - 1), side="right")
    own = (smallest <= n) & (n <= largest)
    some = high - low - own > 0
    at = lambda place: codes[np.clip(place, 0, max(len(codes) - 1, 0))] - number * wide
    asked = np.minimum(_asked(n, at(low), percent), _asked(n, at(high - 1), percent))
    long = np.isin(keys, [k for k in long_keys if k is not None])
    return np.where(long, 1, np.where(some, np.where(single, asked, 1), 0)).astype(np.int32)


def _needed_sets(rows: DataFrame, lists: DataFrame, own: DataFrame, size: int) -> DataFrame:
    """cls and its sorted shingles, for the classes that share a key. Other texts are told by a map of hashed texts, and
    not shingled again."""
    need = lists.select("cls").distinct()
    bit = F.pmod("text", F.lit(NEED_BITS))
    texts = own.join(need, "cls", "left_semi").select("text")
    words = texts.groupBy(F.floor(bit / 8).cast("int").alias("byte")).agg(
        F.bit_or(F.expr(f"shiftleft(1, CAST(pmod(text, {NEED_BITS}) % 8 AS INT))")).alias("bits")
    ).toArrow()
    marks = np.zeros(NEED_BITS // 8, dtype=np.uint8)
    marks[words.column(0).to_numpy()] = words.column(1).to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(marks)

    def step(batches):
        shingler, marked, seen = Shingler(size), shared.value, set()
        for _, texts in _in_parts(batches, 0):
            places = [text_hash(t) % NEED_BITS for t in texts]
            wanted = [t for t, at in zip(texts, places) if marked[at >> 3] >> (at & 7) & 1]
            classes, sets = [], []
            for shingles in shingler(wanted):
                name = class_of(shingles)
                if name not in seen:
                    seen.add(name)
                    classes.append(name)
                    sets.append(shingles.view(np.int64))
            yield {"cls": classes, "shingles": sets}

    sets = map_arrow(rows.select("_text"), step, "cls long, shingles array<long>")
    return sets.join(need, "cls", "left_semi").groupBy("cls").agg(F.any_value("shingles").alias("shingles"))


def _possible(percent: int, boundary: int) -> Column:
    """Whether a pair from one list can link, by sizes, by what is left behind the shared shingle in both orders, and by
    who reports it: of two light sets, the list of a pair."""
    small, large = F.least("n", "other_n"), F.greatest("n", "other_n")
    needed = F.ceil((F.col("n") + F.col("other_n")) * percent / (100 + percent))
    left = F.least(F.col("n") - F.col("pos"), F.col("other_n") - F.col("other_pos"))
    return (100 * small >= percent * large) & (F.col("pos") < 0) | (
        (F.col("pos") >= 0) & (100 * small >= percent * large) & (left >= needed) & (large > boundary)
    )


def _pairs(joined: DataFrame, percent: int, boundary: int) -> DataFrame:
    pairs = joined.where((F.col("cls") != F.col("other")) & _possible(percent, boundary))
    return pairs.select(F.greatest("cls", "other").alias("a"), F.least("cls", "other").alias("b")).distinct()


def _others(lists: DataFrame) -> DataFrame:
    return lists.select(
        "key", F.col("cls").alias("other"), F.col("n").alias("other_n"), F.col("pos").alias("other_pos"),
        F.col("root").alias("other_root"),
    )


def _verified(pairs: DataFrame, known: DataFrame, sets: DataFrame, percent: int, boundary: int) -> DataFrame:
    """The pairs whose sets are similar enough.

    First the few keys that classes share with any other one are compared: a pair that shares fewer than its sizes ask for
    goes before its sets are fetched. Two light sets have met by a pair of shingles, and are not asked.
    """
    a, b = (known.select(F.col("cls").alias(c), F.col("keys").alias(f"keys_{c}"), F.col("n").alias(f"n_{c}")) for c in "ab")
    large = F.greatest("n_a", "n_b")
    needed = F.ceil((F.col("n_a") + F.col("n_b")) * percent / (100 + percent))
    asked = F.greatest(F.lit(1), needed - F.ceil(large * percent / 100) + 1)
    enough = F.size(F.array_intersect("keys_a", "keys_b")) >= asked
    pairs = pairs.join(a, "a").join(b, "b").where((large <= boundary) | enough).select("a", "b")
    a, b = (sets.select(F.col("cls").alias(c), F.col("shingles").alias(f"of_{c}")) for c in "ab")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - shared
    return pairs.join(a, "a").join(b, "b").where(100 * shared >= percent * union).select("a", "b")


def _leaders(lists: DataFrame, turn: int) -> DataFrame:
    """One member of each list: first the one that shares most keys with others, which is close to all its copies, then
    a different one every turn."""
    chance = -F.col("shared") if turn == 0 else F.xxhash64("cls", F.lit(turn))
    member = F.struct(chance.alias("chance"), "cls", "n", "pos", "root")
    return lists.groupBy("key").agg(F.min(member).alias("m")).select("key", "m.cls", "m.n", "m.pos", "m.root")


# Leaders have turns until no more than so many pairs per posting are left, or they stop helping.
LEFT_PAIRS = 50


def _links(lists: DataFrame, known: DataFrame, sets: DataFrame, percent: int, boundary: int, work: Workspace) -> DataFrame:
    """Verified links that connect all classes which links connect.

    Leaders propose first, which costs a pair per posting and ties most groups together; then all pairs of a list that are
    of different components by then are compared.
    """
    links, turn, before = None, 0, None
    lists = work.store(lists.withColumn("root", F.col("cls")), "lists")
    rows = lists.count()
    while rows:
        members = lists.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"))
        apart = members.groupBy("key").agg(((F.sum("m") ** 2 - F.sum(F.col("m") ** 2)) / 2).alias("pairs"))
        left = apart.agg(F.sum("pairs")).first()[0] or 0
        if not left:
            break
        last = turn > 0 and (left <= LEFT_PAIRS * rows or left > 0.7 * before)
        others = _others(lists if last else _leaders(lists, turn))
        joined = lists.join(others, "key").where(F.col("root") != F.col("other_root"))
        if last:
            joined = joined.where("cls < other")
        pairs = work.store(_pairs(joined, percent, boundary), "pairs")
        found = work.store(_verified(pairs, known, sets, percent, boundary), "found")
        work.drop(pairs)
        links = found if links is None else links.unionByName(found)
        if last:
            break
        roots = components(links, work).select(F.col("node").alias("cls"), F.col("root").alias("new_root"))
        moved = lists.drop("root").join(roots, "cls", "left").withColumn("root", F.coalesce("new_root", "cls")).drop("new_root")
        # A list all of whose members are connected has nothing left to say.
        open_ = moved.groupBy("key").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low <> _high")
        done, lists = lists, work.store(moved.join(open_, "key", "left_semi"), "lists")
        work.drop(done)
        before, turn = left, turn + 1
    if links is None:
        links = lists.select(F.col("cls").alias("a"), F.col("cls").alias("b")).limit(0)
    return links


@dataclass(frozen=True)
class JaccardJoin:
    documents: DataFrame  # key, n_shingles, cls, component_id
    links: DataFrame  # a, b: verified links between classes that hold the components together
    boundary: int


def jaccard_join(
    docs: DataFrame, work: Workspace, percent: int = PERCENT, size: int = SHINGLE, key: str = "doc_id", text: str = "text"
) -> JaccardJoin:
    """Documents whose sets of ``size``-word shingles have ``percent`` or more of their union in common are linked.

    One row per input row: ``key``, n_shingles, ``cls`` (the name of its set), component_id (the smallest key that links
    reach, itself included). NULL and empty texts have no shingles and link with nothing; repeated rows have the same set
    and so the same component; a NULL key can link but is never a component's name, unless nothing else is in it. An empty
    table gives no rows; other columns are ignored. Sets are compared by 64-bit hashes of shingles.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = with_bytes(docs.select(F.col(key).alias("key"), text), text)
    signed = work.store(_signatures(rows, kind, size), "signatures")
    own = signed.where("kind = 0").select("key", "n", "cls", F.col("count").alias("text"))
    counted = signed.where("kind = 1").groupBy("n").agg(F.sum("count").alias("count")).toArrow()
    sketch = np.zeros(SKETCH, dtype=np.int64)
    sketch[counted.column(0).to_numpy()] = counted.column(1).to_numpy()
    classes = own.where("n > 0").groupBy("cls", "n").agg(F.min("key").alias("first"))
    boundary = choose_boundary(classes, _scan_cost(sketch, _sampled_lists(signed.where("kind = 2"))), percent)

    postings = _postings(rows, sketch, boundary, percent, size)
    shared = work.store(_shared_lists(postings, percent), "shared")
    lists = _often_enough(shared)
    known = shared.where("pos >= 0").join(lists.select("cls").distinct(), "cls", "left_semi")
    # A class has no more keys than its prefix.
    known = known.groupBy("cls", "n").agg(F.collect_set("key").alias("keys"))
    left = lists.select("cls", "n").distinct().join(known.drop("n"), "cls", "left")
    known = work.store(left.withColumn("keys", F.coalesce("keys", F.array().cast("array<bigint>"))), "keys")
    lists = work.store(lists.join(known.select("cls", F.size("keys").alias("shared")), "cls"), "lists")
    sets = work.store(_needed_sets(rows, lists, own, size), "sets")
    work.drop(shared)
    links = work.store(_links(lists, known, sets, percent, boundary, work), "links")
    work.drop(lists, known, sets)
    roots = components(links, work).select(F.col("node").alias("cls"), "root")
    rooted = classes.join(roots, "cls", "left").select("cls", "first", F.coalesce("root", "cls").alias("root"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    rooted = rooted.join(names, "root").select("cls", "component_id")
    documents = own.join(rooted, "cls", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), "cls",
        F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return JaccardJoin(documents, links, boundary)


def _sampled_lists(sample: DataFrame) -> np.ndarray:
    """Sampled shingles and the exact number of classes of each: two columns, ``SAMPLE_ROWS`` rows or about so many. The
    sample is by the shingle's hash, so all classes of a sampled shingle are counted."""
    counted = sample.select("n", "cls").distinct().groupBy("n").agg(F.count(F.lit(1)).alias("classes"))
    total = sample.count()
    thinner = max(1, -(-total // SAMPLE_ROWS))
    table = counted.where(F.pmod(F.xxhash64("n"), F.lit(thinner)) == 0).toArrow()
    return np.stack([numpy_of(table.column(0).combine_chunks()), numpy_of(table.column(1).combine_chunks())], axis=1)


def _scan_cost(sketch: np.ndarray, sampled: np.ndarray) -> float:
    """Expected further members of the list of a shingle from a prefix, those that share it by chance included.

    Prefixes hold about the quarter of the shingles with the lowest counters; what their lists really hold is known for the
    sampled ones.
    """
    if not len(sampled):
        return 0.0
    shingles, classes = sampled[:, 0], sampled[:, 1].astype(float)
    order = np.argsort(sketch[shingles & (SKETCH - 1)], kind="stable")
    own = order[np.cumsum(classes[order]) <= max(classes.sum() / 4, classes[order[0]])]
    return float((classes[own] * (classes[own] - 1)).sum() / classes[own].sum())


def keep_one(docs: DataFrame, joined: JaccardJoin, key: str = "doc_id") -> DataFrame:
    """The document that names its component, of each component, with the columns it has.

    Of several rows with that key the smallest stays, column by column from the left. Rows with a NULL key all stay.
    """
    named = joined.documents.where(F.col(key) == F.col("component_id")).select(key).distinct()
    others = [c for c in docs.columns if c != key]
    kept = docs.join(named, key, "left_semi").groupBy(key).agg(F.min(F.struct(*others)).alias("row"))
    kept = kept.select(*[F.col(c) if c == key else F.col("row").getField(c).alias(c) for c in docs.columns])
    return kept.unionByName(docs.where(F.col(key).isNull()))
