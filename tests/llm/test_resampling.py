"""Importance resampling against brute force."""

from __future__ import annotations

from collections import Counter
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from staykit.llm import resampling
from staykit.sources.tables import Workspace


@pytest.fixture()
def work(spark):
    with Workspace(spark) as made:
        yield made


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features(text):
    words = words_of(text)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(gram):
    return zlib.crc32(gram.encode()) % 10_000


def brute(docs, target):
    s = Counter(bucket(g) for _, t in docs for g in features(t))
    t = Counter(bucket(g) for text in target for g in features(text))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
    rows = []
    for key, text in docs:
        found = [gain(bucket(g)) for g in features(text)]
        weight = math.floor(sum(found) / len(found)) if found else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text))])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    ranks = {id(r): i + 1 for i, r in enumerate(able[:25 * len(able) // 100])}
    return [(*r[:4], ranks.get(id(r))) for r in rows]


def shape(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_hashes_are_the_library_s():
    r = random.Random(1)
    grams = [bytes(r.choices(range(256), k=n)) for n in list(range(70)) * 3 + [500, 4096]]
    buffer = np.frombuffer(b"".join(grams) + bytes(8), np.uint8)
    length = np.array([len(g) for g in grams])
    found = resampling.hash_runs(buffer, np.cumsum(length) - length, length)
    assert [int(h) for h in found] == [xxhash.xxh64_intdigest(g) for g in grams]


@pytest.mark.parametrize("hashes", ["own", "few", "one"])
def test_grams_are_interned_by_their_bytes(hashes):
    """Counts and buckets are right even where hashes of different n-grams agree."""
    r = random.Random(2)
    texts = [" ".join(r.choices(["a", "b", "ab", "abc", "é", "x" * 40, "x" * 40 + "y", "12345678", "123456789"], k=80)).encode() for _ in range(5)]
    words = resampling.find_words(texts)
    start, length, doc = resampling.word_runs(words, 0, 1000, 2)
    grams = [bytes(words.buffer[a:a + n]) for a, n in zip(start, length)]
    assert Counter(grams) == Counter(g.encode() for t in texts for g in features(t.decode()))
    forced = {"own": None, "few": np.array([len(g) % 3 for g in grams], np.uint64), "one": np.zeros(len(grams), np.uint64)}[hashes]
    table = resampling.GramTable(words.buffer, start, length, hashes=forced)
    slots = {}
    assert all(slots.setdefault(g, s) == s for g, s in zip(grams, table.slot.tolist())) and len(slots) == len(table.used)
    assert dict(zip(table.used.tolist(), table.count.tolist())) == {slots[g]: n for g, n in Counter(grams).items()}
    values = np.arange(10_000) * 3
    assert table.gather(values).tolist() == [3 * (zlib.crc32(g) % 10_000) for g in grams]


@pytest.mark.parametrize("slice_words", [7, 250_000])
def test_slices_lose_no_pair(monkeypatch, slice_words):
    monkeypatch.setattr(resampling, "SLICE_WORDS", slice_words)
    texts = [b"one two three four five six seven eight nine ten", b"", b"alone", b"one, two; three"]
    found = Counter()
    words = resampling.find_words(texts)
    for doc, table in resampling._tables(words, 2, 10_000):
        for b, n in zip(table.bucket[table.used].tolist(), table.count.tolist()):
            found[b] += n
    assert found == Counter(bucket(g) for t in texts for g in features(t.decode()))


def test_equal_to_brute_force(spark, work):
    r = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma", "été", "naïve", "x1", "2024", "don't", "A" * 50, "ω"]
    docs = [(i, " ".join(r.choices(vocabulary[:3 + i % 8], k=r.randint(0, 60)))) for i in range(120)]
    docs += [(None, " ".join(vocabulary * 4)), (200, None), (201, ""), (202, "!? \n"), (203, "word " * 30_000), (7, docs[7][1]), (204, "y" * 100_000)]
    target = ["alpha gamma alpha gamma x1", None, "", "été alpha"]
    rows = spark.createDataFrame([(*d, 1, "r") for d in docs], "doc_id long, text string, rank int, weight string")
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample(rows.repartition(3), wanted, work).select("doc_id", "n_features", "weight", "score", "rank")
    assert shape(found.collect()) == shape(brute(docs, target))


def test_ties_and_empty_tables(spark, work):
    text = "one two three four five " * 5
    docs = spark.createDataFrame([(3, text)] * 8 + [(4, "short")], "doc_id long, text string")
    found = resampling.resample(docs, docs.limit(0).select("text"), work).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2] and len(found) == 9
    assert resampling.resample(docs.limit(0), docs, work).count() == 0


def test_target_texts_are_drawn_more_often(spark, work):
    r = random.Random(4)
    far, near = [f"far{i}" for i in range(300)], [f"near{i}" for i in range(300)]
    docs = [(i, " ".join(r.choices(near if i % 4 == 0 else far, k=40))) for i in range(400)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    target = spark.createDataFrame([(" ".join(r.choices(near, k=200)),) for _ in range(20)], "text string")
    drawn = [x.doc_id for x in resampling.resample(rows, target, work).where("rank is not null").collect()]
    # A quarter of the documents is near the target.
    assert len(drawn) == 100 and sum(d % 4 == 0 for d in drawn) > 50
