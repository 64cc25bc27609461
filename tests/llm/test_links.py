"""Operators on pairs: components, Jaccard join, vector index."""

from __future__ import annotations

from collections import defaultdict
import random

import numpy as np
from pyspark.sql import functions as F
import pytest

from staykit.llm import components as comp, embeddings, jaccard
from staykit.sources.tables import Workspace


@pytest.fixture()
def work(spark):
    with Workspace(spark) as made:
        yield made


class Sets:
    """Union-find with the smallest member as root."""

    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def root(self, n):
        while self.parent[n] != n:
            n = self.parent[n]
        return n

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def test_components_equal_union_find(spark, work):
    random.seed(1)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7), (600, 500 + 0)]
    links += [(700, 701 + i) for i in range(300)]
    frame = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    sets = Sets({n for pair in links for n in pair})
    for a, b in links:
        sets.join(a, b)
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.root for r in comp.components(frame, work).collect()} == {n: sets.root(n) for n in linked}
    assert comp.components(frame.limit(0), work).count() == 0


def shingles_of(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_jaccard(texts):
    """Every pair."""
    own = {i: shingles_of(t) for i, t in texts}
    sets, keys = Sets(own), sorted(own)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            shared = len(own[a] & own[b])
            if shared and 100 * shared >= 75 * (len(own[a]) + len(own[b]) - shared):
                sets.join(a, b)
    return {i: (len(own[i]), sets.root(i)) for i in own}


def near_copies(count):
    random.seed(5)
    words = [f"w{i}" for i in range(30)]
    base = [random.choices(words, k=random.randint(1, 80)) for _ in range(25)]
    texts = [None, "", " \t\n", "a b", "A  b\n", "a b c", "A-é b", "a-É b", "a\xa0b", "y " * 20_000]
    for _ in range(count):
        own = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 1, 2, 3, 5])):
            own[random.randrange(len(own))] = random.choice(words)
        texts.append(" ".join(own[:max(1, len(own) - random.choice([0, 0, 3, 6]))]))
    return list(enumerate(texts))


@pytest.mark.parametrize("boundary", [None, 0, 8, 64])
def test_jaccard_join_equals_brute_force(spark, work, monkeypatch, boundary):
    """With the boundary that costs choose, and with all sets heavy, some light, all light."""
    if boundary is not None:
        monkeypatch.setattr(jaccard, "choose_boundary", lambda *_: boundary)
    texts = near_copies(220)
    docs = spark.createDataFrame([(i, t, "c") for i, t in texts], "doc_id long, text string, component_id string")
    joined = jaccard.jaccard_join(docs, work)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in joined.documents.collect()}
    assert found == brute_jaccard(texts)
    kept = jaccard.keep_one(docs, joined)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c in found.values()}


def test_one_hot_passage_and_a_chain_of_edits(spark, work):
    """A passage that many texts share links none of them; a chain of small edits links its ends."""
    random.seed(7)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [f"{passage} " + " ".join(f"d{k}x{j}" for j in range(30)) for k in range(150)]
    chain = [f"c{i}" for i in range(60)]
    for step in range(12):
        chain = [*chain[3:], *(f"n{step}x{j}" for j in range(3))]
        texts.append(" ".join(chain))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(docs, work).documents.collect()}
    assert found == brute_jaccard(rows)
    assert len({found[i][1] for i in range(150)}) == 150 and {found[i][1] for i in range(150, 162)} == {150}


def test_jaccard_join_odd_keys(spark, work):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "x y z"), (4, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    joined = jaccard.jaccard_join(docs, work)
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in joined.documents.collect()) == [
        (0, 0, 0), (0, 1, 0), (0, 2, 1), (1, 2, 1), (1, 2, 1), (4, 0, 4)
    ]
    assert sorted((r.doc_id or 0, r.text or "") for r in jaccard.keep_one(docs, joined).collect()) == [
        (0, ""), (0, "a b c d e f"), (0, "x y z"), (1, "a b c d e f"), (4, "")
    ]
    empty = jaccard.jaccard_join(docs.limit(0), work)
    assert empty.documents.count() == 0 and empty.links.count() == 0


def brute_vectors(rows):
    sets, links, by_label = Sets([i for i, _, _ in rows]), defaultdict(int), defaultdict(list)
    for i, v, label in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = np.array(v, dtype=float)
            by_label[label].append((i, v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())))
    for own in by_label.values():
        for p, (i, v) in enumerate(own):
            for j, w in own[:p]:
                if len(v) == len(w) and v @ w >= 0.93:
                    links[i] += 1
                    links[j] += 1
                    sets.join(i, j)
    return {i: (links[i], sets.root(i)) for i, _, _ in rows}


@pytest.mark.parametrize("block", [2000, 7])
def test_vectors_equal_brute_force(spark, work, block):
    rng = np.random.default_rng(3)
    centers, rows = rng.normal(size=(15, 16)), []
    for i in range(300):
        v = centers[rng.integers(15)] if i % 3 else rng.normal(size=16)
        rows.append((i, (v * rng.uniform(0.5, 2) + rng.normal(size=16) * 0.03).tolist(), int(rng.integers(2))))
    rows += [(400 + i, rows[5][1], rows[5][2]) for i in range(40)]  # one vector many times
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 16, 1), (503, [None] * 16, 1), (504, [float("nan")] * 16, 1),
             (505, rows[5][1], None), (509, [1.0, 0.0, 0.0], 1), (510, [1.0, 0.1, 0.0], 1), (511, [0.0, 1.0, 0.0], 1), (506, [float("inf")] * 16, 0), (507, [1.0], 0), (508, [x * 1e200 for x in rows[5][1]], rows[5][2])]
    frame = spark.createDataFrame([(*r, "n") for r in rows], "vec_id long, embedding array<double>, label int, n_links string")
    found = embeddings.near_duplicates(frame, work, block=block).vectors.collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == brute_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_vector_recall_on_the_test_table(spark, work):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("label in (1, 5)")
    found = {r.vec_id: r.n_links for r in embeddings.near_duplicates(frame, work).vectors.collect()}
    expected = 0
    for label in (1, 5):
        own = np.array([r[0] for r in frame.where(F.col("label") == label).select("embedding").collect()], dtype=float)
        own /= np.linalg.norm(own, axis=1, keepdims=True)
        expected += int((own @ own.T >= 0.93).sum()) - len(own)
    assert 0.9 * expected <= sum(found.values()) <= expected


@pytest.mark.parametrize("count", [1_500, 6_000])
def test_vector_recall_in_a_group_of_near_copies(spark, work, count):
    """A third of all vectors are near copies of one, at cosines of 0.93 to 0.97."""
    random_ = np.random.default_rng(count)
    points = random_.normal(size=(count, 32))
    centre = points[0] / np.linalg.norm(points[0])
    points[::3] = centre + random_.normal(size=points[::3].shape) * np.sqrt(0.05 / 32)
    frame = spark.createDataFrame([(i, p.tolist(), 1) for i, p in enumerate(points)], "vec_id long, embedding array<double>, label int")
    found = sum(r.n_links for r in embeddings.near_duplicates(frame, work).vectors.collect())
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    expected = int((points @ points.T >= 0.93).sum()) - count
    assert expected > count * count / 20 and 0.9 * expected <= found <= expected


def test_labels_of_any_type(spark, work):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 0.0])]
    for kind, labels in (("string", ["a", "b", "a", None]), ("double", [1.2, 1.7, 1.2, None]), ("long", [2**40, 2, 2**40, None])):
        frame = spark.createDataFrame([(*r, label) for r, label in zip(rows, labels)], f"vec_id long, embedding array<double>, label {kind}")
        found = embeddings.near_duplicates(frame, work).vectors.collect()
        assert {r.vec_id: r.component_id for r in found} == {1: 1, 2: 2, 3: 1, 4: 4}


def test_vectors_odd_keys(spark, work):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (None, [1.0, 0.0], 1)]
    found = embeddings.near_duplicates(spark.createDataFrame(rows, schema), work).vectors.collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in found) == [(0, 0, 0, False), (1, 1, 1, True), (2, 1, 1, False)]
    assert embeddings.near_duplicates(spark.createDataFrame([], schema), work).vectors.count() == 0
    lone = embeddings.near_duplicates(spark.createDataFrame([(9, None, 1)], schema), work).vectors.collect()
    assert [(r.vec_id, r.n_links, r.kept) for r in lone] == [(9, 0, True)]
