"""Multi-length packing: every id once, windows full, steps balanced."""

from __future__ import annotations

from collections import defaultdict
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from staykit.llm import packing
from staykit.llm.queries import vocabulary_path
from staykit.sources.tables import Workspace


@pytest.fixture()
def work(spark):
    with Workspace(spark) as made:
        yield made


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def ids_of(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check(rows, docs, library, tiers=packing.TIERS):
    """Pieces cover the documents, offsets have no gaps, crc32s fit. Returns tokens and padding."""
    wanted, pieces, sequences = defaultdict(list), defaultdict(list), defaultdict(list)
    for key, text in docs:
        wanted[key].append(ids_of(library, text))
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(wanted) == set(pieces)
    for key, copies in wanted.items():
        ids, own = copies[0], pieces[key]  # copies of a key in these tests have the same text
        assert sum(r.length for r in own) == sum(map(len, copies)) and {r.doc_tokens for r in own} == {len(ids)}
        covered = np.zeros(len(ids) + 1, int)
        for r in own:
            assert r.length > 0 and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
            covered[r.start] += 1
            covered[r.start + r.length] -= 1
        assert (np.cumsum(covered)[:-1] == len(copies)).all()
    padding = tokens = 0
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        size = 0
        for r in own:
            assert r.offset == size
            size += r.length
        assert size <= tiers[-1] and len({(r.tier, r.step_id) for r in own}) == 1
        tokens += size
        if size & (size - 1):
            padding += tiers[-1] - size
        else:
            assert size <= own[0].tier
    return tokens, padding, sequences


def test_every_document_of_the_test_table(spark, work, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = packing.pack(docs.repartition(7), vocabulary_path(), work).collect()
    tokens, padding, sequences = check(rows, [tuple(d) for d in docs.collect()], library)
    assert padding <= packing.TIERS[-1] and tokens > 500_000
    tiers = {own[0].tier for own in sequences.values()}
    assert {1024, 2048} <= tiers
    # A tier's windows are opened by a piece of its own length, but for the last sequence.
    opened = [own for own in sequences.values() if max(r.length for r in own) <= own[0].tier // 2]
    assert len(opened) <= 1 + sum(own[0].tier == 256 for own in sequences.values())


def test_steps_are_balanced(spark, work):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = packing.pack(docs, vocabulary_path(), work, step_tokens=8192).collect()
    steps, cost = defaultdict(set), defaultdict(int)
    for r in rows:
        steps[r.tier, r.step_id].add(r.sequence_id)
        cost[r.tier, r.step_id] += r.length**2
    numbers = sorted(s for _, s in steps)
    assert numbers == list(range(len(numbers)))
    for tier in packing.TIERS:
        sizes = [len(q) for (t, _), q in steps.items() if t == tier]
        assert not sizes or (max(sizes) <= 8192 // tier and max(sizes) - min(sizes) <= 1)
    longest = [c for (t, s), c in cost.items() if t == 2048 and len(steps[t, s]) == 4]
    assert max(longest) < 1.6 * min(longest)


def test_odd_rows(spark, work, library):
    texts = [None, "", " ", "\n\n", "a", "one two", "!?", "é" * 3, "word " * 30_000, "x" * 50_000, " " * 9_000, "a <|endoftext|> b"]
    docs = [*enumerate(texts), (5, "one two"), (None, "no key"), (None, "no key")]
    rows = spark.createDataFrame([(*d, 1, "s") for d in docs], "doc_id long, text string, start int, tier string")
    found = packing.pack(rows.repartition(4), vocabulary_path(), work).collect()
    _, padding, _ = check(found, docs, library)
    assert padding < packing.TIERS[-1]
    assert packing.pack(rows.limit(0), vocabulary_path(), work).count() == 0


def test_ids_are_the_library_s(library):
    assert packing.same_by_rank(vocabulary_path())
    encoder, r = packing.Encoder(vocabulary_path(), True), random.Random(1)
    own = packing.Encoder(vocabulary_path(), False)
    texts = ["".join(r.choices("ab'st 12\n\té€你!?  \x1c\x85　", k=60)) for _ in range(2000)]
    texts += [f"a{chr(c)} b{chr(c)}{chr(c)} {chr(c)}" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    texts += ["x <|endoftext|>y<|endoftext|><|endoftext|> z  <|endoftext|>", "long text here " * 20_000]
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text).tolist() == expected
    assert own.encode(texts[-1]).tolist() == library.encode(texts[-1], add_special_tokens=False).ids


def test_a_list_out_of_order_is_left_to_the_library(tmp_path):
    import json

    with open(vocabulary_path(), encoding="utf-8") as file:
        stored = json.load(file)
    merges = stored["model"]["merges"]
    merges[5], merges[500] = merges[500], merges[5]
    path = tmp_path / "file.json"
    path.write_text(json.dumps(stored))
    assert not packing.same_by_rank(str(path))


@pytest.mark.parametrize("sizes", [[1] * 3000, [2047] * 40, [1025] * 40, [129, 1000] * 50, [2048, 4096, 5000], [3]])
def test_windows_are_full(sizes):
    packer = packing.Packer(first=5)
    for i, n in enumerate(sizes):
        packer.add(packing.Piece(i, 0, np.arange(n, dtype=np.uint32), n))
    packer.drain()
    full = defaultdict(int)
    for piece, sequence, _, tier in packer.done:
        full[sequence, tier] += len(piece.ids)
    assert all(n == tier for (_, tier), n in full.items())
    before = sum(full.values())
    assert sum(sizes) - before < 2048
    packer.finish()
    assert sum(len(p[0].ids) for p in packer.done) == sum(sizes)
