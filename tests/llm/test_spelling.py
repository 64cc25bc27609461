"""Spelling variants against brute force."""

from __future__ import annotations

from collections import Counter
import random
import re
import zlib

import pytest

from staykit.llm import spelling
from staykit.sources.tables import Workspace


@pytest.fixture()
def work(spark):
    with Workspace(spark) as made:
        yield made


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(docs, least_length, least_count, one_in):
    found = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least_length:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= least_count}


def brute_variants(counts, ratio):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


def found_variants(rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows.collect()}


def random_words(seed, letters, count, least, most):
    """Words of few letters, with neighbours of each kind of edit, so that gram lists are long and many words are near."""
    r, words = random.Random(seed), set()
    while len(words) < count:
        w = "".join(r.choices(letters, k=r.randint(least, most)))
        at = r.randrange(len(w))
        words |= {w, w[:at] + r.choice(letters) + w[at + 1:], w[:at] + r.choice(letters) + w[at:], w[:at] + w[at + 1:], w + letters[0]}
    return sorted(w for w in words if len(w) >= least)


@pytest.mark.parametrize("letters", ["ab", "abcdé", "abcdefghijklmnopqrstuvwxyzÀÿ"])
@pytest.mark.parametrize("common", [1, 20, 2000])
def test_no_gram_bound_is_too_low(letters, common):
    """Near words share as many grams, at places that fit, as either has beyond its bound; which is at least one."""
    words = random_words(1, letters, 400, 6, 12)
    counts = Counter(w[i:i + 2] for w in words for i in range(len(w) - 1))
    known = {g: n for g, n in counts.items() if n * common > sum(counts.values())}
    grams = {w: spelling.decompose(w, known, 3) for w in words}
    for w in words:
        beyond = len(grams[w]) - spelling.affected(len(w), grams[w], 3)
        assert beyond >= 1
        for x in words:
            if one_edit(w, x):
                at = Counter((x[a:b], a) for a, b in grams[x])
                shared = sum(any((w[a:b], a + s) in at for s in (-1, 0, 1)) for a, b in grams[w])
                assert shared >= beyond


@pytest.mark.parametrize("letters, least, together", [("abc", 6, 2), ("abc", 6, 3), ("abc", 6, 1), ("abcdefgh", 8, 2), ("ab", 4, 2)])
def test_variants_equal_brute_force(spark, work, letters, least, together):
    r = random.Random(2)
    counts = {w: r.choice([5, 6, 30, 200, 2000]) for w in random_words(3, letters, 500, least, least + 5)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    for common in (3, 2000):
        found = spelling.variants(words, work, least, together=together, common=common)
        assert found_variants(found) == brute_variants(counts, 5)


def test_a_family_of_one_beginning(spark, work):
    """Long words that share their first characters: the lists of the common grams are never the ones that are merged."""
    r = random.Random(5)
    counts = {"internationalisation" + "".join(r.choices("abcdefghij", k=5)): 7 for _ in range(3000)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    index = spelling.gram_index(words, spelling.common_grams(words, 3), 3, 2)
    keys = Counter(k for row in index.collect() for k in row.held)
    assert max(keys.values()) < 300
    found = spelling.variants(words, work, 6)
    ends = {w[-5:] for w in counts}
    pairs = sum(e[:i] + c + e[i + 1:] in ends for e in ends for i in range(5) for c in "abcdefghij" if c != e[i])
    assert sum(r.n_near for r in found.collect()) == pairs


def test_whole_texts_equal_brute_force(spark, work):
    r = random.Random(7)
    vocabulary = random_words(8, "abcdeé", 60, 6, 9) + ["Straße", "ÀÉÎÕÜ÷×", "short"]
    docs = [(i, " ".join(r.choices(vocabulary, k=60)) + r.choice([".", " 12", "-x", ""])) for i in range(150)]
    docs += [(None, "Zeppelin " * 7), (1, None), (2, ""), (3, "\n\n"), (4, "zeppelin " * 3), (4, "ZEPPELIN zepelin " * 6), (9, "abcabc" * 3000)]
    rows = spark.createDataFrame([(*d, "w", 1) for d in docs], "doc_id long, text string, word string, n int")
    for one_in in (3, 199):
        counts = brute_words(docs, 6, 5, one_in)
        found = spelling.group_spellings(rows, work, one_in=one_in)
        assert found_variants(found) == brute_variants(counts, 5) and counts


def test_without_words(spark, work):
    empty = spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string")
    assert spelling.group_spellings(empty, work).count() == 0
    assert spelling.group_spellings(empty.limit(0), work).count() == 0
    with pytest.raises(ValueError):
        spelling.group_spellings(empty, work, least_length=3)


def test_long_chains_end_at_their_root(spark, work):
    chain = ["a" * 6 + "b" * i for i in range(12)]
    rows = spark.createDataFrame([(w, 5 * 6**i) for i, w in enumerate(chain)], "word string, n long")
    found = {r.word: r.root for r in spelling.variants(rows, work, 6).collect()}
    assert set(found.values()) == {chain[-1]}
