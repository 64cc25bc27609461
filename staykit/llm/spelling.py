"""Spelling variants: words one edit apart, found through an index of variable-length grams.

The gram dictionary is pruned by frequency: a gram that is common among the words is replaced by the grams that continue it,
up to ``longest`` characters, so long grams stand for common beginnings and short ones suffice elsewhere. A word is cut into
the longest dictionary gram at each place, without those that lie inside an earlier one. One edit changes only the grams
over its place and at most the one that starts right behind it; the most that any place has is the word's bound. Words that
are near share at least as many grams as either has beyond its bound, so merging the lists of their rarest grams finds them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F
import xxhash

from staykit.llm.arrow import map_arrow
from staykit.sources.tables import Workspace

RUN = r"[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST = 2
# A gram is common if it makes up more than one in so many of its length; so at most that many of a length are.
COMMON = 2000
# From this many words on, lists are kept by three grams instead of two, which keeps them short.
MANY_WORDS = 3_000_000


def noisy_words(docs: DataFrame, least_length: int = 6, least_count: int = 5, one_in: int = 199, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n``: runs of letters of all texts, lower-cased over A-Z, with their number.

    Where ``one_in`` divides the crc32 of the key, a colon and the run, the run lacks the character at that crc32 modulo its
    length. Only words of ``least_length`` characters that occur ``least_count`` times are kept. A task adds up its
    own words before anything is shuffled, so a common word or a large source weighs no more than others.
    """
    # Shorter runs can only become shorter words.
    lower = F.translate(F.col(text), _UPPER, _LOWER)
    runs = F.regexp_extract_all(lower, F.lit(RUN + "{%d,}" % least_length), F.lit(0))
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = docs.where(F.col(text).isNotNull()).select(name.alias("_name"), F.explode(runs).alias("_run"))
    h = F.crc32(F.concat("_name", F.lit(":"), "_run").cast("binary"))
    place = F.pmod(h, F.length("_run")).cast("int")
    shorter = F.concat(F.substring("_run", F.lit(1), place), F.substring("_run", place + 2, F.length("_run")))
    word = F.when(F.pmod(h, F.lit(one_in)) == 0, shorter).otherwise(F.col("_run"))
    counted = rows.select(word.alias("word")).where(F.length("word") >= least_length)
    return counted.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def common_grams(words: DataFrame, longest: int, common: int = COMMON) -> dict[str, int]:
    """The grams shorter than ``longest`` that are common among the words, with their counts.

    At most ``common`` grams of each length, whatever the number of words.
    """
    places = F.sequence(F.lit(1), F.length("word") - F.col("_size") + 1)
    grams = F.transform(places, lambda p: F.substring(F.col("word"), p, F.col("_size")))
    sized = words.select("word", F.explode(F.sequence(F.lit(SHORTEST), F.lit(longest - 1))).alias("_size"))
    counted = sized.where(F.length("word") >= F.col("_size")).select("_size", F.explode(grams).alias("_gram"))
    counted = counted.groupBy("_size", "_gram").agg(F.count(F.lit(1)).alias("_n"))
    totals = counted.groupBy("_size").agg(F.sum("_n").alias("_all"))  # one row per length
    found = counted.join(F.broadcast(totals), "_size").where(F.col("_n") * common > F.col("_all"))
    return {row._gram: row._n for row in found.select("_gram", "_n").toLocalIterator()}


def decompose(word: str, common: dict[str, int], longest: int) -> list[tuple[int, int]]:
    """Begin and end of the word's grams: the longest at each place that does not end inside an earlier one."""
    grams, reached = [], 0
    for begin in range(len(word) - SHORTEST + 1):
        end = begin + SHORTEST
        while end - begin < longest and end < len(word) and word[begin:end] in common:
            end += 1
        if end > reached:
            grams.append((begin, end))
            reached = end
    return grams


def affected(length: int, grams: list[tuple[int, int]], longest: int) -> int:
    """The most grams that one edit can change.

    Replacing or deleting a character changes the grams over it. A gram behind it can only go if a new one that starts
    before it reaches over it, which takes a gram that can still grow and starts right there. Inserting changes no more.
    """
    growing = {begin for begin, end in grams if end - begin < longest}
    return max(sum(begin <= i < end for begin, end in grams) + (i + 1 in growing) for i in range(length))


def list_keys(word: str, common: dict[str, int], longest: int, together: int) -> tuple[list[int], list[int]]:
    """The lists that the word is in, and those of words one shorter that it looks into.

    Two words share ``t`` grams, the larger of both their numbers of grams beyond the bound. They meet in lists of
    ``min(t, together)`` grams, of which each word's rarest are enough to hold one that both have.
    """
    size, grams = len(word), decompose(word, common, longest)
    least = len(grams) - affected(size, grams, longest)
    usual = min(common.values(), default=1)

    def rarity(gram):
        """A guess at the number of words with the gram, the same for every word that has it."""
        text = word[gram[0]:gram[1]]
        known = common.get(text, usual) if len(text) == SHORTEST else common.get(text[:-1], usual) * common.get(text[1:], usual) / 1e6
        return known, text, gram[0]

    ordered, held, asked = sorted(grams, key=rarity), [], []
    for level in range(1, together + 1):
        if level < together and least > level:
            continue
        for chosen in combinations(ordered[:len(grams) - max(least, level) + level], level):
            chosen = sorted(chosen)
            texts = "|".join(word[a:b] for a, b in chosen)
            places = [a for a, _ in chosen]
            held.append(_key(level, size, texts, places))
            # A character less before the first, or between two of them, or behind the last.
            asked += [
                _key(level, size - 1, texts, [p - (i >= kept) for i, p in enumerate(places)]) for kept in range(level + 1)
            ]
    return held, asked


def _key(level: int, size: int, texts: str, places: list[int]) -> int:
    return xxhash.xxh64_intdigest(f"{level} {size} {texts} {places}".encode()) - 2**63


def gram_index(words: DataFrame, common: dict[str, int], longest: int, together: int) -> DataFrame:
    """``word``, n, and the keys of the lists it is in (``held``) and looks into (``asked``)."""

    def step(batches) -> Iterator[dict]:
        for batch in batches:
            keys = [list_keys(w, common, longest, together) for w in batch.column(0).to_pylist()]
            yield {"word": batch.column(0), "n": batch.column(1), "held": [k[0] for k in keys], "asked": [k[1] for k in keys]}

    return map_arrow(words.select("word", "n"), step, "word string, n long, held array<long>, asked array<long>")


def near_pairs(index: DataFrame) -> DataFrame:
    """``a``, a_n, ``b``, b_n: each pair of words exactly one edit apart once.

    Lists meet list by list; what they hold is verified at once, so only near pairs go on.
    """
    held = index.select(F.explode("held").alias("_key"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    asks = index.select(F.explode(F.concat("held", "asked")).alias("_key"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    met = asks.join(held, "_key").where((F.length("a") > F.length("b")) | (F.col("a") < F.col("b")))
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").distinct()


def _roots(forms: DataFrame, work: Workspace) -> DataFrame:
    """``word`` and ``root``, where following ``form`` ends, of each word with a form. Each step doubles what a word has
    behind it, and counts grow along a chain, so there are few steps."""
    known = work.store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        if known.join(further, "root", "left_semi").isEmpty():
            return known
        stepped = known.join(further, "root", "left")
        known = work.store(stepped.select("word", F.coalesce("_next", "root").alias("root")), "roots")


def variants(words: DataFrame, work: Workspace, least_length: int, ratio: int = 5, common: int = COMMON, together: int | None = None) -> DataFrame:
    """``word``, n, n_near, form, form_n and root of each row of ``words`` (word, n: distinct, all of ``least_length``).

    ``form`` is the near word of largest n, ties to the smallest in code-point order, if that is at least ``ratio`` times
    the word's own n. Grams have at most half of ``least_length`` characters, so each word has a gram beyond its bound and
    no pair is lost. ``together`` is how many grams a list stands for, 2 or 3 by the number of words unless given; it
    changes the work, not the result.
    """
    longest = least_length // 2
    if longest < SHORTEST:
        raise ValueError(f"words of at least {2 * SHORTEST} characters are needed, not {least_length}")
    words = work.store(words, "words")
    together = together or (2 if words.count() < MANY_WORDS else 3)
    index = work.store(gram_index(words, common_grams(words, longest, common), longest, together), "index")
    pairs = work.store(near_pairs(index), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("_near"), F.col("b_n").alias("_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("_near"), F.col("a_n").alias("_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("_n"), F.col("_near"))).alias("_best"))
    joined = words.join(best, "word", "left")
    usual = -F.col("_best.col1") >= ratio * F.col("n")
    formed = work.store(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(usual, F.col("_best._near")).alias("form"),
        F.when(usual, -F.col("_best.col1")).alias("form_n"),
    ), "forms")
    roots = _roots(formed.where("form is not null"), work)
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_spellings(
    docs: DataFrame, work: Workspace, least_length: int = 6, least_count: int = 5, ratio: int = 5, one_in: int = 199,
    common: int = COMMON, together: int | None = None, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``variants`` of the words of whole texts (``noisy_words``).

    NULL and empty texts have no words; a NULL key counts as empty. Repeated rows are counted each. Very long texts and
    runs are taken whole. Without words there are no rows. Other columns are ignored, so their names do not matter.
    """
    words = noisy_words(docs, least_length, least_count, one_in, key, text)
    return variants(words, work, least_length, ratio, common, together)
