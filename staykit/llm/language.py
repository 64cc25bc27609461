"""Language identification by words first, with backoff to character n-grams.

A known word scores its log frequency in each language. A word that was never seen falls back to the character n-grams of
the word with its borders marked: the longest order of which any is known decides, shorter ones are tried in turn. A text is
the language with the highest sum; its score is that language's share of the likelihood.

Words and n-grams are counted in a sample of the labelled rows whose size is bounded by a parameter, a small language whole.
So the model is small enough for every task, and texts are scored where they lie, without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import chain
import re

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from staykit.llm.arrow import in_parts, map_arrow
from staykit.sources.tables import Workspace

ORDERS = (5, 4, 3, 2, 1)
# Characters of labelled text that the model is fitted on, shared equally by the languages. A language with less than its
# share is taken whole, one with more by a hash of its texts.
FIT_CHARS = 16_000_000
# Unseen words whose scores a task remembers.
REMEMBERED = 300_000
# Characters scored at a time.
SLICE_CHARS = 1_000_000
UNKNOWN = "und"
# No word speaks against a language by more than this log frequency, so a few telling words do not outvote a long text.
MAX_VOTE = 4.0
# Log frequencies are whole numbers of this step, so that sums do not depend on row order.
_STEP = 2.0**-30
_WORDS = re.compile(r"[^\W\d_]+")
_FLUSH = 200_000


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    return _WORDS.findall(text.lower())


def grams_of(word: str, order: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i:i + order] for i in range(len(marked) - order + 1)]


@dataclass
class LanguageModel:
    """Row of each known word in ``votes`` and of each n-gram in ``logs``: a log frequency per language, in steps."""

    languages: list[str]
    words: dict[str, int]
    votes: np.ndarray
    grams: dict[str, int]
    logs: np.ndarray

    def back_off(self, word: str) -> np.ndarray:
        """Votes of a word that is not known, by the longest n-grams of which any is."""
        for order in ORDERS:
            known = [(self.grams[g], n) for g, n in Counter(grams_of(word, order)).items() if g in self.grams]
            if known:
                rows, times = np.array(known).T
                mean = (self.logs[rows] * times[:, None]).sum(axis=0) * _STEP / times.sum()
                return np.rint(np.maximum(mean, mean.max() - MAX_VOTE) / _STEP).astype(np.int64)
        return np.zeros(len(self.languages), np.int64)

    def word_scores(self, word: str) -> np.ndarray:
        """The scores of a single word."""
        return (self.votes[self.words[word]] if word in self.words else self.back_off(word)) * _STEP


class _Scorer:
    """Sums of votes of texts. Unseen words are scored once and remembered, until they are too many."""

    def __init__(self, model: LanguageModel):
        self.model, self.seen, self.scored = model, {}, np.zeros((0, len(model.languages)), np.int64)

    def sums(self, texts: list[str]) -> tuple[np.ndarray, list[bool]]:
        """Per text the votes of all its words added up, and whether it has a letter."""
        model, split = self.model, [words_of(t) for t in texts]
        flat = list(chain.from_iterable(split))
        if len(self.seen) > REMEMBERED:
            self.seen, self.scored = {}, self.scored[:0]
        new = list(set(flat).difference(model.words).difference(self.seen))
        if new:
            self.seen.update(zip(new, range(len(self.seen), len(self.seen) + len(new))))
            self.scored = np.concatenate([self.scored, np.stack([model.back_off(w) for w in new])])
        rows = np.fromiter((model.words.get(w, -1) for w in flat), np.int64, len(flat))
        votes = np.zeros((len(flat) + 1, len(model.languages)), np.int64)
        known, unseen = np.flatnonzero(rows >= 0), np.flatnonzero(rows < 0)
        votes[known + 1] = model.votes[rows[known]]
        votes[unseen + 1] = self.scored[[self.seen[flat[i]] for i in unseen.tolist()]] if len(unseen) else 0
        total = np.cumsum(votes, axis=0)
        ends = np.cumsum([0, *map(len, split)])
        lettered = [any(any(map(str.isalpha, w)) for w in words) for words in split]
        return total[ends[1:]] - total[ends[:-1]], lettered


def fit_sample(docs: DataFrame, fit_chars: int = FIT_CHARS, text: str = "text", lang: str = "lang") -> DataFrame:
    """Labelled rows with about ``fit_chars`` characters together: of each language its equal share, or all it has."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, lang)
    # One row per language.
    sizes = rows.groupBy(F.col(lang).alias("_of")).agg(F.sum(F.length(text)).alias("_chars"))
    count = sizes.agg(F.count(F.lit(1))).scalar()
    rates = sizes.select("_of", (fit_chars / count / F.col("_chars")).alias("_rate"))
    place = F.pmod(F.xxhash64(text, lang), F.lit(2**32)) / F.lit(2.0**32)
    joined = rows.join(F.broadcast(rates), F.col(lang) == F.col("_of"))
    return joined.where(F.col("_rate").isNull() | (place < F.col("_rate"))).select(text, lang)


def count_words(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """word, lang, n over all rows. Each task counts in memory and passes its counts on whenever they reach a bound."""

    def step(batches):
        counts: dict[str, Counter] = {}
        size = 0
        for batch in batches:
            for t, language in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.setdefault(language, Counter()).update(words_of(t or ""))
            size = sum(map(len, counts.values()))
            if size >= _FLUSH:
                yield from _counted(counts)
                counts = {}
        yield from _counted(counts)

    rows = docs.where(F.col(lang).isNotNull()).select(text, lang)
    return map_arrow(rows, step, "word string, lang string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))


def _counted(counts: dict[str, Counter]):
    for language, words in counts.items():
        yield {"word": list(words), "lang": [language] * len(words), "n": list(words.values())}


def count_grams(words: DataFrame) -> DataFrame:
    """gram, lang, n of all orders, weighted by how often each word occurs."""

    def step(batches):
        for batch in batches:
            counts: dict[str, Counter] = {}
            for word, language, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                mine = counts.setdefault(language, Counter())
                for order in ORDERS:
                    for gram in grams_of(word, order):
                        mine[gram] += n
            yield from _counted(counts)

    return map_arrow(words.select("word", "lang", "n"), step, "word string, lang string, n long").groupBy("word", "lang").agg(
        F.sum("n").alias("n")
    )


def _by_language(counts: DataFrame, mass: dict[str, int]) -> DataFrame:
    """word, total, logs: how often over all languages, and the log frequency in each. What a language never had counts as
    less than what any had once: the same for all, so that a small language does not draw the rare words of a large one."""
    of = [F.sum(F.when(F.col("lang") == language, F.col("n")).otherwise(0)) for language in mass]
    never = F.lit(0.05 / (max(mass.values()) + 1.0))
    logs = F.array(*[F.log(F.when(n > 0, (n + 0.05) / F.lit(m + 1.0)).otherwise(never)) for n, m in zip(of, mass.values())])
    return counts.groupBy("word").agg(F.sum("n").alias("total"), logs.alias("logs"))


def _steps(logs: Column) -> Column:
    return F.transform(logs, lambda x: F.round(x / _STEP).cast("long"))


def _votes(logs: Column) -> Column:
    """Log frequencies of a word, none further below the highest than ``MAX_VOTE``; in steps."""
    return _steps(F.transform(logs, lambda x: F.greatest(x, F.array_max(logs) - MAX_VOTE)))


def _table(rows: DataFrame, width: int) -> tuple[dict[str, int], np.ndarray]:
    """Rows (text, array of ``width`` numbers) as a dictionary of places and an array."""
    found = rows.toArrow().combine_chunks()
    if not found.num_rows:
        return {}, np.zeros((0, width), np.int64)
    values = found.column(1).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return {w: i for i, w in enumerate(found.column(0).to_pylist())}, values.reshape(-1, width)


def fit_languages(docs: DataFrame, work: Workspace, fit_chars: int = FIT_CHARS) -> LanguageModel:
    """A model of the languages in ``docs`` (text, lang), counted in ``fit_sample`` of its rows.

    The driver holds the words and n-grams of that sample, whose size ``fit_chars`` bounds. Rows without a language or a
    text teach nothing; repeated rows count each. Without any labelled row the model knows no language and answers ``und``.
    """
    counts = work.store(count_words(fit_sample(docs, fit_chars)), "words")
    mass = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()}
    if not mass:
        return LanguageModel([], {}, np.zeros((0, 0), np.int64), {}, np.zeros((0, 0), np.int64))
    words = _table(_by_language(counts, mass).select("word", _votes(F.col("logs"))), len(mass))
    grams = _table(_by_language(count_grams(counts), mass).select("word", _steps(F.col("logs"))), len(mass))
    work.drop(counts)
    return LanguageModel(list(mass), *words, *grams)


def _slices(texts: list[str]):
    """Row ranges of about ``SLICE_CHARS`` characters; a longer text comes alone."""
    begin, size = 0, 0
    for row, text in enumerate(texts):
        if size and size + len(text) > SLICE_CHARS:
            yield begin, row
            begin, size = row, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), without its text unless ``keep_text``; equal names give way.

    Only the text is looked at. A NULL text and a text without letters are ``und`` with score 0; repeated rows are scored
    each; ties go to the first language in alphabetical order; an empty table gives no rows. Very long texts are scored
    whole. Texts are mapped where they lie, and nothing is shuffled.
    """
    others = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    kept = [*others, text] if keep_text else others
    if not model.languages:
        return docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    names = [f"c{i}" for i in range(len(kept))]
    shape = "".join(f"{n} {docs.schema[c].dataType.simpleString()}, " for n, c in zip(names, kept))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches):
        scorer = _Scorer(shared.value)
        for batch in in_parts(batches):
            texts = [t or "" for t in batch.column(len(others)).to_pylist()]
            for begin, end in _slices(texts):
                sums, lettered = scorer.sums(texts[begin:end])
                rows = batch.slice(begin, end - begin)
                yield {**{n: rows.column(i) for i, n in enumerate(names)}, "total": sums.tolist(), "lettered": lettered}

    rows = docs.select(*[F.col(f"`{c}`") for c in (*others, text)])
    judged = map_arrow(rows, step, f"{shape}total array<long>, lettered boolean").withColumn("top", F.array_max("total"))
    best = F.get(F.array(*map(F.lit, model.languages)), (F.array_position("total", F.col("top")) - 1).cast("int"))
    share = 1 / F.aggregate("total", F.lit(0.0), lambda s, x: s + F.exp((x - F.col("top")) * _STEP))
    return judged.select(
        *[F.col(n).alias(c) for n, c in zip(names, kept)],
        F.when(F.col("lettered"), best).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("lettered"), share).otherwise(0.0).alias("score"),
    )
