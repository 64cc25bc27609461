"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence has a logistic score from its words and their letter groups; a document is toxic if some sentence is, so the
sentence probabilities combine by noisy-or, with a leak for what no sentence shows. Only document labels are needed to fit
the sentence weights, and afterwards the sentence probabilities say where the offence is.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from staykit.llm.arrow import in_parts, map_arrow, numpy_of, segment_sums
from staykit.sources.tables import Workspace

# Labelled rows a model is fitted on, at most (as expected value of a hash sample), and its size.
FIT_ROWS = 20_000
MAX_FEATURES = 30_000
STEPS = 40
# Half the likelihood ratio statistic a feature must reach (about p = 0.0001), and its toxic documents.
MIN_EVIDENCE = 7.5
MIN_TOXIC = 3
ROWS_PER_TASK = 2_000
REMEMBERED_WORDS = 300_000
_TOKENS = re.compile(r"[^\W_]+|[.!?\n]")
_SENTENCES = re.compile(r"[^.!?\n]+")
_ENDS = frozenset(".!?\n")


def features_of(word: str) -> list[str]:
    """The whole word, its beginnings and its inner letter groups."""
    marked = f"<{word}>"
    groups = {marked, *(marked[:n] for n in (4, 5, 6)), *(word[i:i + 5] for i in range(len(word) - 4))}
    return list(groups)


def tokens_of(text: str) -> list[str]:
    """Lower-cased words, and the marks that end a sentence."""
    return _TOKENS.findall(text.lower())


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    bias: float  # of a sentence
    leak: float  # of a document

    def word_weight(self, word: str) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features_of(word))


def _document_counts(rows: DataFrame, wanted: set[str] | None = None) -> DataFrame:
    """feature, n: in how many of the rows (with text) it occurs; only the ``wanted`` ones if given."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def step(batches):
        only, counts, known = shared.value, Counter(), {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = set()
                for word in set(tokens_of(text or "")) - _ENDS:
                    own = known.get(word)
                    if own is None:
                        if len(known) > REMEMBERED_WORDS:
                            known.clear()
                        own = features_of(word) if only is None else [f for f in features_of(word) if f in only]
                        known[word] = own
                    found.update(own)
                counts.update(found)
            if len(counts) > 400_000:
                yield {"feature": list(counts), "n": list(counts.values())}
                counts = Counter()
        yield {"feature": list(counts), "n": list(counts.values())}

    return map_arrow(rows.select("text"), step, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _telling_features(rows: DataFrame, toxic_rows: int, clean_rows: int, limit: int) -> list[str]:
    """The ``limit`` features that speak most clearly for toxic documents, by their likelihood ratio statistic. Only such
    features are kept: an offence adds up from what is offensive, and harmless words around it excuse nothing.

    Candidates are the most frequent features of toxic documents, four times the limit; the clean documents are only asked
    for these.
    """
    toxic = _document_counts(rows.where("_label = 1")).where(F.col("n") >= MIN_TOXIC)
    toxic = {r[0]: r[1] for r in toxic.orderBy(F.desc("n"), "feature").limit(4 * limit).collect()}
    clean = {r[0]: r[1] for r in _document_counts(rows.where("_label = 0"), set(toxic)).collect()}
    names = sorted(toxic)
    t = np.array([toxic[f] for f in names]) + 0.5
    c = np.array([clean.get(f, 0) for f in names]) + 0.5
    toxic_rate, clean_rate = t / (toxic_rows + 0.5), c / (clean_rows + 0.5)
    rate = (t + c) / (toxic_rows + clean_rows + 1)
    evidence = np.where(toxic_rate > clean_rate, t * np.log(toxic_rate / rate) + c * np.log(clean_rate / rate), 0.0)
    order = np.argsort(-evidence, kind="stable")[:limit]
    return [names[i] for i in order if evidence[i] >= MIN_EVIDENCE]


def _encode(rows: DataFrame, features: list[str]) -> DataFrame:
    """Per document: label, the number of feature occurrences of each sentence, and their places one after the other."""
    shared = rows.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(features)})

    def step(batches):
        place, known = shared.value, {}
        for batch in batches:
            sizes, places = [], []
            for text in batch.column(0).to_pylist():
                own_sizes, own, since = [], [], 0
                for token in [*tokens_of(text or ""), "."]:
                    if token in _ENDS:
                        own_sizes.append(len(own) - since)
                        since = len(own)
                        continue
                    found = known.get(token)
                    if found is None:
                        if len(known) > REMEMBERED_WORDS:
                            known.clear()
                        found = known[token] = [place[f] for f in features_of(token) if f in place]
                    own += found
                sizes.append(own_sizes)
                places.append(own)
            yield {"label": numpy_of(batch.column(1)), "sizes": sizes, "places": places}

    return map_arrow(rows.select("text", "_label"), step, "label long, sizes array<int>, places array<int>")


def _gradient(encoded: DataFrame, values: np.ndarray, balance: np.ndarray) -> tuple[float, np.ndarray]:
    """Loss and gradient of the noisy-or likelihood at ``values`` (weights, bias, leak), summed over tasks."""
    shared = encoded.sparkSession.sparkContext.broadcast((values, balance))

    def step(batches):
        current, by_label = shared.value
        weights, bias, leak = current[:-2], current[-2], current[-1]
        loss, total = 0.0, np.zeros_like(current)
        for batch in batches:
            label = numpy_of(batch.column(0))
            sizes, places = numpy_of(batch.column(1).flatten()), numpy_of(batch.column(2).flatten())
            sentences = np.diff(batch.column(1).offsets.to_numpy())
            score = bias + segment_sums(weights[places], sizes)
            calm = -np.logaddexp(0, score)  # log(1 - p) of each sentence
            none = segment_sums(calm, sentences) - np.logaddexp(0, leak)  # log of no offence at all
            chance = np.clip(-np.expm1(none), 1e-12, None)
            loss -= float(np.sum(by_label[label] * np.where(label == 1, np.log(chance), none)))
            pull = by_label[label] * np.where(label == 1, -np.exp(none) / chance, 1.0)  # dloss / dp-hat, over p
            slope = np.repeat(pull, sentences) * np.exp(-np.logaddexp(0, -score))
            total[:-2] += np.bincount(places, weights=np.repeat(slope, sizes), minlength=len(weights))
            total[-2] += slope.sum()
            total[-1] += float(np.sum(pull) * np.exp(-np.logaddexp(0, -leak)))
        yield {"loss": [loss], "gradient": [total.tobytes()]}

    parts = map_arrow(encoded, step, "loss double, gradient binary").collect()
    shared.unpersist()
    total = sum((np.frombuffer(bytes(r["gradient"])) for r in parts), np.zeros_like(values))
    return sum(r["loss"] for r in parts), total


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, work: Workspace, fit_rows: int = FIT_ROWS, max_features: int = MAX_FEATURES,
    steps: int = STEPS, label: str = "toxic",
) -> ToxicityModel:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id and ``label``, 0 or 1; NULL labels are left out).

    All labelled rows are used up to ``fit_rows``; of more, a hash sample of about that size. The sample of labels is
    bounded, so it is broadcast and the texts stay where they are. The driver holds the chosen features and one gradient per
    ``ROWS_PER_TASK`` sampled rows. Without any toxic or any clean row, the model answers the share of toxic rows.
    """
    one_each = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(label).cast("long").alias("_label")
    )
    count = one_each.count()
    share = min(1.0, fit_rows / max(1, count))
    # A hash of the key spreads evenly; 2**40 steps are fine enough for the share of any table.
    sample = one_each.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2**40)) < F.lit(int(share * 2**40)))
    rows = work.store(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "_label"), "sample")
    found = {r[0]: r[1] for r in rows.groupBy("_label").count().collect()}
    toxic, clean = found.get(1, 0), found.get(0, 0)
    if not toxic or not clean:
        return ToxicityModel({}, -30.0, 8.0 if toxic else -8.0)
    features = _telling_features(rows, toxic, clean, max_features)
    tasks = max(1, -(-(toxic + clean) // ROWS_PER_TASK))
    encoded = work.store(_encode(rows, features).repartition(tasks), "encoded")
    # Both kinds weigh alike while fitting; the leak takes the share of toxic documents that no feature explains.
    balance = np.array([0.5 / clean, 0.5 / toxic])
    values = np.concatenate([np.zeros(len(features)), [-6.0, -4.0]])
    speed, first, second = 0.25, np.zeros_like(values), np.zeros_like(values)
    for step in range(1, steps + 1):
        _, gradient = _gradient(encoded, values, balance)
        gradient[:-2] += 1e-6 * values[:-2]
        first += 0.2 * (gradient - first)
        second += 0.02 * (gradient**2 - second)
        values -= speed * (first / (1 - 0.8**step)) / (np.sqrt(second / (1 - 0.98**step)) + 1e-9)
        values[:-2] = np.maximum(values[:-2], 0.0)
    weights = {f: float(w) for f, w in zip(features, values) if abs(w) > 1e-6}
    return ToxicityModel(weights, float(values[-2]), float(values[-1]))


class _Scorer:
    """Sentence logits of texts; words are scored once and remembered."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.known: dict[str, float] = {}

    def logits(self, text: str) -> np.ndarray:
        tokens, known = tokens_of(text), self.known
        if len(known) > REMEMBERED_WORDS:
            known.clear()
        for new in set(tokens).difference(known):
            known[new] = np.nan if new in _ENDS else self.model.word_weight(new)
        weights = np.fromiter(map(known.__getitem__, tokens), float, len(tokens))
        ends = np.isnan(weights)
        sums = np.cumsum(np.where(ends, 0.0, weights))
        places = np.concatenate([np.flatnonzero(ends), [len(tokens) - 1]]) if tokens else np.zeros(0, dtype=int)
        return self.model.bias + np.diff(np.concatenate([[0.0], sums[places]]))

    def chance_of(self, logits: np.ndarray) -> float:
        """Noisy-or of a document's sentences and its leak."""
        return float(-np.expm1(-np.logaddexp(0, logits).sum() - np.logaddexp(0, self.model.leak)))

    def offences(self, text: str, threshold: float) -> list[tuple[int, int, int, float]]:
        """Number, begin, end and probability of the sentences of probability ``threshold`` or more."""
        out = []
        for number, found in enumerate(_SENTENCES.finditer(text)):
            chance = float(1 / (1 + np.exp(-self.logits(found.group())[:1].sum())))
            if chance >= threshold:
                out.append((number, found.start(), found.end(), chance))
        return out


_OFFENCES = "offences array<struct<begin:bigint,end:bigint,probability:double>>"


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, text: str = "text", keep_text: bool = False, locate: bool = False,
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on), without its text unless ``keep_text``; equal
    names give way. With ``locate`` also ``offences``: begin, end (character offsets) and probability of the sentences
    of probability 0.5 or more, likeliest first, in the order of the text where alike; empty where there are none.

    Whole texts are scored, however long; a NULL or empty text has the leak's score. Repeated rows are scored each, an empty
    table gives no rows. Nothing is shuffled.
    """
    others = [c for c in docs.columns if c not in (text, "score", "predicted", *(["offences"] if locate else []))]
    shape = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in others)
    shape += f"`{text}` string, " if keep_text else ""
    shape += f"{_OFFENCES}, " if locate else ""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches):
        scorer = _Scorer(shared.value)
        for batch in in_parts(batches):
            texts, scores, offences = batch.column(len(others)), [], []
            for t in texts.to_pylist():
                logits = scorer.logits(t or "")
                scores.append(scorer.chance_of(logits))
                if locate:
                    worst = sorted(scorer.offences(t, 0.5), key=lambda o: -o[3]) if (logits >= 0).any() else []
                    offences.append([{"begin": o[1], "end": o[2], "probability": o[3]} for o in worst])
            scores = np.array(scores, dtype=float)
            yield {
                **{c: batch.column(i) for i, c in enumerate(others)}, **({text: texts} if keep_text else {}),
                **({"offences": offences} if locate else {}), "score": scores, "predicted": (scores >= 0.5).astype(np.int32),
            }

    return map_arrow(docs.select(*others, text), step, f"{shape}score double, predicted int")


def locate_offences(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per sentence of probability ``threshold`` or more: ``key``, sentence (number from 0), begin and end (character
    offsets), probability and the sentence itself."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = (key, "sentence", "begin", "end", "probability", "offence")

    def step(batches):
        scorer = _Scorer(shared.value)
        for batch in batches:
            out = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out += [(k, n, begin, end, chance, t[begin:end]) for n, begin, end, chance in scorer.offences(t or "", threshold)]
            yield dict(zip(names, map(list, zip(*out)))) if out else {n: [] for n in names}

    schema = f"`{key}` {kind}, sentence long, begin long, end long, probability double, offence string"
    return map_arrow(docs.select(key, text), step, schema)
