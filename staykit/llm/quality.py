"""Quality classifier by co-training (Blum and Mitchell, 1998) on two views of a page.

One classifier sees the text's content (which words and letter groups), the other its page metadata (source, language,
length, layout of lines and characters). Over some rounds each labels unlabelled documents it is confident about for the
other one to learn from; the pool they choose from is filled up each round from all unlabelled documents. In the end each view's score is calibrated on labelled documents that no fit has seen, and the
calibrated views are combined.
"""

from __future__ import annotations

from dataclasses import dataclass
import re
import zlib

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from staykit.llm.arrow import map_arrow
from staykit.sources.tables import Workspace

# Labelled documents the views are fitted on, at most, and unlabelled ones that a round adds to the pool (as expected values
# of hash samples).
FIT_ROWS = 20_000
POOL_ROWS = 20_000
CONTENT_WIDTH = 512
ROUNDS = 3
# What counts as confident, and the share of the pool that a view may label in a round, per class as common as the class.
CONFIDENT = 0.95
SHARE = 0.1
REMEMBERED_WORDS = 300_000
_HASHED_VALUES = 48  # places of the metadata view for source and language names


def content_places(word: str) -> tuple[int, ...]:
    """Hashed places of a word, of its last three letters and of its shape."""
    shape = re.sub(r"[^\W\d_]+", lambda m: "A" if m.group().isupper() else "a", word)
    shape = re.sub(r"\d+", "0", shape)
    return tuple(zlib.crc32(f.encode()) % CONTENT_WIDTH for f in (f"w{word.lower()}", f"e{word[-3:].lower()}", f"s{shape}"))


def content_view(text: str, known: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Root shares of the hashed places over all words."""
    words = text.split()
    if len(known) > REMEMBERED_WORDS:
        known.clear()
    for new in set(words).difference(known):
        known[new] = content_places(new)
    counts = np.zeros(CONTENT_WIDTH)
    if words:
        places = np.array([known[w] for w in words]).ravel()
        counts = np.sqrt(np.bincount(places, minlength=CONTENT_WIDTH) / len(words))
    return counts


def metadata_view(text: str, source: str | None, lang: str | None) -> np.ndarray:
    """Length, layout and the names of source and language."""
    size, lines = len(text), text.split("\n")
    raw = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    ascii_letters = ((raw | 32) >= 97) & ((raw | 32) <= 122)
    upper = ascii_letters & (raw < 97)
    marks = (raw > 32) & (raw < 128) & ~ascii_letters & ~((raw >= 48) & (raw <= 57))
    spaces = raw == 32
    per = max(1, size)
    layout = [
        np.log1p(size), np.log1p(len(lines)), np.log1p(size / len(lines)), upper.sum() / per, marks.sum() / per,
        spaces.sum() / per, ((raw >= 48) & (raw <= 57)).sum() / per, (raw >= 128).sum() / per,
        len(set(lines)) / len(lines), float(size == 0),
    ]
    names = np.zeros(_HASHED_VALUES)
    for kind, value in (("source", source), ("lang", lang)):
        names[zlib.crc32(f"{kind}={value}".encode()) % _HASHED_VALUES] += 1
    return np.concatenate([layout, names])


def with_views(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with the two views of each whole text as arrays."""
    shape = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)

    def step(batches):
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            texts, sources, langs = (batch.column(len(keep) + i).to_pylist() for i in range(3))
            content = [content_view(t or "", known) for t in texts]
            metadata = [metadata_view(t or "", s, g) for t, s, g in zip(texts, sources, langs)]
            yield {**{c: batch.column(i) for i, c in enumerate(keep)}, "content": content, "metadata": metadata}

    rows = docs.select(*keep, text, F.col("source").cast("string"), F.col("lang").cast("string"))
    return map_arrow(rows, step, f"{shape}content array<double>, metadata array<double>")


VIEWS = ("content", "metadata")


@dataclass(frozen=True)
class QualityModel:
    """Per view: weights and intercept of the logit, then its calibration (slope, shift); and the weights of the two
    calibrated logits with their intercept."""

    weights: dict[str, np.ndarray]
    intercepts: dict[str, float]
    slopes: dict[str, float]
    shifts: dict[str, float]
    combination: tuple[float, float, float]

    def score(self, views: dict[str, np.ndarray]) -> np.ndarray:
        first, second, shift = self.combination
        calibrated = [
            self.slopes[v] * (views[v] @ self.weights[v] + self.intercepts[v]) + self.shifts[v] for v in VIEWS
        ]
        return 1 / (1 + np.exp(-np.clip(first * calibrated[0] + second * calibrated[1] + shift, -30, 30)))


def _fit(rows: DataFrame, view: str):
    """Logistic regression on a view, both classes weighing alike."""
    counts = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    total = sum(counts.values())
    weight = F.when(F.col("label") == 1, total / (2 * counts[1])).otherwise(total / (2 * counts[0]))
    frame = rows.select("label", weight.alias("weight"), array_to_vector(view).alias("features"))
    return LogisticRegression(labelCol="label", weightCol="weight", regParam=1e-4, maxIter=60).fit(frame)


def _logit(model, view: str):
    """The model's logit as a Column over the view's array."""
    weights = F.lit(model.coefficients.toArray().tolist())
    product = F.zip_with(view, weights, lambda x, w: x * w)
    return F.aggregate(product, F.lit(float(model.intercept)), lambda total, x: total + x)


def _hash_slices(rows: DataFrame, wanted: int, seed: int, slices: int = 1) -> DataFrame:
    """Of the rows those in the first ``slices`` parts of about ``wanted`` rows each, with ``slice`` (from 0)."""
    share = min(1.0, wanted / max(1, rows.count()))
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(2**40)) / F.lit(share * 2**40)
    return rows.withColumn("slice", F.floor(place).cast("int")).where(F.col("slice") < slices)


def fit_quality(
    docs: DataFrame, labels: DataFrame, work: Workspace, rounds: int = ROUNDS, fit_rows: int = FIT_ROWS,
    pool_rows: int = POOL_ROWS, label: str = "quality",
) -> QualityModel | float:
    """A model from ``docs`` (doc_id, text, source, lang) and ``labels`` (doc_id and ``label``, 0 or 1).

    At most about ``fit_rows`` labelled documents are used, and each round adds ``pool_rows`` further unlabelled ones to the
    pool, drawn by a hash of doc_id from all of them; the drawn ids are bounded, so they are broadcast and texts stay where
    they are. A fifth of the labelled ones only calibrates. With repeated labels the largest counts; NULL labels are none.
    Rows that repeat a doc_id are documents of their own. Texts are read whole, NULL ones as empty. If a class is missing
    the result is the share of label 1 instead of a model (0.5 without labels, as for empty tables).
    """
    one_each = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(label).cast("int").alias("label")
    )
    drawn = _hash_slices(one_each, fit_rows, 21).withColumn("use", F.when(F.pmod(F.xxhash64("doc_id", F.lit(22)), F.lit(5)) == 0, "calibrate").otherwise("fit"))
    unlabelled = docs.select("doc_id").distinct().join(one_each, "doc_id", "left_anti")
    pool = _hash_slices(unlabelled, pool_rows, 23, rounds).withColumns({"label": F.lit(None).cast("int"), "use": F.lit("pool")})
    sample = work.store(drawn.unionByName(pool), "sample")  # about fit_rows + rounds * pool_rows short rows
    rows = docs.select("doc_id", "text", "source", "lang").join(F.broadcast(sample), "doc_id")
    seen = work.store(with_views(rows, ["label", "use", "slice"]), "views")
    found = {(r[0], r[1]): r[2] for r in seen.groupBy("use", "label").count().collect()}
    if any(not found.get((use, y)) for use in ("fit", "calibrate") for y in (0, 1)):
        ones, all_ = sum(n for (_, y), n in found.items() if y == 1), sum(n for (_, y), n in found.items() if y is not None)
        return ones / all_ if all_ else 0.5

    labelled = seen.where("use = 'fit'")
    base = found["fit", 1] / (found["fit", 0] + found["fit", 1])
    added = {view: None for view in VIEWS}  # pseudo-labelled rows for a view, labelled by the other one
    models = {}
    for turn in range(rounds + 1):
        for view in VIEWS:
            train = labelled.select("label", view)
            if added[view] is not None:
                train = train.unionByName(added[view])
            models[view] = _fit(train, view)
        if turn == rounds or not found.get(("pool", None)):
            break
        pool = seen.where((F.col("use") == "pool") & (F.col("slice") <= turn))
        for view, other in (VIEWS, VIEWS[::-1]):
            scored = pool.select((1 / (1 + F.exp(-_logit(models[view], view)))).alias("chance"), other)
            # The quantile keeps both classes as common as among the labelled; it is taken over the bounded pool.
            high, low = scored.select(F.percentile("chance", 1 - SHARE * base), F.percentile("chance", SHARE * (1 - base))).first()
            if high is None:  # nothing in the pool yet
                continue
            sure = F.when(F.col("chance") >= max(CONFIDENT, high), 1).when(F.col("chance") <= min(1 - CONFIDENT, low), 0)
            added[other] = scored.select(sure.alias("label"), other).where("label IS NOT NULL")

    held = seen.where("use = 'calibrate'").select("label", *[_logit(models[v], v).alias(v) for v in VIEWS])
    held = work.store(held, "held")
    slopes, shifts = {}, {}
    for view in VIEWS:
        slopes[view], shifts[view] = _platt(held, [view])
    calibrated = held.select("label", *[(F.col(v) * slopes[v] + shifts[v]).alias(v) for v in VIEWS])
    return QualityModel(
        {v: models[v].coefficients.toArray() for v in VIEWS}, {v: float(models[v].intercept) for v in VIEWS}, slopes, shifts,
        _platt(calibrated, list(VIEWS)),
    )


def _platt(rows: DataFrame, columns: list[str]) -> tuple[float, ...]:
    """Slopes and shift of a logistic fit on logits, lightly held back so that separable scores stay finite. A score never
    counts against its own direction."""
    features = array_to_vector(F.array(*[F.least(F.greatest(F.col(c), F.lit(-30.0)), F.lit(30.0)) for c in columns]))
    frame = rows.select(F.col("label").cast("double").alias("label"), features.alias("features"))
    model = LogisticRegression(regParam=1e-3, maxIter=60, standardization=False).fit(frame)
    return (*np.maximum(model.coefficients.toArray(), 0.0).tolist(), float(model.intercept))


def score_quality(docs: DataFrame, model: QualityModel | float, text: str = "text") -> DataFrame:
    """``docs`` without text, source and lang, with ``score`` (0 to 1: label 1) and ``predicted``; equal names give way.

    Every whole text is scored; NULL texts as empty ones, NULL sources and languages as values of their own. Nothing is
    shuffled.
    """
    others = [c for c in docs.columns if c not in (text, "source", "lang", "score", "predicted")]
    shape = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in others)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches):
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            texts, sources, langs = (batch.column(len(others) + i).to_pylist() for i in range(3))
            if isinstance(shared.value, float):
                scores = np.full(len(texts), shared.value)
            else:
                scores = shared.value.score({
                    "content": np.array([content_view(t or "", known) for t in texts]),
                    "metadata": np.array([metadata_view(t or "", s, g) for t, s, g in zip(texts, sources, langs)]),
                })
            yield {**{c: batch.column(i) for i, c in enumerate(others)}, "score": scores, "predicted": (scores >= 0.5).astype(np.int32)}

    rows = docs.select(*others, text, F.col("source").cast("string"), F.col("lang").cast("string"))
    return map_arrow(rows, step, f"{shape}score double, predicted int")
