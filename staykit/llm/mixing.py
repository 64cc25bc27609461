"""Mixing sources to target weights by iterative proportional fitting.

The tokens of the corpus form a table of cells: source x language x topic. Each round scales the cells so that the shares of
one attribute become their targets, then of the next (raking); after some rounds all three hold together. Documents are then
drawn with the probability their cell was calibrated to. Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from staykit.sources.tables import Workspace

MARGINS = ("source", "lang", "topic")
ROUNDS = 30
TOLERANCE = 1e-6
# Share of the corpus' tokens that a mixture keeps, and how far targets flatten the shares found (1: not at all, 0: even).
KEPT = 0.5
TEMPERATURE = 0.7
NONE = "(none)"


def token_count(text: Column) -> Column:
    """Runs of anything but white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """A rough topic from the form of the text: tables, shouting, symbols, long or short prose."""
    text = F.coalesce(text, F.lit(""))
    return (
        F.when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("!! ")), "shouting")
        .when(text.rlike(r"[%$&#*]{3}"), "symbols")
        .when(F.length(text) >= 2000, "long prose")
        .otherwise("short prose")
    )


def weighed(docs: DataFrame, text: str = "text", topic: Column | None = None) -> DataFrame:
    """``docs`` with _source, _lang, _topic (NULLs have a value of their own) and _tokens."""
    return docs.withColumns({
        "_source": F.coalesce(F.col("source").cast("string"), F.lit(NONE)),
        "_lang": F.coalesce(F.col("lang").cast("string"), F.lit(NONE)),
        "_topic": F.coalesce(topic_of(F.col(text)) if topic is None else topic, F.lit(NONE)), "_tokens": token_count(F.col(text)),
    })


def flattened_targets(cells: DataFrame, margin: str, temperature: float = TEMPERATURE) -> DataFrame:
    """``margin`` and its target share: the share found to the power of ``temperature``, scaled to sum to one."""
    shares = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("tokens")).where("tokens > 0")
    powered = shares.select(margin, F.pow("tokens", F.lit(temperature)).alias("power"))
    total = powered.agg(F.sum("power")).scalar()
    return powered.select(margin, (F.col("power") / total).alias("target"))


@dataclass(frozen=True)
class Mixture:
    cells: DataFrame  # source, lang, topic, tokens, weight (calibrated tokens, in sum the tokens of the corpus)
    rounds: int
    error: float  # largest difference of a margin from its target share after the last round


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], work: Workspace, rounds: int = ROUNDS, tolerance: float = TOLERANCE
) -> Mixture:
    """Weights of ``cells`` (the margins' columns and ``tokens``) whose shares meet the targets.

    A target table has a margin's values and their ``target`` shares. Values without a target get weight 0; targets of
    values that do not occur are left out and the others scaled up. Rounds stop when no share is further than
    ``tolerance`` from its target, or after ``rounds`` if the targets contradict each other. The cells of a round are
    written, so plans stay short; sums of a margin combine before they are shuffled, however many cells share a value.
    """
    present, margins = {}, list(targets)
    for margin in margins:
        there = targets[margin].join(cells.where("tokens > 0").select(margin).distinct(), margin, "left_semi")
        total = there.agg(F.sum("target")).scalar()
        present[margin] = work.store(there.select(margin, (F.col("target") / total).alias("target")), "targets")
    tokens = cells.agg(F.sum("tokens").cast("double")).first()[0] or 0.0
    state = work.store(cells.withColumn("weight", F.col("tokens").cast("double")), "cells")
    error, done = 0.0, 0
    if not tokens:
        return Mixture(state, 0, 0.0)
    for done in range(1, rounds + 1):
        for margin in margins:
            sums = state.groupBy(margin).agg(F.sum("weight").alias("sum")).join(present[margin], margin, "left")
            factor = F.when(F.col("sum") > 0, F.coalesce("target", F.lit(0.0)) * tokens / F.col("sum")).otherwise(0.0)
            state = state.join(sums.select(margin, factor.alias("factor")), margin)
            state = state.withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")
        state = work.store(state.select(*cells.columns, "weight"), "cells")
        error = 0.0
        for margin in margins[:-1]:  # the last one has just been met
            sums = state.groupBy(margin).agg(F.sum("weight").alias("sum")).join(present[margin], margin)
            off = sums.agg(F.max(F.abs(F.col("sum") / tokens - F.col("target")))).first()[0]
            error = max(error, off or 0.0)
        if error <= tolerance:
            break
    return Mixture(state, done, error)


def calibrate(mixture: Mixture, kept: float = KEPT) -> DataFrame:
    """The cells with ``rate``: how often a document of the cell is taken on average, so that ``kept`` of all tokens are."""
    rate = F.when(F.col("tokens") > 0, F.col("weight") * kept / F.col("tokens")).otherwise(F.lit(0.0))
    return mixture.cells.withColumn("rate", rate)


def draw(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the key, the same in every run and on every executor."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit(NONE))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(2**48)


def mix(
    docs: DataFrame, work: Workspace, targets: dict[str, DataFrame] | None = None, kept: float = KEPT, seed: int = 17,
    temperature: float = TEMPERATURE, key: str = "doc_id", text: str = "text", topic: Column | None = None,
) -> tuple[DataFrame, Mixture]:
    """``docs`` with n_tokens, topic, weight, rate and copies, and the mixture; columns of these names give way.

    ``rate`` is the calibrated expectation; ``copies`` is its whole part, plus one with the probability of its fraction. A
    rate above 1 repeats documents rather than cutting the mixture's shares. The draw depends on the key alone, so repeated
    rows are drawn alike. NULL sources and languages are values of their own; documents without tokens have rate 0. Without
    ``targets`` each margin's own shares are flattened by ``temperature``. An empty table gives no rows.

    The cells are few and meet the documents in a join whose small side adaptive execution may broadcast by its size; a
    source that holds a third of all rows is then never shuffled, and split as a skewed key otherwise.
    """
    made = ("n_tokens", "topic", "weight", "rate", "copies")
    own = [c for c in docs.columns if c not in made]
    rows = weighed(docs, text, topic)
    cells = rows.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("tokens"))
    cells = work.store(cells.toDF(*MARGINS, "tokens"), "cells")
    if targets is None:
        targets = {m: flattened_targets(cells, m, temperature) for m in MARGINS}
    mixture = rake(cells, targets, work)
    rates = work.store(calibrate(mixture, kept), "rates").select(
        *[F.col(m).alias(f"_{m}") for m in MARGINS], F.col("rate").alias("_rate"),
        (F.col("weight") / F.greatest("tokens", F.lit(1))).alias("_weight"),
    )
    joined = rows.join(rates, ["_source", "_lang", "_topic"])
    rate = F.when(F.col("_tokens") > 0, F.col("_rate")).otherwise(0.0)
    whole = F.floor(rate)
    copies = whole + (draw(F.col(key), seed) < rate - whole).cast("long")
    mixed = joined.select(
        *own, F.col("_tokens").alias("n_tokens"), F.col("_topic").alias("topic"), F.col("_weight").alias("weight"), rate.alias("rate"),
        copies.alias("copies"),
    )
    return mixed, mixture
