"""What a scored table says about a model: one pass over a histogram of its scores."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from staykit.functions.numbers import ratio

# Scores in one step of this many are told apart by nothing below; a report never holds more rows.
BINS = 10_000
# Probabilities are kept this far from 0 and 1 in the log loss.
EDGE = 1e-15


def positive_chance(probability: str = "probability") -> Column:
    """The second entry of a probability vector."""
    return F.get(vector_to_array(probability), F.lit(1))


def score_histogram(scored: DataFrame, score: Column | str, label: str = "label", bins: int = BINS) -> DataFrame:
    """``bin`` (whole steps of the score, 0 to ``bins``), ``rows``, ``positives`` and sums of log loss and squared error.

    Rows with a NULL or NaN score or a NULL label are left out; scores outside 0 to 1 count as 0 or 1. The rows are reduced to at most
    ``bins`` + 1 before anything is shuffled.
    """
    given = (F.col(score) if isinstance(score, str) else score).cast("double")
    rows = scored.select(given.alias("_score"), F.col(label).cast("double").alias("_label"))
    rows = rows.where("_score IS NOT NULL AND NOT isnan(_score) AND _label IS NOT NULL")
    rows = rows.withColumn("_score", F.greatest(F.least("_score", F.lit(1.0)), F.lit(0.0)))
    chance = F.greatest(F.least(F.when(F.col("_label") == 1, F.col("_score")).otherwise(1 - F.col("_score")), F.lit(1 - EDGE)), F.lit(EDGE))
    return rows.groupBy(F.floor(F.col("_score") * bins).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_label") == 1).alias("positives"),
        F.sum(-F.log(chance)).alias("log_loss"), F.sum((F.col("_score") - F.col("_label")) ** 2).alias("squares"),
    )


def _cumulated(histogram: DataFrame) -> DataFrame:
    """The histogram with what lies at or above each bin, and in all. A window over at most ``BINS`` + 1 rows."""
    above = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return histogram.select(
        "*", F.sum("rows").over(above).alias("said"), F.sum("positives").over(above).alias("hit"),
        F.sum("rows").over(everything).alias("all_rows"), F.sum("positives").over(everything).alias("all_positives"),
    )


def threshold_report(histogram: DataFrame, bins: int = BINS) -> DataFrame:
    """One row: ``auc``, ``log_loss``, ``mse``, and at the threshold of the best F1 (ties: the highest) ``threshold``,
    ``f1``, ``accuracy``, ``precision``, ``recall`` and the confusion matrix ``tp``, ``fp``, ``fn``, ``tn``.

    Scores of one bin count as equal in the AUC (half a win). Without rows of both classes the AUC is NULL; without any
    rows there is one row of NULLs and zeros.
    """
    wins = (F.col("rows") - F.col("positives")) * (F.col("hit") - F.col("positives") / 2)
    f1 = ratio(2 * F.col("hit"), F.col("said") + F.col("all_positives"))
    best = F.max(F.struct(F.coalesce(F.col("f1"), F.lit(-1.0)).alias("f1"), F.col("bin"), F.col("hit"), F.col("said")))
    total = _cumulated(histogram).withColumns({"f1": f1, "wins": wins}).agg(
        F.sum("wins").alias("wins"), F.sum("log_loss").alias("log_loss"), F.sum("squares").alias("squares"), best.alias("best"),
        F.coalesce(F.max("all_rows"), F.lit(0)).alias("n"), F.coalesce(F.max("all_positives"), F.lit(0)).alias("p"),
    )
    hit, said = F.coalesce("best.hit", F.lit(0)), F.coalesce("best.said", F.lit(0))
    tp, fp, fn = hit, said - hit, F.col("p") - hit
    tn = F.col("n") - said - fn
    return total.select(
        ratio(F.col("wins"), F.col("p") * (F.col("n") - F.col("p"))).alias("auc"), ratio(F.col("log_loss"), F.col("n")).alias("log_loss"),
        ratio(F.col("squares"), F.col("n")).alias("mse"), (F.col("best.bin") / bins).alias("threshold"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), ratio(tp + tn, F.col("n")).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
    )


def gains(histogram: DataFrame, groups: int = 10, bins: int = BINS) -> DataFrame:
    """Gains by falling score: for each of ``groups`` shares of the rows, the first bin down to which at least that share
    lies, its ``threshold``, how many rows and positives lie there, their ``capture`` (share of all positives) and ``lift``
    (their share of positives over that of all rows)."""
    # A bin completes every share that lies between the rows above it and the rows down to it.
    full = F.floor(F.col("said") * groups / F.col("all_rows"))
    earlier = F.floor((F.col("said") - F.col("rows")) * groups / F.col("all_rows"))
    rows = _cumulated(histogram).where(full > earlier)
    share = F.explode(F.sequence(earlier + 1, full)).alias("share")
    return rows.select(
        share, (F.col("bin") / bins).alias("threshold"), F.col("said").alias("rows"), F.col("hit").alias("positives"),
        ratio(F.col("hit"), F.col("all_positives")).alias("capture"),
        ratio(F.col("hit") * F.col("all_rows"), F.col("said") * F.col("all_positives")).alias("lift"),
    ).withColumn("share", (F.col("share") / groups))
