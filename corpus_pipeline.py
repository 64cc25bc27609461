"""A corpus pipeline: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from staykit.llm import decontaminate, jaccard, language, mixing, toxicity
from staykit.sources.tables import Workspace

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A language is accepted from this score on; ``und`` never is.
LANGUAGE_SCORE = 0.5
KEPT_TOKENS = 0.5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _apart(stage):
    """Keeps columns beyond those of documents out of a stage's way, whatever their names, and gives them back after it."""

    @wraps(stage)
    def run_stage(spark, docs, sf_dir):
        extra = {c: f"_extra{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        kept = stage(spark, docs.withColumnsRenamed(extra), sf_dir)
        return kept.withColumnsRenamed({hidden: c for c, hidden in extra.items()})

    return run_stage


@_apart
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half. The model is learned from all labels of the documents at hand."""
    with Workspace(spark) as work:
        model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"), work)
    return toxicity.score_toxicity(docs, model, keep_text=True).where("predicted = 0").select(*docs.columns)


@_apart
def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a known language is recognised. The model is learned from the declared languages."""
    with Workspace(spark) as work:
        model = language.fit_languages(docs, work)
    marked = language.identify(docs, model, keep_text=True)
    kept = marked.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LANGUAGE_SCORE))
    return kept.select(*docs.columns)


@_apart
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the one with the smallest doc_id."""
    return jaccard.keep_one(docs, jaccard.jaccard_join(docs, Workspace(spark)))


@_apart
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth lies in windows of the benchmark.

    Where more does, cutting the spans would leave a torn text, so the document goes. Clean documents stay as they are.
    """
    matched = decontaminate.match_benchmark(docs, _table(spark, sf_dir, "benchmark"), Workspace(spark), keep_text=True)
    return matched.where(~decontaminate.contaminated(F.col("n_words"), F.col("n_hit"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the mixture, with how often each is taken, its topic and its rate. Further columns go."""
    docs = docs.select(*COLUMNS)
    mixed, _ = mixing.mix(docs, Workspace(spark), kept=KEPT_TOKENS)
    return mixed.where("copies > 0").select(*COLUMNS, "topic", "n_tokens", "rate", "copies")


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# Two stages are learned classifiers, which SQL cannot express. Tests compare the stages with plain versions where there is
# one (near copies, decontamination), and with planted rows where there is none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents."""
    work, docs = Workspace(spark), _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.store(stage(spark, docs, sf_dir), name)
    return docs
