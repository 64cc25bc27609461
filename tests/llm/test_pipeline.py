"""The registered queries against their SQL, and the pipeline's stages against brute force."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check_queries import compare, duckdb_on
import corpus_pipeline
from staykit.llm import decontaminate, toxicity
from staykit.llm.queries import QUERIES
from staykit.sources.tables import Workspace

SF = "/root/testdata/sf0.001"
NATIVE = ("op2_mixing", "op7_chat_format", "op10_url_filter")


@pytest.fixture(scope="module")
def duck():
    return duckdb_on(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    assert compare(spark, duck, SF, name, df) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert name not in NATIVE or not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_stages_decide_and_keep_the_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sf_dir = "/root/testdata/sf0.01"
    planted = spark.createDataFrame(
        [(90001, "12345 67890 !!", None, None, 3), (90002, None, "en", "s", 0), (90003, docs.where("doc_id = 4").first().text, "fr", "x", 1)],
        docs.schema,
    )
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("item_id = 0").first().text
    planted = planted.unionByName(spark.createDataFrame([(90004, f"{item} {item}", "en", "s", 1)], docs.schema))
    rows = docs.unionByName(planted).withColumn("score", F.lit("mine")).withColumn("predicted", F.lit(2))
    with Workspace(spark) as work:
        for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
            kept = work.store(stage(spark, rows, sf_dir), name)
            before, after = {r.doc_id for r in rows.select("doc_id").collect()}, [r.doc_id for r in kept.select("doc_id").collect()]
            assert set(after) <= before and len(after) == len(set(after)) and after
            if place < len(corpus_pipeline.STAGES) - 1:
                assert kept.dtypes == rows.dtypes
                assert kept.where("score <> 'mine' or predicted <> 2").count() == 0
                same = kept.select("doc_id", "text").exceptAll(rows.select("doc_id", "text"))
                assert same.count() == 0
            if name == "toxicity":
                model = toxicity.fit_toxicity(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), work)
                scored = toxicity.score_toxicity(rows, model).where("predicted = 1")
                assert {r.doc_id for r in scored.collect()} == before - set(after)
            if name == "language":
                assert before - set(after) >= {90001, 90002}
            if name == "near_copies":
                assert 90003 not in after and (4 in after or 4 not in before)
            if name == "decontamination":
                items = [decontaminate.words_of(r.text.encode()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
                runs = {tuple(i[k:k + 13]) for i in items for k in range(max(1, len(i) - 12))}
                gone = set()
                for r in rows.collect():
                    words, hit = decontaminate.words_of(r.text.encode()), set()
                    for k in range(len(words) - 12):
                        if tuple(words[k:k + 13]) in runs:
                            hit |= set(range(k, k + 13))
                    if hit and 20 * len(hit) >= len(words):
                        gone.add(r.doc_id)
                assert gone == before - set(after) and 90004 in gone
            if name == "mixing":
                assert kept.where("copies < 1").count() == 0
            rows = kept


def test_empty_documents_pass_through(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, SF)
        assert rows.count() == 0
