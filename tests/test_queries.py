"""Every registered query against its SQL, on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check_queries import compare, duckdb_on

SF_DIR = "/root/testdata/sf0.001"
MODELS = {"boosted_fit"}
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    return duckdb_on(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert compare(spark, duck, SF_DIR, name, df) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in MODELS:
        assert "Python" not in plan and "InPandas" not in plan


def test_only_iterative_models_go_without_sql():
    assert set(entry.QUERIES) - set(entry.oracle_sql()) == ROWS_ONLY
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name",
    [
        "peer_by_stream", "peer_by_channel", "peer_by_week_part", "peer_by_day_part", "change_profile", "call_profile",
        "call_profile_before_churn", "promo_profile", "never_logged_in", "union_of_sparse_tables", "day_parts",
        "exclude_training_accounts", "account_quality",
    ],
)
def test_legacy_differs(spark, name):
    found = entry.queries()
    plain = "promo_profile_union" if name == "promo_profile" else name
    new, old = (found[n](spark, SF_DIR) for n in (plain, f"{name}_legacy"))
    columns = sorted(set(new.columns) & set(old.columns))
    assert {tuple(map(str, r)) for r in new.select(columns).collect()} != {tuple(map(str, r)) for r in old.select(columns).collect()}
