"""The two matrices end to end: one row per account, the expected columns, and the same rows lazy or layered."""

from __future__ import annotations

from pyspark.sql import functions as F
import pytest

from staykit.catalog import views as v
from staykit.catalog.queries import Source
from staykit.catalog.settle import settle
from staykit.functions.keys import AccountCipher
from staykit.operators.assemble import union_features
from staykit.plans.matrices import scoring_matrix, training_matrix
from staykit.sources.tables import Workspace

SF_DIR = "/root/testdata/sf0.001"
FEATURES = 4 * 9 + 7 + 73 + 2 + 1 + 1 + 6 + 43 + 5  # quality, viewing, top channel, variability, never, calls, changes, promo


def training(spark, **options):
    return training_matrix(Source(spark, SF_DIR).inputs(), v.AS_OF, v.FIRST_CHANGE, v.LABEL_DAYS, v.PROMO_SINCE, **options)


def test_training_matrix(spark):
    matrix = training(spark)
    assert len(matrix.columns) == len(set(matrix.columns)) == 1 + 1 + 4 + 8 + FEATURES
    counts = matrix.agg(F.count("account_guid").alias("n"), F.count_distinct("account_guid").alias("d")).first()
    assert counts["n"] == counts["d"] == Source(spark, SF_DIR).labels.count()


def test_training_is_scoring_with_churn_and_week_number(spark):
    source = Source(spark, SF_DIR)
    scored = scoring_matrix(source.inputs(), v.FIRST, v.AS_OF, v.PERIOD_DAYS, week_number="4")
    matrix = training(spark, week_number="4")
    assert set(matrix.columns) - set(scored.columns) == {"churn"} and not set(scored.columns) - set(matrix.columns)
    assert {r[0] for r in matrix.select("week_number").distinct().collect()} == {"4"}


def test_two_rows_of_an_account_are_an_error(spark):
    one = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "account_guid string, n int, t string")
    two = spark.createDataFrame([("a", 1.5), ("c", 2.5)], "account_guid string, m double")
    assert {tuple(r) for r in union_features([one, two]).collect()} == {("a", 1, "x", 1.5), ("b", 2, None, None), ("c", None, None, 2.5)}
    with pytest.raises(Exception, match="more than one row"):
        union_features([one, two.unionByName(two)]).collect()


def test_lazy_equals_layered(spark):
    layered = training(spark, layers=Workspace(spark))
    assert sorted(map(str, settle(training(spark)).collect())) == sorted(map(str, settle(layered).collect()))


def test_scoring_matrix_with_and_without_training_accounts(spark):
    source = Source(spark, SF_DIR)
    args = (source.inputs(), v.FIRST, v.AS_OF, v.PERIOD_DAYS)
    matrix = scoring_matrix(*args)
    assert len(matrix.columns) == 1 + 4 + 8 + FEATURES
    active = source.inputs().active(as_of=v.AS_OF).select("account_guid").distinct().count()
    assert matrix.count() == matrix.select("account_guid").distinct().count() == active
    without = scoring_matrix(*args, training=source.labels)
    assert without.where("active_day_cnt IS NOT NULL").count() == 0


@pytest.mark.parametrize("build", [
    lambda s: training_matrix(Source(s, SF_DIR).inputs(True), v.AS_OF, v.FIRST_CHANGE, v.LABEL_DAYS, v.PROMO_SINCE, legacy=True),
    lambda s: scoring_matrix(Source(s, SF_DIR).inputs(True), v.FIRST, v.AS_OF, v.PERIOD_DAYS, training=Source(s, SF_DIR).labels, legacy=True),
])
def test_literal_matrices_run(spark, build):
    matrix = build(spark)
    assert matrix.count() > 0 and matrix.where("never_logged_in IS NOT NULL").count() == 0


def test_encrypted_accounts_give_the_same_features(spark):
    """History and call log under the cipher, sessions and change log with encrypted billing ids."""
    plain = Source(spark, SF_DIR).inputs()
    cipher = AccountCipher(F.lit("0123456789abcdef"))
    histories = [
        type(h)(h.operator, h.table.withColumn("account_number", cipher.encrypt(F.col("account_number"))), h.eligible, h.promo)
        for h in plain.histories
    ]
    secret = type(plain)(plain.sessions, histories, plain.changes, plain.calls, plain.usage, plain.labels, cipher=cipher)

    def counts(inputs, column, **options):
        rows = inputs.promo(**options).groupBy("operator").agg(F.count(F.lit(1)).alias("n"), F.sum(column).alias("s"))
        return {tuple(r) for r in rows.collect()}

    for column in ("sum_truck_trouble_call", "count_zip_code_changes"):
        assert counts(plain, column, since=v.PROMO_SINCE) == counts(secret, column, since=v.PROMO_SINCE)
    totals = [
        sorted(tuple(r)[1:] for r in inputs.call_profile(as_of=v.AS_OF).collect()) for inputs in (plain, secret)
    ]
    assert totals[0] == totals[1] and len(totals[0]) > 5
