"""Column functions on hand-made values."""

from __future__ import annotations

from pyspark.sql import functions as F
import pytest

from staykit.functions.keys import OPERATORS, AccountCipher, account_guid, billing_id
from staykit.functions.numbers import BANDS, decile_band, ratio, to_number
from staykit.functions.text import finds, last_code, part, promo_pattern, taller_than
from staykit.functions.timeparts import DAY_PARTS_LEGACY, day_part, epoch_ms, moment, week_part


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def lit(value, kind="string"):
    return F.lit(value).cast(kind)


@pytest.mark.parametrize("stamp", [1517400000, 1517400000000])
def test_seconds_and_milliseconds_are_one_moment(spark, stamp):
    value = lit(stamp, "bigint")
    assert one(spark, epoch_ms(value)) == 1517400000000
    assert one(spark, F.hour(moment(value))) == 12
    assert one(spark, week_part(moment(value))) == "week_day"


def test_moments_follow_their_own_zone_only(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            assert one(spark, F.hour(moment(lit(1517400000, "bigint")))) == 12
            assert one(spark, F.hour(moment(lit(1517400000, "bigint"), "America/New_York"))) == 7
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "hour, name, legacy",
    [(0, "late_night", "late_night"), (3, "Overnight", "Overnight"), (7, "Breakfast", "late_night"),
     (12, "Daytime", "late_night"), (20, "PrimeTime", "late_night"), (23, "late_night", "late_night"),
     (None, "late_night", "late_night")],
)
def test_day_parts(spark, hour, name, legacy):
    assert one(spark, day_part(lit(hour, "int"))) == name
    assert one(spark, day_part(lit(hour, "int"), DAY_PARTS_LEGACY)) == legacy


def test_account_guid(spark):
    def guid(operator, division, number):
        return one(spark, account_guid(lit(operator), lit(division), lit(number)))

    assert guid("OP_A", "7", "12") == "OP_A::12"
    assert guid("OP_C", "7", "12") == "OP_C::7::12"
    assert guid("OP_C", None, "12") == "OP_C::12"
    assert guid("OTHER", "7", "12") == "12"
    assert guid(None, "7", "12") == "12"


@pytest.mark.parametrize("number, a, b, c", [("12345", "45", "12345", "000012345"), ("1234567890", "4567890", "1234567890", "1234567890")])
def test_billing_id(spark, number, a, b, c):
    assert [one(spark, billing_id(lit(number), o)) for o in OPERATORS] == [a, b, c]


def test_cipher_is_deterministic_and_reversible(spark):
    cipher = AccountCipher(F.lit("0123456789abcdef"))
    rows = spark.createDataFrame([("12345",), ("12345",), ("999",)], "n string").select(
        "n", cipher.encrypt(F.col("n")).alias("s"), cipher.decrypt(cipher.encrypt(F.col("n"))).alias("back"),
        cipher.decrypt(billing_id(cipher.encrypt(F.col("n")), OPERATORS[2], cipher)).alias("id"),
    ).collect()
    assert rows[0]["s"] == rows[1]["s"] != rows[2]["s"]
    assert all(r["back"] == r["n"] != r["s"] for r in rows)
    assert [r["id"] for r in rows] == ["000012345", "000012345", "000000999"]


def test_last_code(spark):
    pattern = promo_pattern(["AR", "AY", "A+B"])
    for text, code in [("none", ""), ("xARyAYz", "AY"), ("A+B", "A+B"), ("AAB", ""), (None, None)]:
        assert one(spark, last_code(lit(text), pattern)) == code
    assert one(spark, last_code(lit("A+B"), promo_pattern(["A+B"], literal=False))) == ""
    assert one(spark, last_code(lit("AAB"), promo_pattern(["A+B"], literal=False))) == "AB"


def test_text_tests(spark):
    assert one(spark, finds(lit("a,football"), "football|soccer")) is True
    assert one(spark, finds(lit(None), "football")) is False
    assert [one(spark, part(lit("a||b"), "||", i)) for i in range(3)] == ["a", "b", None]
    resolutions = ["1280x720", "640x480", "480x1080", "unknown", "720x720", None]
    assert [one(spark, taller_than(lit(r), 720)) for r in resolutions] == [True, False, True, False, False, False]


def test_ratio_of_zero(spark):
    assert one(spark, ratio(F.lit(1), F.lit(0))) is None


def test_bands_are_total_and_first_match_wins(spark):
    points = F.array(*[F.lit(float(p)) for p in range(10, 101, 10)])

    def band(value, first=0):
        return one(spark, decile_band(lit(value, "double"), points, first))

    assert [band(v) for v in range(5, 100, 10)] == list(BANDS)
    assert band(10) == "10_20percent" and band(20) == "10_20percent"
    assert band(90) == "80_90percent" and band(90.5) == "90_100percent" and band(None) == "10percent"
    # the literal form is one point too high, so its top band needs more than the maximum
    assert band(25, 1) == "10_20percent" and band(100, 1) == "80_90percent" and band(15, 1) == "10percent"


@pytest.mark.parametrize("value, number", [("1.5", 1.5), ("x", 0.0), (None, 0.0), ("NaN", 0.0), ("[3.0]", 0.0), ("2018-01-31", 0.0)])
def test_to_number(spark, value, number):
    assert one(spark, to_number(lit(value))) == number
