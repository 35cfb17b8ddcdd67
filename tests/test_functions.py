"""Column helpers on tiny in-code frames (edge cases of FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from storefront.functions import (
    count_separators,
    day_name_padded,
    extract_number,
    id_list,
    literal_list,
    minutes_between,
    normalise_missing,
    parse_short_date,
    pattern_capture,
    round_ratio,
)
from storefront.operators import substrings


def one(spark, value, expr, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("out")).first()["out"]


def test_normalise_missing(spark):
    assert one(spark, "", normalise_missing("v")) is None
    assert one(spark, "null", normalise_missing("v")) is None
    assert one(spark, None, normalise_missing("v")) is None
    assert one(spark, "2, 6", normalise_missing("v")) == "2, 6"


def test_literal_list_splits_on_exact_separator(spark):
    assert one(spark, "1, 2, 3", literal_list("v")) == ["1", "2", "3"]
    # A list written without blanks stays one token, as an exact ', ' split does.
    assert one(spark, "1,2,3,4,5,6,7,8,9,10,11,12", literal_list("v")) == ["1,2,3,4,5,6,7,8,9,10,11,12"]
    assert one(spark, None, literal_list("v")) is None


def test_id_list_is_lenient(spark):
    assert len(one(spark, "1,2,3,4,5,6,7,8,9,10,11,12", id_list("v"))) == 12
    assert one(spark, "1, 5", id_list("v")) == ["1", "5"]
    assert one(spark, " 10 , 1,1", id_list("v")) == ["10", "1", "1"]
    assert one(spark, "7, 7", id_list("v")) == ["7", "7"]
    for missing in (None, "", "null"):
        assert one(spark, missing, id_list("v")) == []


def test_pattern_capture_returns_group_or_null(spark):
    # Only the fraction is captured by the leading-number pattern.
    assert one(spark, "13.4km", pattern_capture("v", r"^\d+(\.\d+)?")) == ".4"
    assert one(spark, "20km", pattern_capture("v", r"^\d+(\.\d+)?")) is None
    assert one(spark, "x", pattern_capture("v", r"(\d+\.\d+)")) is None
    assert one(spark, " 10.5 km", pattern_capture("v", r"(\d+\.\d+)")) == "10.5"


def test_extract_number(spark):
    cases = {"13.4km": 13.4, "20km": 20.0, "23.4": 23.4, " 10 km": 10.0, "32 minutes": 32.0,
             "1 minute": 1.0, "20 mins": 20.0, "15": 15.0, "null": None, None: None}
    for text, expected in cases.items():
        assert one(spark, text, extract_number("v")) == expected, text


def test_count_separators(spark):
    assert one(spark, "1, 5", count_separators("v")) == 1
    assert one(spark, "", count_separators("v")) == 0
    assert one(spark, None, count_separators("v")) is None


def test_minutes_between(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 18, 5, 2), dt.datetime(2020, 1, 1, 18, 15, 32))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(minutes_between("a", "b")).first()[0] == 10.5
    frac = spark.createDataFrame([(dt.datetime(2020, 1, 1, 0, 0, 0), dt.datetime(2020, 1, 1, 0, 0, 1, 500000))],
                                 "a timestamp_ntz, b timestamp_ntz")
    assert frac.select(minutes_between("a", "b")).first()[0] == 1.5 / 60  # fractional seconds count


def test_parse_short_date(spark):
    assert one(spark, "31/8/20", parse_short_date("v")) == dt.date(2020, 8, 31)
    assert one(spark, "1/12/99", parse_short_date("v")) == dt.date(1999, 12, 1)
    assert one(spark, "9/3/98", parse_short_date("v")) == dt.date(1998, 3, 9)
    assert one(spark, "1/1/69", parse_short_date("v")) == dt.date(2069, 1, 1)  # 00-69: 2000s
    assert one(spark, "1/1/70", parse_short_date("v")) == dt.date(1970, 1, 1)  # 70-99: 1900s
    assert one(spark, "32/13/20", parse_short_date("v")) is None
    assert one(spark, "not a date", parse_short_date("v")) is None


def test_day_name_padded(spark):
    assert one(spark, dt.date(2020, 6, 15), day_name_padded("v"), "v date") == "Monday   "
    assert one(spark, dt.date(2020, 6, 17), day_name_padded("v"), "v date") == "Wednesday"


def test_round_ratio_is_exact_half_away_from_zero(spark):
    df = spark.createDataFrame([(41, 40), (-41, 40), (1, 3), (5, 0), (None, 2), (4999999999996, 10**15), (0, -5)],
                               "n long, d long")
    got = [r[0] for r in df.select(round_ratio("n", "d")).collect()]
    # 0.004999999999996 must not be rounded twice (to 0.005, then 0.01).
    assert got == [1.03, -1.03, 0.33, None, None, 0.0, 0.0]
    pct = df.select(round_ratio("n", "d", scale=100)).first()[0]
    assert pct == 102.5


def test_substrings(spark):
    got = set(one(spark, "1, 10", substrings(F.col("v"), F.array(*[F.lit(n) for n in range(1, 6)]))))
    assert {"1", "10", "0", ", ", "1, 10"} <= got
    assert one(spark, "", substrings(F.col("v"), F.array(F.lit(1)))) == []
    assert one(spark, None, substrings(F.col("v"), F.array(F.lit(1)))) == []
    assert len(one(spark, "1" * 50 + "2" * 50, substrings(F.col("v"), F.array(F.lit(1), F.lit(2), F.lit(200))))) == 5
