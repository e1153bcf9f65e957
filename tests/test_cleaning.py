"""Hand-made edge cases of profiles, repairs and derived columns."""

import datetime
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from playbill.operators import clean, derive, filters, profile
from playbill.operators.distribution import medians


def values(df, col):
    return [r[col] for r in df.collect()]


def one(spark, rows, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"id int, v {kind}").coalesce(1)


def filled(df):
    return {r["id"]: r["v"] for r in df.collect()}


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = one(spark, ["z", "z", "b", "b", None])
    assert filled(clean.fill_mode(df, ["v"]))[4] == "b"


def test_mode_of_an_empty_column_stays_null(spark):
    assert filled(clean.fill_mode(one(spark, [None, None]), ["v"])) == {0: None, 1: None}


def test_median_of_an_even_count_and_nan_is_missing(spark):
    df = one(spark, [1.0, 2.0, 4.0, 10.0, None, float("nan")], "double")
    done = filled(clean.fill_median(df, ["v"]))
    assert done[4] == done[5] == 3.0
    assert filled(clean.fill_median(df, ["v"], approx=True))[4] in (2.0, 4.0)


def test_median_of_nothing_stays_null(spark):
    assert filled(clean.fill_median(one(spark, [None], "double"), ["v"])) == {0: None}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(-5, 5) | st.integers(-10_000, 10_000), min_size=1, max_size=60),
    st.integers(0, 40),
    st.sampled_from([1, 3, 10]),
)
def test_median_by_narrowing_is_exact(spark, numbers, repeats, at_once):
    data = [float(n) for n in numbers] + [float(numbers[0])] * repeats
    df = spark.createDataFrame([(v,) for v in data], "v double").coalesce(2)
    assert medians(df, ["v"], sorted_at_once=at_once)["v"] == statistics.median(data)


def test_list_text(spark):
    df = one(spark, ["['drama', 'war']", "[]", "No Data", None])
    assert values(derive.first_member(df, "v"), "main_genre") == ["drama", None, "No Data", "No Data"]
    assert values(derive.strip_list_text(df, "v"), "v") == ["drama, war", "", "No Data", None]


@pytest.mark.parametrize("trim, wanted", [(True, {"A": 2, "B": 1}), (False, {"A": 2, " B": 1})])
def test_explode_counts_repeats(spark, trim, wanted):
    rows = derive.explode_list(one(spark, ["A, B,A", None]), "v", "m", trim=trim)
    assert {r["m"]: r["count"] for r in rows.groupBy("m").count().collect()} == wanted


def test_explode_keeps_a_name_with_a_comma_in_an_array(spark):
    df = spark.createDataFrame([(["Smith, Jr."],)], "v array<string>")
    assert values(derive.explode_list(df, "v", "m"), "m") == ["Smith, Jr."]


def test_separator_is_literal(spark):
    assert values(derive.split_list(one(spark, ["a.b | c"]), "v", "|"), "v") == [["a.b", "c"]]


def test_bucket_bounds(spark):
    df = one(spark, [9.0, 8.999, 5.0, 4.999, None], "double")
    assert values(derive.bucket(df, "v"), "bucket") == ["9-10", "8-9", "5-6", "<5", "<5"]
    assert values(derive.bucket(df, "v", null_label="none"), "bucket")[-1] == "none"


def test_date_text(spark):
    df = one(spark, [" September 9, 2019", "bad", None])
    assert values(derive.parse_date(df, "v"), "v") == [datetime.datetime(2019, 9, 9), None, None]


def test_number_text(spark):
    df = one(spark, ["90 min", "2 Seasons", "Season", None])
    assert values(derive.extract_number(df, "v"), "v") == [90.0, 2.0, None, None]
    assert values(clean.coerce_numeric(df, ["v"]), "v") == [None] * 4


def test_decade_of_negative_and_round_years(spark):
    assert values(derive.decade_of(one(spark, [1999, 2000, None], "int"), "v"), "decade") == [1990, 2000, None]


def test_percent_label_is_blank_when_small(spark):
    df = one(spark, [0.05, 0.051, 0.634, None], "double")
    assert values(derive.percent_label(df, "v"), "label") == ["", "5%", "63%", ""]
    assert values(derive.percent_label(df, "v", 0, 1), "label")[2] == "63.4%"


def test_percent_of_an_empty_total(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "n int, total int")
    assert values(derive.percent_of(df, "n", "total"), "percent") == [None, 25.0]


def test_dedup_by_keeps_the_first_in_order(spark):
    rows = [("a", 2, "y"), ("a", 1, "z"), ("a", 1, "x"), (None, 5, "n")]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(3)
    assert sorted(clean.dedup_by(df, ["k"], ["o"]).collect(), key=str) == sorted(
        [("a", 1, "x"), (None, 5, "n")], key=str
    )


def test_constant_fill_covers_nan_and_zero(spark):
    df = spark.createDataFrame([(None, float("nan")), ("x", 2.0)], "s string, d double")
    assert clean.fill_constant(df, {"s": "No Data", "d": 0}).collect() == [("No Data", 0.0), ("x", 2.0)]


def test_sentinels_and_nulls_fall_out(spark):
    assert values(clean.drop_sentinels(one(spark, ["", "No Data", None, "x"]), "v"), "v") == ["x"]


def test_profile_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", float("nan")), ("a", None), ("b", 2.0)], "s string, d double")
    assert dict(profile.null_count(df).collect()) == {"s": 1, "d": 2}
    assert dict(profile.null_rate(df).collect()) == {"s": 25.0, "d": 50.0}
    assert profile.null_rate(df.na.drop()).count() == 0
    assert {r[0]: r[2] for r in profile.column_profile(df).collect()} == {"s": 3, "d": 2}


def test_distinct_count_takes_null_as_a_value(spark):
    df = one(spark, ["a", "a", "b", None])
    for approx in (False, True):
        assert dict(profile.distinct_count(df, ["id", "v"], approx).collect()) == {"id": 4, "v": 3}


def test_member_is_not_a_substring(spark):
    df = one(spark, ["A1, B", "A10", None, "b, A1"])
    assert [r["id"] for r in filters.has_member(df, "v", "A1").collect()] == [0, 3]
    assert [r["id"] for r in filters.contains_ci(df, "v", "a1").collect()] == [0, 1, 3]


def test_wildcards_are_plain_text(spark):
    assert filters.contains_ci(one(spark, ["50% off", "50 off"]), "v", "0%").count() == 1


def test_long_value_lists_become_a_semi_join(spark):
    df = spark.range(5_000)
    wanted = list(range(0, 4_000, 2))
    assert filters.in_set(df, "id", wanted).count() == 2_000


@pytest.mark.parametrize("n", [3, 1_001])
def test_value_lists_keep_columns_and_types(spark, n):
    df = spark.range(5_000).selectExpr("CAST(id % 7 AS STRING) AS v", "id AS k")
    got = filters.in_set(df, "k", [str(i) for i in range(n)])
    assert got.schema == df.schema and got.count() == n
