"""Hand-made cases of joins, aggregates, rankings and people."""

import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from playbill.operators import aggregates, distribution, joins, people, profile, ranking
from playbill.operators.derive import explode_list
from playbill.plans import reports


def test_ratio_keeps_other_types_in_the_total(spark):
    df = spark.createDataFrame([("A", t) for t in ("MOVIE", "MOVIE", "SHOW", "OTHER")], "country string, type string")
    assert aggregates.type_ratio(df, "country", ["MOVIE", "SHOW"]).collect() == [("A", 0.5, 0.25)]


def test_ratio_leaves_out_a_top_key_without_named_types(spark):
    rows = [("A", "OTHER")] * 3 + [("B", "SHOW")] * 2 + [("C", "MOVIE")] + [(None, "MOVIE")] * 9
    df = spark.createDataFrame(rows, "country string, type string")
    assert aggregates.type_ratio(df, "country", ["MOVIE", "SHOW"], n=2).collect() == [("B", 0.0, 1.0)]


def test_a_country_listed_twice_counts_twice(spark):
    df = spark.createDataFrame([("US, US",), ("US,",), (None,)], "countries string")
    assert aggregates.country_total(df).collect() == [("US", 3)]
    raw = aggregates.country_total(df, exploded=False).collect()
    assert sorted(raw) == [("US,", 1), ("US, US", 1)]


def test_trend_percent_counts_undated_rows(spark):
    rows = [("M", 2000), ("M", 2000), ("M", 2001), ("M", None), ("S", 2001), ("X", 1)]
    df = spark.createDataFrame(rows, "type string, year int")
    done = aggregates.trend(df, "year", ["M", "S"]).collect()
    assert sorted(done) == [("M", 2000, 2, 50.0), ("M", 2001, 1, 25.0), ("S", 2001, 1, 100.0)]


def test_average_skips_nulls_and_counts_all_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "k string, v double")
    assert sorted(aggregates.avg_by(df, "k", "v").collect()) == [("a", 1.0, 2), ("b", None, 1)]
    assert aggregates.avg_by(df, "k", "v", 0, True).collect() == [("a", 1.0, 1)]
    assert aggregates.avg_by(df, "k", "v", 1).collect() == [("a", 1.0, 2)]


def test_group_total_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5)], "k string, n int")
    for bound in (None, 2):
        done = joins.with_group_total(df, "k", "n", max_groups=bound).collect()
        assert sorted(done, key=str) == sorted([(None, 1, 3), (None, 2, 3), ("a", 5, 5)], key=str)


def test_keep_top_keys_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,), (None,), (None,)], "k string")
    assert sorted(r[0] for r in joins.keep_top_keys(df, "k", 2).collect()) == ["a", "c", "c"]


def test_reindex_orders_and_fills(spark):
    df = spark.createDataFrame([("x", 3), ("other", 9)], "k string, n int")
    assert sorted(joins.reindex(df, "k", ["y", "x"]).collect()) == [(0, "y", None), (1, "x", 3)]
    assert sorted(joins.reindex(df, "k", ["y", "x"], {"n": 0}).collect()) == [(0, "y", 0), (1, "x", 3)]


def test_constant_histogram(spark):
    df = spark.createDataFrame([(5.0,)] * 3, "v double")
    bars = distribution.histogram(df, "v", 40).collect()
    assert len(bars) == 40
    assert [(b["bin"], b["count"]) for b in bars if b["count"]] == [(20, 3)]
    assert sum(b["density"] * (b["bin_end"] - b["bin_start"]) for b in bars) == pytest.approx(1)


def test_histogram_follows_its_edges(spark):
    import numpy as np

    data = [i / 10 for i in range(101)] + [0.3, 0.7, 10.0, None]
    bars = distribution.histogram(spark.createDataFrame([(v,) for v in data], "v double"), "v", 10)
    wanted, _ = np.histogram([v for v in data if v is not None], bins=10)
    assert [b["count"] for b in bars.orderBy("bin").collect()] == list(wanted)
    assert distribution.histogram(spark.createDataFrame([(None,)], "v double"), "v").count() == 0


def test_top_k_cuts_ties_by_key_for_any_k(spark):
    rows = [(g, s, n) for g, (n, s) in itertools.product("ab", enumerate([5, 5, 3, 5, 1] * 3))]
    df = spark.createDataFrame(rows, "g string, s int, n int").repartition(5)

    def top(k):
        best = {g: sorted((-s, n) for gg, s, n in rows if gg == g)[:k] for g in "ab"}
        return sorted((g, -s, n) for g, picks in best.items() for s, n in picks)

    limit = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    try:
        for threshold in (limit, "2"):  # the second one takes the salted way
            spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
            got = ranking.top_k_by(df, "g", "s", 4, ["n"]).drop("rank").collect()
            assert sorted(got) == top(4)
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", limit)


def test_best_rows(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 1.0), ("d", None)], "k string, v double")
    flags = {r["k"]: r["is_best"] for r in ranking.mark_best(df, "v").collect()}
    assert flags == {"a": True, "b": True, "c": False, "d": False}
    assert ranking.arg_best(df, "k", "v").collect() == [("a", 2.0)]


def test_top_members_rarest_first(spark):
    df = spark.createDataFrame([("x, y",), ("x",), ("z",), ("No Data",), (None,), ("",)], "g string")
    assert ranking.top_members(df, "g", 2).collect() == [("y", 1), ("x", 2)]


CASTS = [(1, "90 min", "US, CA, US", "Ann, Bob ,Ann"), (2, "", "US", "Zed"), (3, None, "US", "Zed"),
         (4, "3 Seasons", "usa", "Bob"), (5, "1 min", "CA", "No Data")]


def test_top_people_from_list_text(spark):
    titles = spark.createDataFrame(CASTS, "id int, duration string, countries string, cast string")
    done = ranking.top_people(titles, ["US", "CA"], 5).drop("rank").collect()
    assert sorted(done) == [("CA", "Ann", 2), ("CA", "Bob", 1), ("US", "Ann", 2), ("US", "Bob", 1)]
    loose = ranking.top_people(titles, ["US"], 5, match="contains").drop("rank").collect()
    assert sorted(loose) == [("US", "Ann", 2), ("US", "Bob", 2)]
    untrimmed = ranking.top_people(titles, ["CA"], 5, trim=False).drop("rank").collect()
    assert sorted(untrimmed) == [("CA", " Bob ", 1), ("CA", "Ann", 2)]


def _credits(spark, hot):
    rows = [(1, f"P{i % 50}", "ACTOR") for i in range(hot)] + [(1, "Same", "ACTOR")] * 40
    rows += [(i, f"P{j}", "ACTOR") for i in range(2, 30) for j in range(i % 4)]
    rows += [(2, "Dir", "DIRECTOR"), (3, None, "ACTOR")]
    return rows, spark.createDataFrame(rows, "id int, name string, role string").repartition(6)


def test_a_very_long_cast_comes_in_bounded_parts_and_whole(spark):
    rows, df = _credits(spark, 400)
    wanted = Counter((i, n) for i, n, role in rows if role == "ACTOR" and n)
    whole = people.cast_list(df).collect()
    assert all(r["part"] == 0 and r["cast"] == sorted(r["cast"]) for r in whole)
    cut = people.cast_list(df, part_rows=20).collect()
    assert len({(r["id"], r["part"]) for r in cut}) == len(cut)
    assert len([r for r in cut if r["id"] == 1]) > 10
    assert max(len(r["cast"]) for r in cut) <= 20
    for lists in (whole, cut):
        assert Counter((r["id"], n) for r in lists for n in r["cast"]) == wanted


def test_attached_people(spark):
    _, df = _credits(spark, 100)
    titles = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d"), (99, "e")], "id int, title string")
    rows = people.attach_people(titles, df, part_rows=50).collect()
    long = [r for r in rows if r["id"] == 1]
    assert len(long) == len({r["part"] for r in long}) >= 3 and {r["actor_count"] for r in long} == {140}
    assert Counter(n for r in long for n in r["cast"]) == Counter([f"P{i % 50}" for i in range(100)] + ["Same"] * 40)
    done = {r["id"]: r for r in rows if r["id"] != 1}
    assert len(done) == len(rows) - len(long) and {r["part"] for r in done.values()} == {0}
    assert done[2]["cast"] == ["P0", "P1"] and done[2]["actor_count"] == 2
    assert done[4]["cast"] == done[99]["cast"] == ["No Data"] and done[99]["actor_count"] == 0


def test_people_without_a_name_count(spark):
    df = spark.createDataFrame([(1, None, "ACTOR"), (1, "A", "ACTOR"), (2, None, "ACTOR"), (2, None, "ACTOR")], "id int, name string, role string")
    titles = spark.createDataFrame([(1,), (2,)], "id int")
    for part_rows in (1, 10):
        got = sorted(people.attach_people(titles, df, part_rows=part_rows).collect())
        assert got == [(1, 2, 0, ["A"]), (2, 2, 0, ["No Data"])]
    counted = dict(people.people_per_title(df).collect())
    assert counted == {1: 2, 2: 2}


def test_top_people_are_the_same_listed_and_from_credits(spark):
    _, df = _credits(spark, 100)
    titles = spark.createDataFrame([(i, "90 min", "US, FR") for i in range(1, 30)], "id int, duration string, countries string")
    listed = people.cast_text(people.attach_people(titles, df, part_rows=2))
    assert sorted(ranking.top_people(listed, ["US", "FR"], k=60).collect()) == sorted(ranking.top_people(titles, ["US", "FR"], k=60, credits=df).collect())


def test_clean_two_tables_keeps_names_of_long_casts(spark):
    _, df = _credits(spark, 100)
    credits = df.withColumn("character", F.monotonically_increasing_id().cast("string"))
    titles = spark.createDataFrame(
        [(1, "a", "MOVIE", 1999, None, "['x', 'y']", 1.0), (1, "b", "MOVIE", 1998, "R", None, None),
         (2, None, "SHOW", 2001, "R", "[]", 3.0)],
        "id int, title string, type string, release_year int, rating string, genres string, score double",
    )
    done = reports.clean_two_tables(
        titles, credits, part_rows=50, mode_cols=["rating"], median_cols=["score"], text_cols=["genres"],
        list_cols=["genres"],
    )
    rows = done.titles.collect()
    row = rows[0]
    assert {r["id"] for r in rows} == {1} and len(rows) > 1
    assert (row["title"], row["rating"], row["main_genre"], row["genres"], row["decade"]) == ("a", "R", "x", "x, y", 1990)
    assert sum(len(r["cast"]) for r in rows) == 140


def test_reports_are_complete(spark):
    titles = spark.createDataFrame(
        [(i, "MOVIE" if i % 3 else "SHOW", 1990 + i % 20, 1980 + i % 30, 1990, "R", f"{i + 1} min", i % 10 / 1.0, "US, CA", "x, y", "Ann,Bob") for i in range(60)],
        "id int, type string, year_added int, release_year int, decade int, rating string, duration string, "
        "score double, countries string, genres string, cast string",
    )
    report = reports.catalogue_report(titles, ["US"])
    assert {k for k, df in report.items() if df.count() == 0} == set()
    charts = reports.chart_tables(report, ["<5", "5-6", "6-7", "7-8", "8-9", "9-10"], countries=["US"])
    assert {k for k, df in charts.items() if df.count() == 0} == set()
    assert [r["position"] for r in charts["scores_MOVIE"].collect()] == list(range(6))
    assert len(charts["length_curve"].collect()) == 200
    scores = reports.score_report(titles)
    assert {k: df.count() for k, df in scores.items()} == {"country": 2, "decade": 1, "genre": 2, "type": 2}


def test_explode_then_count_matches_brute_force(spark):
    texts = ["a, b", "b", "b, a, c", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "g string")
    wanted = Counter(m.strip() for t in texts if t is not None for m in t.split(","))
    got = explode_list(df, "g", "m").groupBy("m").count()
    assert dict(got.collect()) == wanted


@pytest.mark.parametrize(
    "values",
    [[float("-inf"), 1.0, 2.0, 3.0, 4.0], [float("-inf")] * 3 + [1.0, 2.0], [1.0, float("inf"), float("inf")], [float("nan"), 5.0, None]],
)
@pytest.mark.parametrize("at_once", [0, 100])
def test_medians_with_infinities(spark, values, at_once):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(2)
    known = sorted(v for v in values if v is not None and v == v)
    assert distribution.medians(df, ["v"], at_once) == {"v": known[len(known) // 2]}


def test_a_sketch_that_is_off_is_searched_on(spark):
    rows = list(range(1000))
    df = spark.createDataFrame([(float(v),) for v in rows], "v double")
    search = distribution._Search(499, 500, None, None, 0, 1000, (900.0, 950.0))
    counts = (900, 1, 49, 1, 901.0, 949.0, [900.0 + i for i in range(50)])
    after = distribution._narrowed("v", search, counts)
    assert (after.lo, after.hi, after.below, after.inside) == (None, 900.0, 0, 900)
    search.ends = (10.0, 20.0)
    after = distribution._narrowed("v", search, (10, 1, 9, 1, 11.0, 19.0, [11.0] * 201))
    assert (after.lo, after.hi, after.below, after.inside) == (20.0, None, 21, 979)
    assert df.filter(distribution._inside(F.col("v"), after.lo, after.hi)).count() == 979


def test_nan_is_missing_in_aggregates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", 3.0), ("b", None)], "k string, v double")
    assert distribution.moments(df, "v").first()["mean"] == 2.0
    assert sum(r["count"] for r in distribution.histogram(df, "v", 2).collect()) == 2
    assert all(r["density"] == r["density"] for r in distribution.normal_curve(df, "v", 3).collect())
    assert {tuple(r) for r in aggregates.avg_by(df, "k", "v").collect()} == {("a", 2.0, 3), ("b", None, 1)}
    assert aggregates.stats_by(df, "k", "v").first()["count"] == 2
    assert dict(aggregates.means_by(df, "k", ["v"]).collect()) == {"a": 2.0, "b": None}


def test_distinct_count_of_an_empty_table(spark):
    assert profile.distinct_count(spark.createDataFrame([], "a int, b string")).collect() == [("a", 0), ("b", 0)]


def test_profile_counts_gaps_before_and_after(spark, tmp_path):
    rows = [(1, None, "a"), (2, float("nan"), None), (2, 1.0, None), (None, 2.0, "b")]
    raw = spark.createDataFrame(rows, "id int, x double, y string").repartition(2)
    done, found = reports.cleaned_with_profile(raw, lambda df: df.na.fill("-", ["y"]).na.drop(subset=["id"]), f"{tmp_path}/out")
    got = {(r["stage"], r["column"]): (r["rows"], r["null_count"], r["null_rate"]) for r in found.collect()}
    assert got[("before", "id")] == (4, 1, 25.0) and got[("before", "x")][1] == 2 and got[("before", "y")][1] == 2
    assert got[("after", "id")] == (3, 0, 0.0) and got[("after", "y")] == (3, 0, 0.0) and done.count() == 3
    none = reports.cleaned_with_profile(raw.limit(0), lambda df: df, f"{tmp_path}/none")[1]
    assert {(r["rows"], r["null_rate"]) for r in none.collect()} == {(0, None)}


def test_facets_count_rows_and_members(spark):
    rows = [("M", 1, ["a", "b"]), ("M", None, None), ("S", 1, ["a", "a"]), (None, 2, [])]
    df = spark.createDataFrame(rows, "type string, year int, members array<string>")
    got = aggregates.facet_counts(df, {"year": F.col("year")}, {"member": F.col("members")})
    assert {tuple(r) for r in got.collect()} == {
        ("year", "M", "1", 1), ("year", "M", None, 1), ("year", "S", "1", 1), ("year", None, "2", 1),
        ("member", "M", "a", 1), ("member", "M", "b", 1), ("member", "S", "a", 2),
    }
    ratio = aggregates.ratio_of_counts(got.where("facet = 'member'"), "key", ["M", "S"])
    assert {tuple(r) for r in ratio.collect()} == {("a", 1 / 3, 2 / 3), ("b", 1.0, 0.0)}


def test_score_and_model_charts(spark):
    scores = reports.score_charts({
        k: spark.createDataFrame([("x", 5.0, 3), ("y", 7.0, 2)], f"{k} string, avg_score double, count int") for k in ("country", "genre", "decade")
    } | {"type": spark.createDataFrame([("MOVIE", 6.0, 1.5, 1.0, 9.0, 4)], "type string, avg_score double, std_score double, min_score double, max_score double, count int")})
    assert [tuple(r) for r in scores["genre_score"].collect()] == [("x", 5.0, 3, 6.0), ("y", 7.0, 2, 6.0)]
    assert tuple(scores["type_score"].first()) == ("MOVIE", 6.0, 4, 4.5, 7.5, 6.0)
    pairs = spark.createDataFrame([("a", 0.5), ("b", 0.25)], "feature string, importance double")
    models = reports.model_charts({
        "classifiers": spark.createDataFrame([("RF", 0.9, 0.8), ("LR", 0.7, 0.7)], "model string, accuracy double, f1 double"),
        "regressors": spark.createDataFrame([("RF", 0.9, 0.8), ("LR", 0.7, 0.7)], "model string, rmse double, r2 double"),
        "forest_importance": pairs, "boosted_importance": pairs,
        "k_sweep": spark.createDataFrame([(3, 0.5), (2, 0.4)], "k int, silhouette double"),
        "cluster_profile": spark.createDataFrame([(0, 4, 2000.0, 20.0)], "prediction int, size int, avg_release_year double, avg_actor_count double"),
    })
    assert [r["is_best"] for r in models["classifiers"].orderBy("model").collect()] == [False, True]
    assert [r["feature"] for r in models["forest_importance"].collect()] == ["b", "a"]
    assert [r["k"] for r in models["k_sweep"].collect()] == [2, 3]
    assert models["clusters"].first()["avg_release_year_scaled"] == 10.0
