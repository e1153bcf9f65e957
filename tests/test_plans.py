"""What the planner makes of the operators."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from playbill.operators import aggregates, clean, filters, ranking
from playbill.operators.derive import explode_list
from playbill.plans import catalog_of_queries
from playbill.plans.views import Tables

FOLDER = "/root/testdata/sf0.001"
# their DataFrame is a table of finished scores, or fitting it takes long
FITTED = re.compile(r"m(0[679]|1\d|24)_|r06_")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


@pytest.mark.parametrize("name", [n for n in catalog_of_queries() if not FITTED.match(n)])
def test_no_python_and_no_pairwise_joins(spark, name):
    text = plan(catalog_of_queries()[name](spark, FOLDER))
    for operator in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_ratio_is_one_aggregate_and_a_top_n(tables):
    text = plan(aggregates.type_ratio(explode_list(tables.catalog, "countries", "country"), "country", ["MOVIE"]))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("FileScan") == 4  # orders, customer and nation twice
    assert "TakeOrderedAndProject" in text and "Window" not in text
    assert "[o_orderkey" in text and "o_totalprice" not in text


def test_equality_reaches_the_scan(tables):
    text = plan(filters.by_type(tables["orders"], "o_orderstatus", "F"))
    assert "EqualTo(o_orderstatus,F)" in text


@pytest.mark.parametrize("how", ["rank", "dedup"])
def test_group_limit_comes_before_the_shuffle(tables, how):
    rows = tables["lineitem"].select("l_orderkey", "l_quantity", "l_partkey")
    if how == "rank":
        df = ranking.top_k_by(rows, "l_orderkey", "l_quantity", 3, ["l_partkey"])
    else:
        df = clean.dedup_by(rows, ["l_orderkey"], ["l_quantity"])
    text = plan(df)
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_split_shuffles_its_counts_once(tables):
    df = aggregates.trend(tables.catalog, "release_year", ["MOVIE", "SHOW"])
    df.collect()
    assert "ReusedExchange [type" in plan(df)


def test_a_hot_title_is_split_in_the_join(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        # title 7 holds a third of all credits
        rows = spark.range(0, 90_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(2_000))).cast("long").alias("id"),
            F.concat(F.lit("P"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500)).cast("string")).alias("name"),
            F.lit("ACTOR").alias("role"),
        )
        titles = spark.range(2_000).select("id", F.lit("1 min").alias("duration"), F.lit("US, CA").alias("countries"))
        df = ranking.top_people(titles, ["US", "CA"], 10, credits=rows)
        got = {(r["country"], r["name"]): r["count"] for r in df.collect()}
        assert "skew=true" in plan(df)
        best = sorted(Counter(r[0] for r in rows.select("name").collect()).items(), key=lambda kv: (-kv[1], kv[0]))[:10]
        assert got == {(c, n): k for c in ("US", "CA") for n, k in best}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
