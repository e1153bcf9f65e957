"""Empirical Bayes quality: shrinkage by hand, odd rows, agreement with labels."""

import pytest
from pyspark.sql import functions as F

from playbill.llm import quality, queries


def test_scores_agree_with_labels(spark):
    folder = "/root/testdata/sf0.1"
    got = queries.op1_empirical_bayes(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    r = got.agg(
        F.avg((F.col("kept") == good).cast("int")).alias("right"),
        F.avg(F.when(good, F.col("kept").cast("int"))).alias("good"),
        F.avg(F.when(F.col("toxic") == 1, F.col("kept").cast("int"))).alias("toxic"),
    ).first()
    assert r["right"] > 0.9 and r["good"] > 0.97, r


def test_sites_shrink(spark, monkeypatch):
    class Flat(quality.TextClassifier):
        def __init__(self, train):
            self.words = []

        def evidence(self, x):
            return F.get(x, F.lit(9)) * -4 + 1  # empty texts are bad

    monkeypatch.setattr(quality, "TextClassifier", Flat)
    rows = [(i, "good words" if i % 2 else "", "a", "x") for i in range(100)] + [(200 + i, "fine", "b", "y") for i in range(50)] + [(300, "", "c", "z"), (301, "", "b", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    labels = spark.createDataFrame([], "doc_id long, good int")
    got = {r["doc_id"]: r for r in quality.quality_scores(df, labels, df["host"], df["path"], F.col("good")).collect()}
    assert len(got) == len(rows)
    # One empty page alone: its host is drawn to the rate of all sites, not to its own.
    import math

    p = {r[0]: 1 / (1 + math.exp(3 if not r[1] else -1)) for r in rows}
    prior = sum(p.values()) / len(p)
    assert p[300] < got[300]["host_rate"] < prior
    assert abs(got[300]["path_rate"] - got[300]["host_rate"]) < 1e-9
    assert got[201]["score"] > got[1]["score"] and got[301]["score"] > got[0]["score"]


@pytest.mark.parametrize("some", [True, False])
def test_odd_rows(spark, some):
    rows = [(1, None, None, None), (2, "", "h", None), (2, "", "h", None), (None, "a b", None, "p"), (4, "x" * 100_000, "h", "p"), (5, "w " * 9_000, "h", "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, evidence string, k string")
    labels = spark.createDataFrame([(2, 0), (5, 1), (5, 1), (9, 1), (4, None)] if some else [], "doc_id long, good int")
    got = quality.quality_scores(df, labels, df["evidence"], df["k"], F.col("good")).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert some or {r["score"] for r in got} == {0.5}
    assert quality.quality_scores(df.limit(0), labels, df["evidence"], df["k"], F.col("good")).count() == 0
