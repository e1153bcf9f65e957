"""Results must not depend on how rows are laid out over partitions."""

import pytest
from pyspark.sql import functions as F

from playbill.models import clusters, features, supervised
from playbill.operators import aggregates, clean, distribution, joins, people, ranking
from playbill.operators.derive import explode_list
from playbill.plans.views import Tables

FOLDER = "/root/testdata/sf0.001"
TYPES = ["MOVIE", "SHOW"]

CASES = {
    "mode": lambda c, p: clean.fill_mode(c, ["rating"]),
    "median": lambda c, p: clean.fill_median(c, ["score"]),
    "dedup_by": lambda c, p: clean.dedup_by(p, ["id"], ["name"]),
    "histogram": lambda c, p: distribution.histogram(c, "score", 7),
    "ratio": lambda c, p: aggregates.type_ratio(explode_list(c, "countries", "k"), "k", TYPES, 4),
    "trend": lambda c, p: aggregates.trend(c, "release_year", TYPES),
    "top_keys": lambda c, p: joins.keep_top_keys(c, "genres", 3),
    "members": lambda c, p: ranking.top_members(c, "genres", 4),
    "people": lambda c, p: ranking.top_people(c, ["NATION_1", "NATION_2"], 4, credits=p),
    "cast": lambda c, p: people.cast_list(p),
    "cast_parts": lambda c, p: people.cast_list(p, part_rows=3),
    "attached": lambda c, p: people.attach_people(c, p, part_rows=3),
    "largest": lambda c, p: ranking.n_largest(c.select("id", "score"), "score", 9),
    "train": lambda c, p: features.split(c, "id")[0],
    "majority": lambda c, p: supervised.majority_accuracy(c, ["rating", "genres"]),
}


@pytest.mark.parametrize("name", CASES)
def test_same_rows_in_any_layout(spark, name):
    tables = Tables(spark, FOLDER)

    def rows(n):
        shuffled = [df.orderBy(F.xxhash64(F.lit(n), *df.columns)).repartition(n) for df in (tables.catalog, tables.credits)]
        return sorted(map(repr, CASES[name](*shuffled).collect()))

    first = rows(1)
    assert first and first == rows(7)


MODEL_CASES = {
    "clusters": lambda t: clusters.cluster(t.na.fill(0), MODEL_NUMBERS, k=4),
    "sweep": lambda t: clusters.k_sweep(t.na.fill(0), MODEL_NUMBERS, ks=[2, 3, 5]).withColumn("silhouette", F.round("silhouette", 9)),
    "forest": lambda t: supervised.importances(supervised.fit_classifier(supervised.fill_features(t, ["rating"], MODEL_NUMBERS), "rf", ["rating"], MODEL_NUMBERS), supervised.fill_features(t, ["rating"], MODEL_NUMBERS)),
    "boosted": lambda t: supervised.score_table(supervised.fit_classifier(t.na.fill(0), "gbt", [], MODEL_NUMBERS, maxIter=3), t.na.fill(0), ["id"]),
    "swept": lambda t: supervised.feature_accuracy(t, ["rating", "title"], buckets=64),
    "forest_score": lambda t: supervised.importances(supervised.fit_regressor(t.na.fill(0, ["runtime", "popularity"]), "rf", [], ["runtime", "popularity"], "score"), t.na.fill(0, ["runtime", "popularity"])),
}
MODEL_NUMBERS = ["score", "runtime", "popularity", "actor_count"]


@pytest.mark.parametrize("name", MODEL_CASES)
def test_same_fit_in_any_layout(spark, name):
    titles = Tables(spark, FOLDER).model_titles

    def rows(n):
        shuffled = titles.orderBy(F.xxhash64(F.lit(n), "id")).repartition(n)
        return sorted(map(repr, MODEL_CASES[name](shuffled).collect()))

    first = rows(1)
    assert first and first == rows(7)
