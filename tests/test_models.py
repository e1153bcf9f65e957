"""Models on planted signals, slot names, splits, refusals."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation
from pyspark.sql import functions as F

from playbill.models import boosting, clusters, features, fits, metrics, supervised
from playbill.plans import catalog_of_queries, reports


@pytest.fixture(scope="module")
def planted(spark):
    """Length decides the type, genre x and length drive the score."""
    n = F.col("id")
    rows = spark.range(600).select(
        "id",
        F.concat(F.lit("T"), n.cast("string")).alias("title"),
        F.when(n % 3 == 0, "SHOW").otherwise("MOVIE").alias("type"),
        F.when(n % 5 == 0, "x").when(n % 5 < 3, "y").otherwise("z").alias("genre"),
        F.when(n % 3 == 0, n % 9).otherwise(60 + n % 40).cast("double").alias("runtime"),
        (n % 7).cast("double").alias("noise"),
    )
    score = F.when(F.col("genre") == "x", 5.0).otherwise(1.0) + F.col("runtime") / 50
    return rows.withColumn("score", F.when(n % 11 != 0, score)).cache()


def test_index_by_count_then_name(spark):
    rows = [("b",)] * 5 + [("a",)] * 2 + [("z",)] * 9 + [("c",)] * 2
    done = features.index(spark.createDataFrame(rows, "k string"), ["k"]).distinct().collect()
    assert {r["k"]: r["k_index"] for r in done} == {"z": 0, "b": 1, "a": 2, "c": 3}


def test_free_text_is_refused(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("k"))
    with pytest.raises(ValueError, match="more than 50"):
        features.index(df, ["k"], max_labels=50)


def test_assembly_of_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "v double")
    with pytest.raises(Exception):
        features.assemble(df, ["v"]).collect()
    assert features.assemble(df, ["v"], invalid="skip").count() == 1


def test_split_is_a_partition_of_the_rows(planted):
    train, test = features.split(planted, "id")
    ids = {r["id"] for r in train.collect()}, {r["id"] for r in test.collect()}
    assert not ids[0] & ids[1] and len(ids[0] | ids[1]) == 600
    assert 0.6 < len(ids[0]) / 600 < 0.8
    again = features.split(planted.repartition(5), "id")[0]
    assert {r["id"] for r in again.collect()} == ids[0]
    other = features.split(planted, "id", seed=1)[0]
    assert {r["id"] for r in other.collect()} != ids[0]


@pytest.mark.parametrize("kind", ["rf", "lr", "gbt"])
def test_classifiers_find_the_signal(planted, kind):
    train, test = features.split(planted, "id")
    model = supervised.fit_classifier(train, kind, ["genre"], ["runtime", "noise"], maxIter=5) if kind == "gbt" else (
        supervised.fit_classifier(train, kind, ["genre"], ["runtime", "noise"])
    )
    assert metrics.class_metrics(model.transform(test)).first()["accuracy"] > 0.95


@pytest.mark.parametrize("kind", ["rf", "lr"])
def test_classifiers_predict_in_a_session_that_observed_a_table(spark, planted, kind):
    seen = Observation(f"before {kind}")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("rows")).collect()
    train, test = features.split(planted, "id")
    model = supervised.fit_classifier(train, kind, ["genre"], ["runtime", "noise"])
    assert not model.stages[-1].hasSummary
    assert metrics.class_metrics(model.transform(test)).first()["accuracy"] > 0.95


def test_feature_sweep_in_a_session_that_observed_a_table(spark, planted):
    spark.range(3).observe(Observation("before sweep"), F.count(F.lit(1)).alias("rows")).collect()
    swept = supervised.feature_accuracy(planted.withColumn("same", F.col("type")), ["same", "genre"], buckets=16)
    assert [r["feature"] for r in swept.collect() if r["is_best"]] == ["same"]


def test_line_of_price_by_quantity(spark, tmp_path):
    rows = [(i, 1, float(i % 9), 3.0 * (i % 9) + 2) for i in range(40)] + [(41, 1, None, 5.0), (42, 1, 4.0, None), (None, None, 1.0, 5.0)]
    schema = "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = catalog_of_queries()["m14_linear_regression"](spark, str(tmp_path)).collect()
    assert {r["feature"]: round(r["weight"], 3) for r in found} == {"l_quantity": 3.0, "(intercept)": 2.0, "(r2)": 1.0}


def test_wide_vectors_are_the_same_without_names(spark, monkeypatch):
    rows = [(i, f"t{i % 30}" if i % 7 else None, ("x", "y")[i % 2], float(i % 4)) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, title string, part string, n double")
    indexed = features.index(df, ["title", "part"])

    def vectors():
        whole = features.assemble(features.one_hot(indexed, ["title", "part"]), ["title_vec", "n", "part_vec"])
        return whole.columns, whole.schema["features"].metadata["ml_attr"], sorted(whole.select("id", "title_vec", "part_vec", "features").collect())

    columns, named, expected = vectors()
    monkeypatch.setattr(features, "NAMED_SLOTS", 20)
    found = vectors()
    assert (found[0], found[2]) == (columns, expected)
    assert found[1] == {"num_attrs": 30 + 1 + 2} == {"num_attrs": named["num_attrs"]}
    gaps = indexed.withColumn("n", F.when(F.col("id") > 9, F.col("n"))).transform(lambda d: features.one_hot(d, ["title"]))
    assert features.assemble(gaps, ["title_vec", "n"], invalid="skip").count() == 80
    assert features.assemble(gaps, ["title_vec", "n"], invalid="keep").collect()[0]["features"].size == 31
    with pytest.raises(Exception, match="null or not a number"):
        features.assemble(gaps, ["title_vec", "n"]).collect()


def test_slots_are_named_by_the_model_and_survive_saving(planted, tmp_path):
    train, test = features.split(planted, "id")
    model = supervised.fit_regressor(train, "rf", ["genre"], ["runtime", "noise"], "score")
    weights = {r["feature"]: r["importance"] for r in supervised.importances(model, train).collect()}
    assert set(weights) == {"genre_vec_x", "genre_vec_y", "genre_vec_z", "runtime", "noise"}
    assert weights["runtime"] + weights["genre_vec_x"] > 0.6 > 0.1 > weights["noise"]
    model.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    ours, theirs = (m.transform(test).select("id", "prediction").orderBy("id").collect() for m in (model, back))
    assert ours == theirs


def test_boosting_needs_two_classes(planted):
    three = planted.withColumn("type", F.col("genre"))
    with pytest.raises(ValueError, match="exactly two"):
        supervised.fit_classifier(three, "gbt", [], ["runtime"])


def test_tuning_reports_every_combination(planted):
    train, _ = features.split(planted, "id")
    model, table = supervised.tune(train, [], ["runtime"], grid={"maxDepth": [1, 2], "maxIter": [1]}, folds=2)
    rows = table.collect()
    assert [r["maxDepth"] for r in rows] == [1, 2] and sum(r["is_best"] for r in rows) == 1
    assert min(r["avg_f1"] for r in rows) > 0.9
    assert "prediction" in model.transform(train).columns


def test_tuning_fits_like_rows_once_with_their_number(spark, monkeypatch):
    rows = [(i, "MS"[(i * i) % 7 < 3 and i % 11 > 0], "xyz"[i % 3], float(i % 7)) for i in range(600)]
    df = spark.createDataFrame(rows + rows[:40], "id int, type string, genre string, a double")
    trained = []

    class Watched(supervised.GBTClassifier):
        def fit(self, dataset, params=None):
            trained.append(dataset.count())
            return super().fit(dataset, params)

    monkeypatch.setattr(supervised, "GBTClassifier", Watched)
    grid = {"maxDepth": [1, 3], "maxIter": [2, 4]}

    def tuned():
        model, table = supervised.tune(df, ["genre"], ["a"], grid=grid, folds=2)
        shown = model.transform(df).select("id", "prediction").distinct().orderBy("id").collect()
        return [(*r[:2], round(r["avg_f1"], 9), r["is_best"]) for r in table.collect()], shown

    few = tuned()
    assert max(trained) <= 2 * 3 * 7
    monkeypatch.setattr(fits, "KINDS", 0)
    assert tuned() == few and max(trained) == 640


def test_feature_sweep_scores_free_text_too_and_flags_the_best(planted):
    done = {r["feature"]: r for r in supervised.feature_accuracy(planted, ["title", "runtime", "genre"]).collect()}
    assert done["title"]["accuracy"] is not None and done["title"]["n_distinct"] > 100
    assert done["runtime"]["is_best"] and done["runtime"]["accuracy"] > done["genre"]["accuracy"]


def test_feature_sweep_fits_the_used_slots_alone(planted, monkeypatch):
    sizes = []

    class Watched(supervised.RandomForestClassifier):
        def fit(self, dataset, params=None):
            sizes.append(dataset.first()["features"].size)
            return super().fit(dataset, params)

    monkeypatch.setattr(supervised, "RandomForestClassifier", Watched)
    gaps = planted.withColumns({"genre": F.when(F.col("id") % 4 > 0, F.col("genre")), "empty": F.lit(None).cast("string")})

    def swept():
        return sorted(tuple(r) for r in supervised.feature_accuracy(gaps, ["genre", "runtime", "empty"], parallelism=1).collect())

    few = swept()
    assert sizes[0] <= 3 and sizes[1] <= 43 and sizes[2] == 1
    monkeypatch.setattr(supervised, "_used_slots", lambda df, features: list(range(512)))
    assert swept() == few and sizes[3:] == [512] * 3


def test_clusters_read_titles_written_once(spark):
    files = catalog_of_queries()["m18_kmeans"](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and not [f for f in files if "lineitem" in f or "orders" in f]


def test_a_fit_has_few_partitions(spark):
    assert fits.in_order(spark.range(3_000_000), "id").rdd.getNumPartitions() == fits.LEAST_PARTITIONS


def test_majority_matches_brute_force(spark):
    rows = [(i, "MS"[(i * i) % 3 == 1], f"v{i % 7}" if i % 13 else None) for i in range(200)] + [(203, "M", "unseen"), (204, "S", "tie"), (209, "M", "tie")]
    df = spark.createDataFrame(rows, "id int, type string, v string")
    in_train = {i: i % 10 < 7 for i, _, _ in rows}
    train = [(t, v) for i, t, v in rows if in_train[i]]
    test = [(t, v) for i, t, v in rows if not in_train[i]]

    def common(types):
        return min(set(types), key=lambda t: (-types.count(t), t))

    top = common([t for t, _ in train])
    guess = {v: common([t for t, w in train if w == v]) for v in {v for _, v in train}}
    wanted = sum(guess.get(v, top) == t for t, v in test) / len(test)
    got = supervised.majority_accuracy(df, ["v"], in_train=F.col("id") % 10 < 7).first()["accuracy"]
    assert got == pytest.approx(wanted)


def test_regression_drops_missing_targets(planted):
    table = supervised.compare_regressors(planted, ["genre"], ["runtime", "noise"], "score", kinds=("lr",))
    row = table.first()
    assert row["model"] == "Linear Regression" and row["r2"] > 0.999


def test_clusters_and_best_k(spark):
    rows = [(i, 10.0 * (i % 3) + i * 7 % 31 / 31, 10.0 * ((i + 1) % 3) + i * 11 % 29 / 29) for i in range(90)] + [(99, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    done = clusters.cluster(df, ["a", "b"], k=3, nulls="skip").collect()
    assert len(done) == 90 and len({(r["id"] % 3, r["prediction"]) for r in done}) == 3
    assert len(clusters.cluster(df, ["a", "b"], k=3, nulls="fill").collect()) == 91
    best = [r["k"] for r in clusters.k_sweep(df, ["a", "b"], ks=[2, 3, 4], nulls="skip").collect() if r["is_best"]]
    assert best == [3]
    with pytest.raises(ValueError):
        clusters.cluster(df, ["a"], nulls="guess")
    with pytest.raises(Exception, match="null"):
        clusters.cluster(df, ["a", "b"], k=3)
    scaled = reports.cluster_chart(
        clusters.cluster_profile(spark.createDataFrame(done).withColumnsRenamed({"a": "release_year", "b": "actor_count"}), ["release_year", "actor_count"])
    )
    assert {"avg_release_year_scaled", "avg_actor_count_scaled"} <= set(scaled.columns)


def test_metrics_of_small_tables(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 1.0)], "label double, prediction double")
    row = metrics.class_metrics(df).first()
    assert row["accuracy"] == 0.5
    assert row["f1"] == pytest.approx((2 * (2 / 3) + 1 * (1 / 2)) / 4)
    reg = metrics.reg_metrics(spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "label double, prediction double")).first()
    assert (reg["mse"], reg["r2"]) == (0.5, 0.5)


def test_silhouettes_equal_the_evaluators(spark):
    rows = [(i * 7 % 31 / 31 + 5 * (i % 3), i * 11 % 29 / 29, i % 3, (i % 3) * 2 if i else 5, 0) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, g int, h int, one int").repartition(3)
    df = features.assemble(df, ["a", "b"])
    centres = np.array([[0.5, 0.5], [5.5, 0.5], [10.5, 0.5], [99.0, 99.0]])
    got = metrics.silhouettes(df, ["g", "h", centres, "one"])
    for name, value in zip("gh", got):
        assert abs(value - metrics.silhouette_score(df, "features", name)) < 1e-9
    assert abs(got[2] - got[0]) < 1e-9 and got[3] is None
    assert metrics.silhouettes(df.limit(0), ["g"]) == [None]


def test_rounds_of_kmeans_equal_plain_ones(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.6, (80, 2)) for c in ((0, 0), (4, 1), (1, 5), (6, 6))])
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x.tolist())], ["id", "features"]).repartition(3)
    ks = [2, 3, 4, 7]
    found = clusters.fit_centres(df, ks)
    starts = clusters.fit_centres(df, ks, rounds=0)
    for k, centres, start in zip(ks, found, starts):
        for _ in range(clusters.MAX_ROUNDS):
            own = ((x[:, None] - start) ** 2).sum(2).argmin(1)
            start = np.array([x[own == c].mean(0) if (own == c).any() else start[c] for c in range(len(start))])
        assert len(centres) == k and np.allclose(centres, start, atol=1e-3)
    cost = ((x[:, None] - found[2]) ** 2).sum(2).min(1).sum()
    library = KMeans(k=4, seed=1).fit(df).summary.trainingCost
    assert cost <= 1.01 * library
    same = spark.createDataFrame([(i, Vectors.dense([1.0])) for i in range(9)], ["id", "features"])
    assert [c.tolist() for c in clusters.fit_centres(same, [1, 3])] == [[[1.0]], [[1.0]]]
    assert clusters.fit_centres(same.limit(0), [2]) == []


def test_first_rounds_are_those_of_a_shorter_fit(planted):
    rows = planted.withColumn("noisy", F.when(F.xxhash64("id") % 10 < 2, F.lit("SHOW")).otherwise(F.col("type")))
    train, test = features.split(rows, "id")
    stages = features.feature_stages(["genre"], ["runtime", "noise"], "noisy")
    with supervised.encoded(train, stages) as (encoder, vectors):
        shown = encoder.transform(test).select("label", "features")
        long = GBTClassifier(seed=42, maxIter=9, maxDepth=4).fit(vectors)
        found = supervised.f1_by_rounds(long, shown, [2, 5, 9])
        for n, f1 in zip([2, 5, 9], found):
            short = GBTClassifier(seed=42, maxIter=n, maxDepth=4).fit(vectors).transform(shown)
            assert f1 == pytest.approx(metrics.class_metrics(short).first()["f1"], abs=1e-12)


def test_missing_labels_and_many_labels(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "k string")
    got = sorted((r["k"] or "", r["k_index"]) for r in features.index(df, ["k"]).collect())
    assert got == [("", 2.0), ("a", 1.0), ("b", 0.0), ("b", 0.0)]
    assert features.index(df, ["k"], invalid="skip").count() == 3
    with pytest.raises(Exception, match="missing label in k"):
        features.index(df, ["k"], invalid="error").collect()
    assert features.index(df.limit(0), ["k"]).collect() == []
    many = spark.range(5000).select(F.format_string("t%05d", "id").alias("k"), "id").repartition(6)
    assert all(r["k_index"] == r["id"] for r in features.index(many, ["k"]).collect())


def _rows_that_differ(spark, n=4000):
    """Two numbers, one of few values, and two categories, one with a gap, decide the type but for some noise."""
    draw = np.random.default_rng(4)
    a, b, c = draw.normal(size=n), draw.integers(0, 50, n), draw.gamma(2, size=n)
    genre, rating = draw.choice(list("xyz"), n), draw.choice(["g", "pg", "r", "No Data"], n)
    chance = 1 / (1 + np.exp(-(2 * a + (b % 7) - 3 + 2 * (genre == "x") * (c > 1) - (rating == "r"))))
    kind = np.where(draw.random(n) < chance, "MOVIE", "SHOW")
    rows = [(i, str(k), str(g), str(r), float(x), int(y), float(z)) for i, (k, g, r, x, y, z) in enumerate(zip(kind, genre, rating, a, b, c))]
    return spark.createDataFrame(rows, "id long, type string, genre string, rating string, a double, b int, c double")


def test_trees_grown_in_tasks_are_those_of_the_library(spark, monkeypatch):
    """Scores of the whole grid, and the model of the best, tree by tree."""
    df = _rows_that_differ(spark)
    asked = dict(cat=["genre", "rating"], num=["a", "b", "c"], grid={"maxDepth": [2, 5], "maxIter": [3, 6]}, folds=2)
    expected, scores = supervised.tune(df, **asked)
    monkeypatch.setattr(supervised, "GROWN_FROM", 1)
    monkeypatch.setattr(supervised, "f1_by_rounds", None)
    model, found = supervised.tune(df.repartition(3), **asked)
    assert [r["is_best"] for r in found.collect()] == [r["is_best"] for r in scores.collect()]
    assert [r["avg_f1"] for r in found.collect()] == pytest.approx([r["avg_f1"] for r in scores.collect()], abs=2e-3)
    ours, theirs = model.stages[-1], expected.stages[-1]
    assert ours.treeWeights == theirs.treeWeights and ours.numFeatures == theirs.numFeatures
    assert [(x.numNodes, x.depth) for x in ours.trees] == [(x.numNodes, x.depth) for x in theirs.trees]
    # Where two slots divide the rows of a node alike, either may be named.
    assert list(ours.featureImportances.toArray()) == pytest.approx(list(theirs.featureImportances.toArray()), abs=1e-3)
    a, b = (np.array(m.transform(df).orderBy("id").select("probability").toPandas()["probability"].map(lambda v: v[1])) for m in (model, expected))
    assert np.abs(a - b).max() < 1e-6


def test_tuning_of_many_rows_takes_no_fit_of_the_library(spark, monkeypatch):
    """The library's fit runs once, on two rows, to shape the model of the best."""
    fitted = []

    class Watched(supervised.GBTClassifier):
        def fit(self, dataset, params=None):
            fitted.append(dataset.count())
            return super().fit(dataset, params)

    for module in (supervised, boosting):
        monkeypatch.setattr(module, "GBTClassifier", Watched)
    monkeypatch.setattr(supervised, "GROWN_FROM", 1000)
    supervised.tune(_rows_that_differ(spark, 1500), ["genre"], ["a", "c"], grid={"maxDepth": [3], "maxIter": [2]}, folds=2)
    assert fitted == [2]


def test_bins_are_cut_as_the_library_does(spark):
    """Thresholds of a tree of the library deep enough to use most of them are among ours."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor

    draw = np.random.default_rng(2)
    for values in (draw.normal(size=3000), draw.geometric(0.05, 3000).astype(float), draw.integers(0, 9, 500).astype(float), np.zeros(50)):
        rows = spark.createDataFrame([(float(v), float(np.sin(3 * v))) for v in values], "v double, label double")
        tree = DecisionTreeRegressor(maxDepth=10).fit(VectorAssembler(inputCols=["v"], outputCol="features").transform(rows))
        used = {float(x.split("<= ")[1].rstrip(")")) for x in tree.toDebugString.split("\n") if "<=" in x}
        own = boosting.cuts_of(values)
        assert len(own) == min(31, len(set(values)) - 1) or len(set(values)) > 32
        assert all(np.abs(own - u).min() < 1e-9 for u in used)


def test_missing_numbers_stop_a_grown_fit(spark, monkeypatch):
    monkeypatch.setattr(supervised, "GROWN_FROM", 1)
    gap = _rows_that_differ(spark, 800).withColumn("a", F.when(F.col("id") != 5, F.col("a")))
    with pytest.raises(Exception, match="missing|null"):
        supervised.tune(gap, ["genre"], ["a"], grid={"maxDepth": [2], "maxIter": [2]}, folds=2)


def test_sweep_of_counted_rows_is_that_of_the_forests(spark, planted, monkeypatch):
    """Columns that decide the type, partly, not at all, with gaps and of free text; no forest over rows is fitted."""
    n = F.col("id")
    rows = spark.range(6000).select(
        "id",
        F.when(n % 4 == 0, "SHOW").when(n % 41 == 1, "OTHER").otherwise("MOVIE").alias("type"),
        F.concat(F.lit("T"), n.cast("string")).alias("title"),
        F.when(n % 5 > 0, F.when(n % 4 == 0, "s").otherwise("m")).alias("gaps"),
        (n % 12).alias("twelve"),
        F.lit(None).cast("string").alias("empty"),
        F.lit(1.5).alias("constant"),
    )
    cols = ["title", "gaps", "twelve", "empty", "constant"]
    expected = {r["feature"]: r for r in supervised.feature_accuracy(rows, cols, buckets=64).collect()}
    monkeypatch.setattr(supervised, "COUNTED_FROM", 1)
    monkeypatch.setattr(supervised, "_one_feature", None)
    found = {r["feature"]: r for r in supervised.feature_accuracy(rows.repartition(5), cols, buckets=64).collect()}
    assert found.keys() == expected.keys()
    # Where a slot's labels are about as many each, the draws decide: by title, and for two of the twelve that share a slot.
    for c in cols:
        assert (found[c]["n_distinct"], found[c]["is_best"]) == (expected[c]["n_distinct"], expected[c]["is_best"])
        assert found[c]["accuracy"] == pytest.approx(expected[c]["accuracy"], abs=0.01 if c in ("title", "twelve") else 1e-12)
    with pytest.raises(ValueError, match="label is missing"):
        supervised.feature_accuracy(rows.withColumn("type", F.when(n > 5, F.col("type"))), ["constant"])


def test_tree_of_one_column_is_that_of_the_library(spark):
    from pyspark.ml.classification import DecisionTreeClassifier

    draw = np.random.default_rng(6)
    weights = draw.poisson(6, (9, 3)).astype(float) * draw.integers(1, 9, (9, 1))
    weights[2], weights[5, 1:] = 0, 0
    rows = [(float(y), Vectors.sparse(8, {i: 1.0} if i < 8 else {}), w) for i, own in enumerate(weights.tolist()) for y, w in enumerate(own) if w]
    tree = DecisionTreeClassifier(weightCol="w").fit(spark.createDataFrame(rows, ["label", "features", "w"]))
    shown = spark.createDataFrame([(i, Vectors.sparse(8, {i: 1.0} if i < 8 else {})) for i in range(9)], ["i", "features"])
    expected = [list(r["probability"]) for r in tree.transform(shown).orderBy("i").collect()]
    assert supervised._one_column_votes(weights).tolist() == [pytest.approx(x) for x in expected]
