"""Queries over features, models, metrics and clusters.

Where a closed form exists, SQL computes the same numbers; fitted models have none.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.models import clusters, features, metrics, supervised
from playbill.models.fits import written
from playbill.operators.ranking import stack
from playbill.plans import reports
from playbill.operators.clean import fill_median
from playbill.plans.registry import over_views, register, rounded
from playbill.plans.views import Tables

CATEGORIES = ["main_genre", "rating"]
NUMBERS = ["score", "second_score", "popularity", "runtime", "actor_count", "release_year"]
REG_NUMBERS = ["runtime", "release_year", "popularity", "actor_count", "second_score"]


def _filled(t: Tables) -> DataFrame:
    return supervised.fill_features(t.model_titles, CATEGORIES, NUMBERS)


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    return features.split(_filled(t), "id")


def _hot(vec: str) -> F.Column:
    """Slot of the single one in an indicator vector, -1 where all are zero."""
    return (F.array_position(vector_to_array(F.col(vec)), 1.0) - 1).cast("int")


# -- features ------------------------------------------------------------------

BRAND_INDEX = (
    "i AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS INT) AS slot "
    "FROM part GROUP BY 1)"
)

register(
    "m01_index",
    lambda t: features.index(t["part"], ["p_brand"]).select(
        "p_partkey", "p_brand", F.col("p_brand_index").cast("int").alias("slot")
    ),
    f"WITH {BRAND_INDEX} SELECT p_partkey, p_brand, slot FROM part JOIN i USING (p_brand)",
)
register(
    "m02_one_hot",
    lambda t: features.one_hot(features.index(t["part"], ["p_brand"]), ["p_brand"]).select(
        "p_partkey", F.size(vector_to_array("p_brand_vec")).alias("slots"), _hot("p_brand_vec").alias("hot")
    ),
    f"WITH {BRAND_INDEX} SELECT p_partkey, (SELECT CAST(count(*) AS INT) FROM i) AS slots, slot AS hot "
    "FROM part JOIN i USING (p_brand)",
)
register(
    "m03_assemble",
    lambda t: features.assemble(t["part"], ["p_size", "p_retailprice"]).select(
        "p_partkey",
        vector_to_array("features")[0].alias("first"),
        vector_to_array("features")[1].alias("second"),
    ),
    'SELECT p_partkey, CAST(p_size AS DOUBLE) AS "first", p_retailprice AS "second" FROM part',
)
register(
    "m04_standardise",
    lambda t: features.standardise(features.assemble(t["part"], ["p_retailprice"]), "features").select(
        "p_partkey", F.round(vector_to_array("scaled")[0], 6).alias("scaled")
    ),
    "SELECT p_partkey, round((p_retailprice - (SELECT avg(p_retailprice) FROM part)) "
    "/ (SELECT stddev_samp(p_retailprice) FROM part), 6) AS scaled FROM part",
)


def _split(t: Tables) -> DataFrame:
    train, test = features.split(t.catalog, "id", bucket=F.col("id") % 10 * 10)
    return stack([train.select("id", F.lit("train").alias("side")), test.select("id", F.lit("test").alias("side"))])


register(
    "m05_split",
    _split,
    over_views("SELECT id, CASE WHEN id % 10 < 7 THEN 'train' ELSE 'test' END AS side FROM catalog"),
)


def _feature_stages(t: Tables) -> DataFrame:
    rows = t.catalog.fillna({"rating": "No Data", "score": 0})
    model = features.feature_pipeline(["rating", "genres"], ["score", "release_year"], "type").fit(rows)
    vec = vector_to_array("features")
    n = F.size(vec)
    return model.transform(rows).select(
        "id",
        F.col("label").cast("int").alias("label"),
        _hot("rating_vec").alias("rating_slot"),
        _hot("genres_vec").alias("genre_slot"),
        n.alias("width"),
        F.element_at(vec, n - 1).alias("score"),
        F.element_at(vec, n).alias("release_year"),
    )


def _slots(col: str, name: str) -> str:
    return (
        f"{name} AS (SELECT {col}, CAST(row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS INT) AS slot_{name} "
        "FROM v GROUP BY 1)"
    )


register(
    "m06_feature_stages",
    _feature_stages,
    over_views(
        "WITH v AS (SELECT id, type, coalesce(rating, 'No Data') AS rating, genres, coalesce(score, 0) AS score, "
        f"release_year FROM catalog), {_slots('type', 'a')}, {_slots('rating', 'b')}, {_slots('genres', 'c')} "
        "SELECT id, slot_a AS label, slot_b AS rating_slot, slot_c AS genre_slot, "
        "CAST((SELECT count(*) FROM b) + (SELECT count(*) FROM c) + 2 AS INT) AS width, score, "
        "CAST(release_year AS DOUBLE) AS release_year "
        "FROM v JOIN a USING (type) JOIN b USING (rating) JOIN c USING (genres)"
    ),
)



def _width(df: DataFrame, col: str) -> int:
    """Slots of a vector column, from what its stages noted."""
    return int(df.schema[col].metadata["ml_attr"]["num_attrs"])


def _wide_labels(t: Tables) -> DataFrame:
    """Titles, a label each, beside few ratings: indexed, encoded and assembled."""
    rows = t.catalog.select("id", "title", "rating", "release_year")
    encoded = features.one_hot(features.index(rows, ["title", "rating"]), ["title", "rating"])
    whole = features.assemble(encoded, ["title_vec", "rating_vec", "release_year"])
    return whole.select(
        "id", F.col("title_index").cast("int").alias("title_slot"), F.col("rating_index").cast("int").alias("rating_slot"),
        F.lit(_width(whole, "features")).alias("width"),
    )


register(
    "m06_wide_labels",
    _wide_labels,
    over_views(
        """WITH a AS (SELECT title, row_number() OVER (ORDER BY count(*) DESC, title) - 1 AS s FROM catalog GROUP BY 1),
        b AS (SELECT rating, row_number() OVER (ORDER BY count(*) DESC, rating) - 1 AS s FROM catalog WHERE rating IS NOT NULL GROUP BY 1)
        SELECT id, CAST(a.s AS INT) AS title_slot, CAST(coalesce(b.s, (SELECT count(*) FROM b)) AS INT) AS rating_slot,
        CAST((SELECT count(*) FROM a) + (SELECT count(*) FROM b) + 1 AS INT) AS width
        FROM catalog JOIN a USING (title) LEFT JOIN b USING (rating)"""
    ),
)

# -- single-column sweeps ------------------------------------------------------

SWEPT = ["title", "release_year", "rating", "duration", "countries", "genres"]

register(
    "m07_feature_sweep",
    lambda t: rounded(supervised.feature_accuracy(t.catalog.filter("type <> 'OTHER'"), SWEPT), "accuracy"),
)

MAJORITY = ["rating", "genres", "countries", "release_year", "duration"]


def _majority_sql(col: str) -> str:
    v = f"coalesce(CAST({col} AS VARCHAR), '(null)')"
    return (
        f"SELECT '{col}' AS feature, round(avg(CASE WHEN c.type = coalesce(b.type, (SELECT type FROM top)) THEN "
        f"1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM (SELECT type, {v} AS v FROM catalog WHERE id % 10 >= 7) c "
        "LEFT JOIN (SELECT v, type FROM (SELECT v, type, row_number() OVER (PARTITION BY v ORDER BY n DESC, type) AS r "
        f"FROM (SELECT {v} AS v, type, count(*) AS n FROM catalog WHERE id % 10 < 7 GROUP BY 1, 2)) WHERE r = 1) b "
        "USING (v)"
    )


register(
    "m08_majority_sweep",
    lambda t: rounded(supervised.majority_accuracy(t.catalog, MAJORITY, in_train=F.col("id") % 10 < 7), "accuracy"),
    over_views(
        "WITH top AS (SELECT type FROM catalog WHERE id % 10 < 7 GROUP BY 1 ORDER BY count(*) DESC, type LIMIT 1) "
        + " UNION ALL ".join(_majority_sql(c) for c in MAJORITY)
    ),
)

# -- classifiers and regressors ------------------------------------------------


def _classifier(kind: str):
    def run(t: Tables) -> DataFrame:
        train, test = _sides(t)
        model = supervised.fit_classifier(train, kind, CATEGORIES, NUMBERS)
        return rounded(metrics.class_metrics(model.transform(test)), "accuracy", "f1")

    return run


def _regressor(kind: str):
    def run(t: Tables) -> DataFrame:
        known = t.model_titles.filter("score IS NOT NULL")
        train, test = features.split(supervised.fill_features(known, CATEGORIES, REG_NUMBERS), "id")
        model = supervised.fit_regressor(train, kind, CATEGORIES, REG_NUMBERS, "score")
        return rounded(supervised.score_regressor(model, test, "score"), "rmse", "mse", "r2")

    return run


register("m09_forest_classifier", _classifier("rf"))
register("m10_logistic", _classifier("lr"))
register("m11_boosted_classifier", _classifier("gbt"))
register(
    "m12_cross_validate",
    lambda t: rounded(supervised.tune(_sides(t)[0], CATEGORIES, NUMBERS)[1], "avg_f1"),
)


def _predictions(t: Tables) -> DataFrame:
    train, test = _sides(t)
    return supervised.score_table(supervised.fit_classifier(train, "gbt", CATEGORIES, NUMBERS), test)


register("m13_predict", _predictions)


def _one_feature_line(t: Tables) -> DataFrame:
    """Line of price by quantity, over the lines that have both, as SQL fits it."""
    known = t["lineitem"].na.drop(subset=["l_quantity", "l_extendedprice"])
    line = F.xxhash64("l_orderkey", "l_linenumber").alias("id")
    rows = known.select(line, "l_quantity", F.col("l_extendedprice").alias("price"))
    model = supervised.fit_regressor(rows, "lr", [], ["l_quantity"], "price")
    weights = supervised.coefficients(model, rows)
    quality = supervised.score_regressor(model, rows, "price").select(
        F.lit("(r2)").alias("feature"), F.col("r2").alias("weight")
    )
    return rounded(stack([weights, quality]), "weight", digits=4)


register(
    "m14_linear_regression",
    _one_feature_line,
    """SELECT 'l_quantity' AS feature, round(regr_slope(l_extendedprice, l_quantity), 4) AS weight FROM lineitem
    UNION ALL SELECT '(intercept)', round(regr_intercept(l_extendedprice, l_quantity), 4) FROM lineitem
    UNION ALL SELECT '(r2)', round(regr_r2(l_extendedprice, l_quantity), 4) FROM lineitem""",
)
register("m14_linear_regression_full", _regressor("lr"))
register("m15_forest_regressor", _regressor("rf"))
register("m16_boosted_regressor", _regressor("gbt"))


def _importance(t: Tables) -> DataFrame:
    known = t.model_titles.filter("score IS NOT NULL")
    train, _ = features.split(supervised.fill_features(known, CATEGORIES, REG_NUMBERS), "id")
    parts = []
    for kind in ("rf", "gbt"):
        model = supervised.fit_regressor(train, kind, CATEGORIES, REG_NUMBERS, "score")
        parts.append(supervised.importances(model, train).withColumn("model", F.lit(kind)))
    return rounded(stack(parts), "importance")


register("m17_importance", _importance)


def _no_gaps(t: Tables) -> DataFrame:
    """All titles, gaps in their numbers filled by the median, as the clusters need them."""
    return fill_median(written(t.model_titles, "titles"), NUMBERS)


register("m18_kmeans", lambda t: clusters.cluster(_no_gaps(t), NUMBERS, keep=("id", "title", "type", "main_genre")))
register("m19_silhouette_sweep", lambda t: rounded(clusters.k_sweep(_no_gaps(t), NUMBERS), "silhouette"))

# -- fits whose outcome is known ------------------------------------------------


def _marked(t: Tables) -> DataFrame:
    """Orders with two small numbers, a label that the first decides, and a linear target."""
    a, b = F.col("o_custkey") % 10, F.col("o_orderkey") % 7
    return t["orders"].select(
        F.col("o_orderkey").alias("id"), a.cast("double").alias("a"), b.cast("double").alias("b"),
        F.when(a >= 5, "high").otherwise("low").alias("type"), (2 * a + 3 * b + 1).cast("double").alias("target"),
        (1000 * (F.col("o_custkey") % 3) + b).cast("double").alias("spot"),
    )


def _sure(kind: str):
    def run(t: Tables) -> DataFrame:
        train, test = features.split(_marked(t), "id", bucket=F.col("id") % 100)
        model = supervised.fit_classifier(train, kind, [], ["a", "b"])
        shown = supervised.score_table(model, test, ["type"])
        right = F.count_if(F.col("label") == F.col("prediction")).alias("right")
        return shown.groupBy("type").agg(F.count(F.lit(1)).alias("count"), right)

    return run


SURE_SQL = """SELECT CASE WHEN o_custkey % 10 >= 5 THEN 'high' ELSE 'low' END AS type, count(*) AS "count",
count(*) AS "right" FROM orders WHERE o_orderkey % 100 >= 70 GROUP BY 1"""
register("m09_forest_classifier_sure", _sure("rf"), SURE_SQL)
register("m10_logistic_sure", _sure("lr"), SURE_SQL)
register("m11_boosted_classifier_sure", _sure("gbt"), SURE_SQL)


def _exact_line(t: Tables) -> DataFrame:
    model = supervised.fit_regressor(_marked(t), "lr", [], ["a", "b"], "target")
    return supervised.coefficients(model, _marked(t)).select("feature", F.round("weight", 4).alias("weight"))


register(
    "m14_linear_regression_exact",
    _exact_line,
    "SELECT * FROM (VALUES ('a', 2.0::DOUBLE), ('b', 3.0::DOUBLE), ('(intercept)', 1.0::DOUBLE)) AS w(feature, weight)",
)


def _apart(t: Tables) -> DataFrame:
    found = clusters.cluster(_marked(t), ["spot"], k=3)
    sizes = found.groupBy("prediction").agg(F.min("spot").alias("lo"), F.max("spot").alias("hi"), F.count(F.lit(1)).alias("size"))
    return sizes.drop("prediction")


register(
    "m18_kmeans_apart",
    _apart,
    """SELECT CAST(min(1000 * (o_custkey % 3) + o_orderkey % 7) AS DOUBLE) AS lo,
    CAST(max(1000 * (o_custkey % 3) + o_orderkey % 7) AS DOUBLE) AS hi, count(*) AS size FROM orders GROUP BY o_custkey % 3""",
)
register(
    "m19_silhouette_sweep_apart",
    lambda t: clusters.k_sweep(_marked(t), ["spot"], ks=range(2, 6)).select("k", "is_best"),
    "SELECT CAST(unnest(range(2, 6)) AS INT) AS k, unnest(range(2, 6)) = 3 AS is_best",
)


def _sweep_marked(t: Tables) -> DataFrame:
    named = _marked(t).withColumns({"same": F.col("type"), "constant": F.lit("x")})
    swept = supervised.feature_accuracy(named, ["same", "constant"])
    return swept.select("feature", "n_distinct", (F.round("accuracy", 6) == 1).alias("perfect"), "is_best")


register(
    "m07_feature_sweep_marked",
    _sweep_marked,
    "SELECT * FROM (VALUES ('same', 2::BIGINT, true, true), ('constant', 1::BIGINT, false, false)) AS w(feature, n_distinct, perfect, is_best)",
)

# -- metrics -------------------------------------------------------------------

register(
    "m20_class_metrics",
    lambda t: rounded(
        metrics.class_metrics(
            t["lineitem"].select(
                F.expr("CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END").alias("label"),
                F.expr("CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END").alias("prediction"),
            )
        ),
        "accuracy",
        "f1",
    ),
    """WITH p AS (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y,
    CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS q FROM lineitem),
    k AS (SELECT unnest([0, 1, 2]) AS k),
    c AS (SELECT k, count(*) FILTER (y = k) AS ny, count(*) FILTER (q = k) AS nq,
    count(*) FILTER (y = k AND q = k) AS tp, count(*) AS n FROM p, k GROUP BY 1)
    SELECT round(sum(tp) / CAST(max(n) AS DOUBLE), 6) AS accuracy,
    round(sum(ny * coalesce(CAST(2 * tp AS DOUBLE) / nullif(ny + nq, 0), 0)) / max(n), 6) AS f1 FROM c""",
)
register(
    "m21_reg_metrics",
    lambda t: metrics.reg_metrics(
        t["lineitem"].select(F.col("l_extendedprice").alias("label"), (1000 * F.col("l_quantity")).alias("prediction"))
    ).select(F.round("rmse", 4).alias("rmse"), F.round("mse", 2).alias("mse"), F.round("r2", 6).alias("r2")),
    """WITH s AS (SELECT avg((l_extendedprice - 1000 * l_quantity) ** 2) AS mse, var_pop(l_extendedprice) AS var
    FROM lineitem) SELECT round(sqrt(mse), 4) AS rmse, round(mse, 2) AS mse, round(1 - mse / var, 6) AS r2 FROM s""",
)
BANDS = "CASE WHEN value < 20 THEN 0 WHEN value < 60 THEN 1 ELSE 2 END"
register(
    "m22_silhouette",
    lambda t: rounded(
        metrics.silhouette(t["events"].select("value", F.expr(BANDS).alias("prediction")), ["value"]), "silhouette"
    ),
    f"""WITH v AS (SELECT event_id, value AS x, {BANDS} AS c FROM events),
    g AS (SELECT c, count(*) AS n, sum(x) AS s, sum(x * x) AS q FROM v GROUP BY 1),
    d AS (SELECT v.event_id, v.c = g.c AS own, (n * x * x - 2 * x * s + q) / CASE WHEN v.c = g.c THEN n - 1 ELSE n END AS m
    FROM v, g),
    e AS (SELECT event_id, min(m) FILTER (own) AS a, min(m) FILTER (NOT own) AS b FROM d GROUP BY 1)
    SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM e""",
)
register(
    "m23_cluster_profile",
    lambda t: rounded(
        clusters.cluster_profile(
            t["events"].select("value", "user_id", F.expr(BANDS).alias("prediction")),
            ["value", "user_id"],
            rescale={"user_id": (0, 10)},
        ),
        "avg_value",
        "avg_user_id",
        "user_id_rescaled",
    ),
    f"""SELECT {BANDS} AS prediction, count(*) AS size, round(avg(value), 6) AS avg_value,
    round(avg(user_id), 6) AS avg_user_id, round(avg(user_id) / 10, 6) AS user_id_rescaled FROM events GROUP BY 1""",
)


def _model_rows(classifiers: DataFrame, regressors: DataFrame, digits: int = 6) -> DataFrame:
    """(model, metric, value) of two comparison tables."""
    parts = [df.select("model", F.lit(m).alias("metric"), F.col(m).alias("value")) for df, ms in ((classifiers, ("accuracy", "f1")), (regressors, ("rmse", "r2"))) for m in ms]
    return rounded(stack(parts), "value", digits=digits)


def _model_table(t: Tables) -> DataFrame:
    titles = written(t.model_titles, "titles")
    scored = supervised.compare_classifiers(titles, CATEGORIES, NUMBERS)
    return _model_rows(scored, supervised.compare_regressors(titles, CATEGORIES, REG_NUMBERS, "score"))


register("m24_model_table", _model_table)


def _report_rows(tables: dict[str, DataFrame], names: dict[str, tuple[list[str], list[str]]], digits: int = 6) -> DataFrame:
    """(table, item, metric, value): a row for each number of each table; ``names`` lists its key and value columns."""
    parts = []
    for name, (keys, values) in names.items():
        item = F.concat_ws(" ", *[F.coalesce(F.col(k).cast("string"), F.lit("(null)")) for k in keys])
        cells = F.inline(F.array(*[F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("value")) for v in values]))
        parts.append(tables[name].select(F.lit(name).alias("table"), item.alias("item"), cells))
    return rounded(stack(parts), "value", digits=digits)


REPORT_PARTS = {
    "k_sweep": (["k"], ["silhouette", "is_best"]),
    "clusters": (["id"], ["prediction"]),
    "cluster_profile": (["prediction"], ["size", *(f"avg_{c}" for c in ["score", *REG_NUMBERS])]),
    "classifiers": (["model"], ["accuracy", "f1"]),
    "grid": (["maxDepth", "maxIter"], ["avg_f1", "is_best"]),
    "predictions": (["id"], ["label", "prediction"]),
    "regressors": (["model"], ["rmse", "r2"]),
    "coefficients": (["feature"], ["weight"]),
    "forest_importance": (["feature"], ["importance"]),
    "boosted_importance": (["feature"], ["importance"]),
}
register(
    "r06_model_report",
    lambda t: _report_rows(reports.model_report(written(t.model_titles, "titles"), CATEGORIES, REG_NUMBERS, "score"), REPORT_PARTS),
)

# -- the same over orders whose outcome is known ---------------------------------


def _known(t: Tables) -> DataFrame:
    """Orders whose type and score follow from a part, one of three."""
    part = F.col("o_custkey") % 3
    return t["orders"].select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("title"),
        F.concat(F.lit("p"), part.cast("string")).alias("part"), F.when(part == 0, "low").otherwise("high").alias("type"),
        (1000.0 * part).alias("score"), (F.col("o_custkey") % 10).cast("double").alias("a"),
        (F.col("o_orderkey") % 7).cast("double").alias("b"),
        F.when(F.col("o_custkey") % 10 >= 5, 40.0).otherwise(10.0).alias("step"),
    )


GRID_SQL = "unnest([5, 5, 10, 10, 15, 15]) AS d, unnest([10, 20, 10, 20, 10, 20]) AS r"
register(
    "m12_cross_validate_sure",
    lambda t: rounded(supervised.tune(_marked(t), [], ["a", "b"])[1], "avg_f1"),
    f"""SELECT CAST(d AS INT) AS "maxDepth", CAST(r AS INT) AS "maxIter", (SELECT count(*) / count(*) FROM orders) AS avg_f1,
    d = 5 AND r = 10 AS is_best FROM (SELECT {GRID_SQL})""",
)


def _sure_predictions(t: Tables) -> DataFrame:
    train, test = features.split(_known(t), "id", bucket=F.col("id") % 100)
    return supervised.score_table(supervised.fit_classifier(train, "gbt", ["part"], ["a", "b"]), test)


register(
    "m13_predict_sure",
    _sure_predictions,
    """WITH o AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 3 = 0 THEN 'low' ELSE 'high' END AS type FROM orders),
    n AS (SELECT type, CAST(row_number() OVER (ORDER BY count(*) DESC, type) - 1 AS DOUBLE) AS label FROM o WHERE id % 100 < 70 GROUP BY 1)
    SELECT id, 'T' || id AS title, type, label, label AS prediction FROM o JOIN n USING (type) WHERE id % 100 >= 70""",
)


def _step(kind: str):
    def run(t: Tables) -> DataFrame:
        train, test = features.split(_known(t), "id", bucket=F.col("id") % 100)
        model = supervised.fit_regressor(train, kind, [], ["a"], "step")
        shown = model.transform(test).select("id", "step", "prediction")
        return rounded(shown, "prediction")

    return run


STEP_SQL = """SELECT o_orderkey AS id, CASE WHEN o_custkey % 10 >= 5 THEN 40.0::DOUBLE ELSE 10 END AS step,
CASE WHEN o_custkey % 10 >= 5 THEN 40.0::DOUBLE ELSE 10 END AS prediction FROM orders WHERE o_orderkey % 100 >= 70"""
register("m15_forest_regressor_step", _step("rf"), STEP_SQL)
register("m16_boosted_regressor_step", _step("gbt"), STEP_SQL)
register("m14_linear_regression_step", lambda t: rounded(supervised.score_regressor(
    supervised.fit_regressor(_known(t), "lr", ["part"], [], "score"), _known(t), "score"), "rmse", "mse", "r2", digits=3),
    "SELECT 0.0::DOUBLE AS rmse, 0.0::DOUBLE AS mse, (SELECT count(*) / count(*) FROM orders) AS r2")


def _step_importance(t: Tables) -> DataFrame:
    rows = _known(t)
    parts = [
        supervised.importances(supervised.fit_regressor(rows, kind, [], cols, "step"), rows).withColumn("model", F.lit(kind))
        for kind, cols in (("rf", ["a"]), ("gbt", ["a", "b"]))
    ]
    return rounded(stack(parts), "importance")


register(
    "m17_importance_step",
    _step_importance,
    "SELECT * FROM (VALUES ('a', 1.0::DOUBLE, 'rf'), ('a', 1.0::DOUBLE, 'gbt'), ('b', 0.0::DOUBLE, 'gbt')) AS w(feature, importance, model)",
)
SURE_ROWS = """(VALUES ('Random Forest', 'accuracy', 1.0::DOUBLE), ('Random Forest', 'f1', 1), ('Logistic Regression', 'accuracy', 1),
('Logistic Regression', 'f1', 1), ('GBT', 'accuracy', 1), ('GBT', 'f1', 1), ('GBT (tuned)', 'accuracy', 1), ('GBT (tuned)', 'f1', 1),
('Linear Regression', 'rmse', 0), ('Linear Regression', 'r2', 1), ('GBT', 'rmse', 0), ('GBT', 'r2', 1)) AS w(model, metric, value)"""
register(
    "m24_model_table_sure",
    lambda t: _model_rows(
        supervised.compare_classifiers(_known(t), ["part"], ["a"]),
        supervised.compare_regressors(_known(t), ["part"], [], "score", kinds=("lr", "gbt")),
        digits=3,
    ),
    f"SELECT * FROM {SURE_ROWS}",
)


def _sure_report(t: Tables) -> DataFrame:
    tables = reports.model_report(_known(t), ["part"], [], "score", k=3)
    sizes = tables["cluster_profile"].select(F.col("avg_score").alias("spot"), "size")
    known = {
        "k_sweep": tables["k_sweep"].filter("is_best AND k <= 3"),
        "cluster_profile": sizes,
        "classifiers": tables["classifiers"],
        "grid": tables["grid"],
        "predictions": tables["predictions"].groupBy("type").agg(F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("right")),
        "regressors": tables["regressors"].filter("model <> 'Random Forest'"),
    }
    parts = REPORT_PARTS | {"cluster_profile": (["spot"], ["size"]), "predictions": (["type"], ["right"])}
    return _report_rows(known, {n: parts[n] for n in known}, digits=3)


register(
    "r06_model_report_sure",
    _sure_report,
    f"""WITH s AS (SELECT * FROM {SURE_ROWS}), g AS (SELECT {GRID_SQL}), o AS (SELECT o_custkey % 3 AS part FROM orders)
    SELECT 'k_sweep' AS "table", '3' AS item, unnest(['silhouette', 'is_best']) AS metric, 1.0::DOUBLE AS value
    UNION ALL SELECT 'cluster_profile', (1000 * part) || '.0', 'size', count(*) FROM o GROUP BY part
    UNION ALL SELECT CASE WHEN metric IN ('accuracy', 'f1') THEN 'classifiers' ELSE 'regressors' END, model, metric, value FROM s
    UNION ALL SELECT 'grid', d || ' ' || r, 'avg_f1', 1 FROM g
    UNION ALL SELECT 'grid', d || ' ' || r, 'is_best', CASE WHEN d = 5 AND r = 10 THEN 1 ELSE 0 END FROM g
    UNION ALL SELECT DISTINCT 'predictions', CASE WHEN part = 0 THEN 'low' ELSE 'high' END, 'right', 1 FROM o""",
)
