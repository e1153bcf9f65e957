"""Classifiers and regressors: fits, tuning, scores, importances, comparison tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import ExitStack, contextmanager
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, StringIndexer, VectorSlicer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.functions.text import NO_DATA
from playbill.models.boosting import GROWN_FROM, GROWN_MOST, Bins, binning, cells_by_rounds, fit_model, sampled
from playbill.models.features import feature_stages, split
from playbill.models.fits import PARALLEL_FITS, WEIGHT, few_kinds, fit_each, held, kept, weighted
from playbill.models.metrics import class_metrics, reg_metrics
from playbill.operators.profile import distinct_count
from playbill.operators.ranking import mark_best
from playbill.session import ensure_checkpoint_dir, scratch_path

# fixed values: model names as shown in comparison tables
MODEL_NAMES = {"lr": "Logistic Regression", "rf": "Random Forest", "gbt": "GBT"}
REGRESSOR_NAMES = {**MODEL_NAMES, "lr": "Linear Regression"}


def fill_features(df: DataFrame, cat: Sequence[str], num: Sequence[str]) -> DataFrame:
    """Missing text to ``No Data``, missing numbers to 0, so rows survive assembly."""
    return df.na.fill(NO_DATA, subset=list(cat)).na.fill(0, subset=list(num))


def classifier(kind: str, seed: int = 42, **params):
    """Unfitted classifier: 20 trees, 100 iterations, or 20 boosting rounds (two classes only)."""
    makers = {
        "rf": lambda: RandomForestClassifier(seed=seed, **{"numTrees": 20, **params}),
        "lr": lambda: LogisticRegression(**{"maxIter": 100, **params}),
        "gbt": lambda: GBTClassifier(seed=seed, **{"maxIter": 20, **params}),
    }
    return makers[kind]()


def regressor(kind: str, seed: int = 42, **params):
    """Unfitted regressor: linear, 20 trees, or 20 boosting rounds."""
    makers = {
        "lr": lambda: LinearRegression(**params),
        "rf": lambda: RandomForestRegressor(seed=seed, **{"numTrees": 20, **params}),
        "gbt": lambda: GBTRegressor(seed=seed, **{"maxIter": 20, **params}),
    }
    return makers[kind]()


def _two_classes(df: DataFrame, label: str) -> None:
    if df.select(label).distinct().limit(3).count() != 2:
        raise ValueError(f"boosted trees separate exactly two values of {label}")


@contextmanager
def encoded(
    train: DataFrame, stages: Sequence, keep: Sequence[str] = (), like: Sequence[str] = ()
) -> Iterator[tuple[PipelineModel, DataFrame]]:
    """Feature stages fitted on ``train``, and its rows as vectors, worked out once for all fits in the block.

    With ``like``, the columns that the stages read, rows that agree in them may be one, with a ``WEIGHT``.
    """
    model = Pipeline(stages=list(stages)).fit(train)
    known, more = (weighted(train, like), [WEIGHT]) if like else (train, [])
    with kept(model.transform(known).select("label", "features", *keep, *more)) as rows:
        yield model, rows


def _whole(encoder: PipelineModel, fitted: Model) -> PipelineModel:
    """Feature stages and a learner fitted on their vectors as one model."""
    return PipelineModel(stages=[*encoder.stages, without_summary(fitted)])


def without_summary(model: Model) -> Model:
    """The same model without the summary of its training.

    The summary holds on to the session, which goes to the tasks with a model that
    predicts and cannot be written once a table of the session was observed.
    """
    if not getattr(model, "hasSummary", False):
        return model
    bare = model.copy()
    if not bare.hasSummary:
        return bare
    # Copies of some models keep it; what is saved and loaded has none.
    path = scratch_path(SparkSession.active(), "model")
    model.write().save(path)
    return type(model).load(path)


def fit_classifier(
    train: DataFrame, kind: str, cat: Sequence[str], num: Sequence[str], label: str = "type", seed: int = 42,
    key: str = "id", **params,
) -> PipelineModel:
    """Features and classifier fitted on training rows; the same model for any layout of the rows."""
    with held(train.select(key, label, *cat, *num), key) as rows:
        return fit_classifiers(rows, [kind], cat, num, label, seed, **params)[kind]


def fit_classifiers(
    rows: DataFrame, kinds: Sequence[str], cat: Sequence[str], num: Sequence[str], label: str = "type",
    seed: int = 42, parallelism: int = PARALLEL_FITS, **params,
) -> dict[str, PipelineModel]:
    """One model per kind, all fitted on the same vectors of rows that lie in order."""
    if "gbt" in kinds:
        _two_classes(rows, label)
        ensure_checkpoint_dir(rows.sparkSession)
    with encoded(rows, feature_stages(cat, num, label)) as (encoder, vectors):

        def fit(kind: str) -> PipelineModel:
            return _whole(encoder, classifier(kind, seed, **params).fit(vectors))

        return dict(zip(kinds, fit_each(rows.sparkSession, fit, kinds, parallelism)))


def fit_regressor(
    train: DataFrame, kind: str, cat: Sequence[str], num: Sequence[str], target: str, seed: int = 42,
    key: str = "id", **params,
) -> PipelineModel:
    """Features and regressor fitted on the training rows that have a target; the same for any layout."""
    with held(_with_target(train.select(key, target, *cat, *num), target), key) as rows:
        return fit_regressors(rows, [kind], cat, num, seed, **params)[kind]


def fit_regressors(
    rows: DataFrame, kinds: Sequence[str], cat: Sequence[str], num: Sequence[str], seed: int = 42,
    parallelism: int = PARALLEL_FITS, **params,
) -> dict[str, PipelineModel]:
    """One model per kind, all fitted on the same vectors of rows that lie in order and have a label."""
    if "gbt" in kinds:
        ensure_checkpoint_dir(rows.sparkSession)
    with encoded(rows, feature_stages(cat, num)) as (encoder, vectors):

        def fit(kind: str) -> PipelineModel:
            return _whole(encoder, regressor(kind, seed, **params).fit(vectors))

        return dict(zip(kinds, fit_each(rows.sparkSession, fit, kinds, parallelism)))


def _with_target(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target).isNotNull()).withColumn("label", F.col(target).cast("double"))


def score_regressor(model: Model, test: DataFrame, target: str) -> DataFrame:
    """RMSE, MSE and R2 on test rows that have a target."""
    return reg_metrics(model.transform(_with_target(test, target)))


# fixed values: depths and boosting rounds to try
GRID = {"maxDepth": [5, 10, 15], "maxIter": [10, 20]}


def tune(
    train: DataFrame, cat: Sequence[str], num: Sequence[str], label: str = "type", key: str = "id",
    grid: Mapping[str, Sequence] | None = None, folds: int = 3, seed: int = 42, parallelism: int = PARALLEL_FITS,
) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees tuned by cross-validated F1: the model and one row per combination.

    Folds come from a hash of the key, so they do not move with the data layout. Each fold
    is encoded once for the whole grid, rows of few kinds as one row of each with a weight. Rounds of boosting are nested: the
    first ten trees of twenty are those of a fit of ten, so each depth is fitted
    once per fold, with the most rounds, and scored at all of them.
    """
    with held(train.select(key, label, *cat, *num), key) as rows:
        return _tune(rows, cat, num, label, key, grid, folds, seed, parallelism)


def _tune(train, cat, num, label, key, grid=None, folds=3, seed=42, parallelism=PARALLEL_FITS):
    _two_classes(train, label)
    ensure_checkpoint_dir(train.sparkSession)
    grid = dict(grid or GRID)
    rounds = [int(n) for n in grid.get("maxIter", [20])]
    others = [name for name in grid if name != "maxIter"]
    fits = [dict(zip(others, values)) for values in product(*(grid[n] for n in others))]
    stages, cols = feature_stages(cat, num, label), list(dict.fromkeys([label, *cat, *num]))
    fold = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(folds)).cast("int")
    grown = _tune_grown(train.withColumn("__fold", fold), stages, cat, num, key, cols, fits, rounds, folds, seed)
    if grown:
        scores, finish = grown
        return _best_of(scores, grid, others, rounds, folds, train.sparkSession, finish)
    # The longest fits go first, so that none is left to run alone.
    tasks = sorted(product(range(folds), fits), key=lambda task: -task[1].get("maxDepth", 5))
    with ExitStack() as held_folds:
        sides = []
        for f in range(folds):
            encoder, vectors = held_folds.enter_context(encoded(train.filter(fold != f), stages, like=cols))
            test = encoder.transform(weighted(train.filter(fold == f), cols)).select("label", "features", WEIGHT)
            sides.append((vectors, held_folds.enter_context(kept(test))))

        def score(task: tuple[int, dict]) -> list[float]:
            vectors, test = sides[task[0]]
            boosted = GBTClassifier(seed=seed, maxIter=max(rounds), weightCol=WEIGHT, **task[1])
            return f1_by_rounds(boosted.fit(vectors), test, rounds)

        found = fit_each(train.sparkSession, score, tasks, parallelism)
    scores: dict[tuple, list[float]] = {}
    for (_, params), values in sorted(zip(tasks, found), key=lambda x: x[0][0]):
        for n, f1 in zip(rounds, values):
            scores.setdefault((*params.values(), n), []).append(f1)

    def fit(params: dict) -> PipelineModel:
        with encoded(train, stages, like=cols) as (encoder, vectors):
            return _whole(encoder, GBTClassifier(seed=seed, weightCol=WEIGHT, **params).fit(vectors))

    return _best_of(scores, grid, others, rounds, folds, train.sparkSession, fit)


def _best_of(scores, grid, others, rounds, folds, spark, fit):
    """The model of the best combination, and the table of all."""
    names = [*others, "maxIter"]
    means = {combo: sum(values) / folds for combo, values in scores.items()}
    ordered = sorted(means, key=lambda combo: [list(grid.get(n, rounds)).index(v) for n, v in zip(names, combo)])
    best = max(ordered, key=lambda combo: means[combo])
    schema = ", ".join([f"{n} int" for n in names] + ["avg_f1 double", "is_best boolean"])
    rows = [(*(int(v) for v in combo), means[combo], combo == best) for combo in ordered]
    return fit(dict(zip(names, best))), spark.createDataFrame(rows, schema)


def _tune_grown(train, stages, cat, num, key, cols, fits, rounds, folds, seed):
    """Scores of the grid with each fit grown in a task of its own, and how to fit the best; none where that does not apply."""
    if any(set(params) != {"maxDepth"} for params in fits):
        return None
    few, total = few_kinds(train, cols)
    if few or not GROWN_FROM <= total <= GROWN_MOST:
        return None
    sample = sampled(train, key, cols, num, total)
    spots = sample.column("__fold").to_numpy()

    def binned(f: int | None) -> tuple[PipelineModel, DataFrame, Bins | None]:
        encoder = Pipeline(stages=list(stages)).fit(train if f is None else train.filter(F.col("__fold") != f))
        rows = encoder.transform(train).withColumn("__test", F.col("__fold") == (-1 if f is None else f))
        return encoder, rows, binning(encoder, cat, num, sample if f is None else sample.filter(pa.array(spots != f)))

    sides = [binned(f)[1:] for f in range(folds)]
    if any(bins is None for _, bins in sides):
        return None
    # The longest fits go first.
    tasks = sorted(((f, int(params["maxDepth"])) for f in range(folds) for params in fits), key=lambda task: (-task[1], task[0]))
    cells = cells_by_rounds(sides, tasks, rounds)
    scores: dict[tuple, list[float]] = {}
    for (_, depth), found in sorted(cells.items()):
        for n, counts in zip(rounds, found):
            scores.setdefault((depth, n), []).append(_weighted_f1(counts))

    def fit(params: dict) -> PipelineModel:
        encoder, rows, bins = binned(None)
        return _whole(encoder, fit_model(rows, bins, params, seed))

    return scores, fit


def f1_by_rounds(model: GBTClassificationModel, test: DataFrame, rounds: Sequence[int]) -> list[float]:
    """Weighted F1 on ``test`` of the first trees of a boosted model, for several numbers of trees, in one pass.

    A row of ``test`` stands for as many as its ``WEIGHT``, if it has one.
    """
    shown, margin = test, F.lit(0.0)
    rows = F.col(WEIGHT) if WEIGHT in test.columns else F.lit(1)
    columns = {}
    for i, (tree, weight) in enumerate(zip(model.trees, model.treeWeights), 1):
        name = f"__tree{i}"
        shown = tree.copy().setPredictionCol(name).transform(shown)
        margin = margin + F.lit(float(weight)) * F.col(name)
        if i in rounds:
            columns[i] = margin
    marked = shown.select("label", rows.alias("rows"), *[F.when(m > 0, 1.0).otherwise(0.0).alias(f"p{n}") for n, m in columns.items()])
    cells = marked.groupBy("label", *[f"p{n}" for n in columns]).agg(F.sum("rows").cast("long").alias("rows")).collect()
    found = []
    for n in rounds:
        counts: dict[tuple[float, float], int] = {}
        for r in cells:
            at = r["label"], r[f"p{n}"]
            counts[at] = counts.get(at, 0) + r["rows"]
        found.append(_weighted_f1(counts))
    return found


def _weighted_f1(cells: Mapping[tuple[float, float], int]) -> float:
    """F1 of each class weighted by its size, from counts of (label, prediction)."""
    total, out = sum(cells.values()), 0.0
    for c in {y for y, _ in cells}:
        actual = sum(n for (y, _), n in cells.items() if y == c)
        predicted = sum(n for (_, p), n in cells.items() if p == c)
        out += 2 * cells.get((c, c), 0) / (actual + predicted) * actual / total
    return out


def score_table(model: Model, df: DataFrame, keep: Sequence[str] = ("id", "title", "type")) -> DataFrame:
    """Rows with their label and prediction."""
    return model.transform(df).select(*keep, "label", "prediction")


def slot_names(model: PipelineModel, df: DataFrame, features: str = "features") -> list[str]:
    """Name of every vector slot, read from the column the model builds."""
    attrs = model.transform(df.limit(0)).schema[features].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for kind in attrs.values() for a in kind)
    return [name for _, name in slots]


def _slots(df: DataFrame, names: Sequence[str], values, name: str, value: str) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, values, strict=True)]
    return df.sparkSession.createDataFrame(rows, f"{name} string, {value} double")


def importances(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Feature slots with their weight, heaviest first."""
    weights = model.stages[-1].featureImportances.toArray()
    table = _slots(df, slot_names(model, df), weights, "feature", "importance")
    return table.orderBy(F.desc("importance"), "feature")


def coefficients(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Linear weights by slot name, and the intercept."""
    fitted = model.stages[-1]
    names = [*slot_names(model, df), "(intercept)"]
    return _slots(df, names, [*fitted.coefficients.toArray(), fitted.intercept], "feature", "weight")


# Rows from which a sweep counts like rows; below, its forests draw row by row as the library does.
COUNTED_FROM = 300_000
_SWEPT = "feature string, n_distinct long, accuracy double"


def feature_accuracy(
    df: DataFrame,
    cols: Sequence[str],
    label: str = "type",
    key: str = "id",
    trees: int = 20,
    seed: int = 42,
    buckets: int = 512,
    parallelism: int = PARALLEL_FITS,
) -> DataFrame:
    """Test accuracy of a forest on each single column, best one flagged.

    Values are hashed into ``buckets`` slots, the same for every column, so free
    text is scored like a category and no list of values is kept. In tables of
    ``COUNTED_FROM`` rows or more, rows of one slot and label are counted first, and each tree
    draws how often it takes rows of a kind: one pass over the rows for all columns.
    """
    if df.count() >= COUNTED_FROM:
        results = _counted_sweep(df, cols, label, key, trees, seed, buckets)
        return mark_best(df.sparkSession.createDataFrame(results, _SWEPT), "accuracy")
    with held(df.select(key, label, *[F.col(c).cast("string").alias(c) for c in cols]), key) as rows:
        counts = {r["column"]: r["n_distinct"] for r in distinct_count(rows, cols).collect()}
        train, test = split(rows, key, 0.7, seed)

        def score(c: str) -> tuple[str, int, float]:
            return c, counts[c], _one_feature(train, test, c, label, trees, seed, buckets)

        results = fit_each(df.sparkSession, score, cols, parallelism)
    return mark_best(df.sparkSession.createDataFrame(results, _SWEPT), "accuracy")


def _counted_sweep(df, cols, label, key, trees, seed, buckets) -> list[tuple[str, int, float]]:
    """(column, different values, test accuracy) of each column, from counts of (slot, label, side)."""
    rows = df.select(key, label, *[F.col(c).cast("string").alias(c) for c in cols])
    distinct = {r["column"]: r["n_distinct"] for r in distinct_count(rows, cols).collect()}
    in_train = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(100)) < 70
    hashed, slots = rows, []
    for i, c in enumerate(cols):
        hasher = FeatureHasher(inputCols=[c], outputCol=f"__h{i}", numFeatures=buckets, categoricalCols=[c])
        hashed = hasher.transform(hashed)
        # A gap has no slot.
        slots.append(F.struct(F.lit(i).alias("col"), F.get(F.unwrap_udt(f"__h{i}")["indices"], F.lit(0)).alias("slot")))
    cells = hashed.select(F.col(label).alias("label"), in_train.alias("train"), F.inline(F.array(*slots)))
    counted = cells.groupBy("col", "slot", "label", "train").agg(F.count(F.lit(1)).alias("n")).collect()
    return [(c, distinct[c], _forest_accuracy([r for r in counted if r["col"] == i], trees, seed)) for i, c in enumerate(cols)]


def _forest_accuracy(cells: Sequence, trees: int, seed: int) -> float | None:
    """Test accuracy of a forest of one column, from counts of (slot, label, train).

    Each of n like rows is taken as often as a Poisson draw of mean 1 says, so all of
    them as often as one of mean n.
    """
    sizes: dict = {}
    for r in cells:
        if r["label"] is None:
            raise ValueError("a label is missing")
        if r["train"]:
            sizes[r["label"]] = sizes.get(r["label"], 0) + r["n"]
    labels = {y: i for i, y in enumerate(sorted(sizes, key=lambda y: (-sizes[y], y)))}
    if any(r["label"] not in labels for r in cells):
        raise ValueError("a label of the test rows is not among the training rows")
    used = {s: i for i, s in enumerate(sorted({r["slot"] for r in cells if r["train"] and r["slot"] is not None}))}
    # The place after all slots is that of rows without one, or with one not trained on.
    kinds = {(used.get(r["slot"], len(used)), r["label"]): 0 for r in cells}
    train, test = dict(kinds), dict(kinds)
    for r in cells:
        side = train if r["train"] else test
        side[used.get(r["slot"], len(used)), r["label"]] += r["n"]
    counts = np.zeros((len(used) + 1, len(labels)), np.int64)
    for (place, y), n in train.items():
        counts[place, labels[y]] = n
    draws = np.random.default_rng(seed).poisson(counts, (trees, *counts.shape))
    predicted = sum(map(_one_column_votes, draws.astype(np.float64))).argmax(1)
    total = sum(test.values())
    return sum(n for (place, y), n in test.items() if predicted[place] == labels[y]) / total if total else None


def _one_column_votes(weights: np.ndarray, depth: int = 5) -> np.ndarray:
    """Shares of the labels that a tree over the slots of one column gives to each of them, from weights (slot, label).

    Rows have one slot each, so a split by Gini impurity takes one slot out, and nothing divides its
    rows further: the tree is a chain. The last row of ``weights`` is rows without a slot.
    """

    def impurity(w: np.ndarray) -> np.ndarray:
        n = w.sum(-1)
        return 1 - ((w / np.where(n > 0, n, 1)[..., None]) ** 2).sum(-1)

    left, out = weights.copy(), np.zeros_like(weights)
    for _ in range(depth):
        rest = left.sum(0)
        if rest.sum() == 0 or impurity(rest) < 2.3e-16:
            break
        n, total = left[:-1].sum(1), rest.sum()
        gain = impurity(rest) - n / total * impurity(left[:-1]) - (total - n) / total * impurity(rest - left[:-1])
        gain[(n == 0) | (n == total)] = -1
        if not len(gain) or gain.max() <= 0:
            break
        at = int(gain.argmax())
        out[at], left[at] = left[at] / n[at], 0
    # What no split took out, whether or not a tree drew it, shares a leaf.
    rest = left.sum(0)
    out[out.sum(1) == 0] = rest / max(rest.sum(), 1)
    return out


def _one_feature(train, test, col, label, trees, seed, buckets) -> float:
    hasher = FeatureHasher(inputCols=[col], outputCol="__hashed", numFeatures=buckets, categoricalCols=[col])
    stages = [
        StringIndexer(inputCol=label, outputCol="label"),
        hasher,
        VectorSlicer(inputCol="__hashed", outputCol="features", indices=_used_slots(hasher.transform(train.select(col)), "__hashed")),
        RandomForestClassifier(numTrees=trees, seed=seed, featureSubsetStrategy="all"),
    ]
    fitted = Pipeline(stages=stages).fit(train.select(label, col))
    model = PipelineModel(stages=[without_summary(stage) for stage in fitted.stages])
    return class_metrics(model.transform(test.select(label, col))).first()["accuracy"]


def _used_slots(df: DataFrame, features: str) -> list[int]:
    """Slots with a value in some row. No tree splits at another, but a forest holds every slot of every row."""
    filled = df.agg(Summarizer.numNonZeros(F.col(features)).alias("n")).first()["n"]
    return [i for i, n in enumerate([] if filled is None else filled) if n] or [0]


def majority_accuracy(
    df: DataFrame, cols: Sequence[str], label: str = "type", in_train: Column | None = None, key: str = "id"
) -> DataFrame:
    """Test accuracy per column when each value predicts its commonest label.

    Learnt on training rows, smallest label on a tie; a value not seen there
    predicts the commonest label of all. Exact and fit for any number of values:
    one grouped count over all columns at once, no join and no model.
    """
    if in_train is None:
        in_train = F.pmod(F.xxhash64(key, F.lit(42)), F.lit(100)) < 70
    tagged = df.select(label, in_train.alias("__train"), *cols)
    common = (
        tagged.filter("__train")
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), label)
        .limit(1)
        .select(label)
        .scalar()
    )
    pairs = tagged.select(
        F.col(label).alias("y"),
        "__train",
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v")) for c in cols])
        ),
    )
    counts = pairs.groupBy("feature", "v", "y").agg(
        F.count_if("__train").alias("n_train"), F.count_if(~F.col("__train")).alias("n_test")
    )
    first = F.min(F.struct((-F.col("n_train")).alias("rank"), F.col("y"), F.col("n_test")))
    values = counts.groupBy("feature", "v").agg(
        first.alias("best"),
        F.sum("n_test").alias("n_test"),
        F.sum(F.when(F.col("y") == common, F.col("n_test")).otherwise(0)).alias("n_common"),
    )
    hits = F.when(F.col("best.rank") < 0, F.col("best.n_test")).otherwise(F.col("n_common"))
    return values.groupBy("feature").agg((F.sum(hits) / F.sum("n_test")).alias("accuracy"))


class FittedClassifiers(NamedTuple):
    """Models by kind (``tuned`` among them), the scores of the grid, and the test rows."""

    models: dict[str, PipelineModel]
    grid: DataFrame | None
    test: DataFrame

    def table(self) -> DataFrame:
        """One row per model: accuracy and F1 on test rows."""
        with kept(self.test) as test:
            results = [(_shown(kind), *class_metrics(m.transform(test)).first()) for kind, m in self.models.items()]
        return self.test.sparkSession.createDataFrame(results, "model string, accuracy double, f1 double")


def _shown(kind: str) -> str:
    return f"{MODEL_NAMES['gbt']} (tuned)" if kind == "tuned" else MODEL_NAMES[kind]


def train_classifiers(
    df: DataFrame, cat: Sequence[str], num: Sequence[str], label: str = "type", key: str = "id",
    kinds: Sequence[str] = ("rf", "lr", "gbt"), grid: Mapping[str, Sequence] | None = None, tuned: bool = True,
    parallelism: int = PARALLEL_FITS, keep: Sequence[str] = (),
) -> FittedClassifiers:
    """All classifiers fitted on the training side of ``df``, each once; ``keep`` columns stay with the test rows."""
    filled = fill_features(df, cat, num)
    test = split(filled.select(*dict.fromkeys([key, label, *keep, *cat, *num])), key)[1]
    with held(filled.select(key, label, *cat, *num), key) as rows:
        train = split(rows, key)[0]
        models = fit_classifiers(train, kinds, cat, num, label, parallelism=parallelism)
        table = None
        if tuned:
            models["tuned"], table = _tune(train, cat, num, label, key, grid, parallelism=parallelism)
    return FittedClassifiers(models, table, test)


def compare_classifiers(df: DataFrame, cat: Sequence[str], num: Sequence[str], *args, **kw) -> DataFrame:
    """One row per classifier, the tuned boosted trees among them; arguments as for :func:`train_classifiers`."""
    return train_classifiers(df, cat, num, *args, **kw).table()


class FittedRegressors(NamedTuple):
    """Models by kind, the training and the test rows that have a target."""

    models: dict[str, PipelineModel]
    train: DataFrame
    test: DataFrame

    def table(self) -> DataFrame:
        """One row per model: RMSE and R2 on test rows."""
        with kept(self.test) as test:
            scores = [(kind, reg_metrics(m.transform(test)).first()) for kind, m in self.models.items()]
        results = [(REGRESSOR_NAMES[kind], r["rmse"], r["r2"]) for kind, r in scores]
        return self.test.sparkSession.createDataFrame(results, "model string, rmse double, r2 double")


def train_regressors(
    df: DataFrame, cat: Sequence[str], num: Sequence[str], target: str, key: str = "id",
    kinds: Sequence[str] = ("lr", "rf", "gbt"), parallelism: int = PARALLEL_FITS,
) -> FittedRegressors:
    """All regressors fitted on the training side of the rows with a target, each once."""
    known = fill_features(_with_target(df, target), cat, num).select(key, "label", *cat, *num)
    train, test = split(known, key)
    with held(train, key) as rows:
        models = fit_regressors(rows, kinds, cat, num, parallelism=parallelism)
    return FittedRegressors(models, train, test)


def compare_regressors(df: DataFrame, cat: Sequence[str], num: Sequence[str], target: str, *args, **kw) -> DataFrame:
    """One row per regressor; arguments as for :func:`train_regressors`."""
    return train_regressors(df, cat, num, target, *args, **kw).table()
