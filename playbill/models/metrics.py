"""Model metrics as one-row DataFrames, computed from grouped sums in one pass."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.models.fits import map_batches


def class_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and F1 weighted by class size."""
    cells = pred.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # a cell counts for its true class and for its predicted class
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("y").alias("cls"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted"),
                         F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("p").alias("cls"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("predicted"),
                         F.lit(0).cast("long").alias("hit")),
            )
        )
    )
    classes = sides.groupBy("cls").agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hit")])
    f1 = 2 * F.col("hit") / (F.col("actual") + F.col("predicted"))
    rows = F.sum("actual")
    return classes.agg(
        (F.sum("hit") / rows).alias("accuracy"), (F.sum(f1 * F.col("actual")) / rows).alias("f1")
    )


def reg_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Root mean squared error, mean squared error, R2."""
    y, error = F.col(label).cast("double"), F.col(label) - F.col(prediction)
    sums = pred.agg(F.avg(error * error).alias("mse"), F.var_pop(y).alias("variance"))
    return sums.select(
        F.sqrt("mse").alias("rmse"),
        "mse",
        (1 - F.col("mse") / F.nullif("variance", F.lit(0.0))).alias("r2"),
    )


def silhouette(df: DataFrame, features: Sequence[str] | str, cluster: str = "prediction") -> DataFrame:
    """Mean silhouette with squared Euclidean distance, from a vector or number columns.

    The evaluator needs only one sum vector per cluster, never row pairs.
    """
    if not isinstance(features, str):
        df = VectorAssembler(inputCols=list(features), outputCol="__vec").transform(df)
        features = "__vec"
    score = silhouette_score(df, features, cluster)
    return df.sparkSession.createDataFrame([(score,)], "silhouette double")


def silhouette_score(df: DataFrame, features: str = "features", cluster: str = "prediction") -> float:
    """The same for a vector column, as a number."""
    rows = df.select(features, F.col(cluster).cast("double").alias("__cluster"))
    return ClusteringEvaluator(featuresCol=features, predictionCol="__cluster").evaluate(rows)


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of each row from each centre."""
    return np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * x @ centres.T, 0)


def vectors_of(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors in the first column of a batch, one a row."""
    return np.asarray(batch.column(0).flatten(), np.float64).reshape(batch.num_rows, -1)


def silhouettes(
    df: DataFrame, groupings: Sequence[str | np.ndarray], features: str = "features"
) -> list[float | None]:
    """Mean silhouette of each of several groupings of the same rows, in two passes for all.

    A grouping is a column of cluster numbers, or centres, whose nearest one is a
    row's cluster. The first pass sums up every cluster (rows, vector, squared
    length); these few numbers go to the second, which gets all distances of a
    batch of rows from one matrix product and sums up what each row scores. None
    where a grouping has one cluster.
    """
    cols = [g for g in groupings if isinstance(g, str)]
    count = len(groupings)
    rows = df.select(vector_to_array(features).alias("x"), *[F.col(c).cast("int").alias(c) for c in cols])

    def labels(batch: pa.RecordBatch, x: np.ndarray) -> list[np.ndarray]:
        return [
            np.asarray(batch.column(1 + cols.index(g))) if isinstance(g, str) else squared_distances(x, g).argmin(1) for g in groupings
        ]

    def sums(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x = vectors_of(batch)
            full = np.column_stack((np.ones(len(x)), (x * x).sum(1), x))
            for g, own in enumerate(labels(batch, x)):
                for c in np.unique(own):
                    held[g, int(c)] = held.get((g, int(c)), 0) + full[own == c].sum(0)
        cells = [(g, c, i, float(v)) for (g, c), total in held.items() for i, v in enumerate(total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([cell[i] for cell in cells], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.float64()))], ["g", "c", "i", "v"]
        )

    found = map_batches(rows, sums, "g int, c int, i int, v double").groupBy("g", "c", "i").agg(F.sum("v").alias("v")).collect()
    if not found:
        return [None] * count
    width = 1 + max(r["i"] for r in found)
    totals = [np.zeros((1 + max((r["c"] for r in found if r["g"] == g), default=0), width)) for g in range(count)]
    for r in found:
        totals[r["g"]][r["c"], r["i"]] = r["v"]
    many = [g for g in range(count) if (totals[g][:, 0] > 0).sum() > 1]

    def scores(batches):
        stats = np.concatenate(totals)
        size = np.maximum(stats[:, 0], 1)
        mean, square, empty = stats[:, 2:] / size[:, None], stats[:, 1] / size, stats[:, 0] == 0
        starts = np.cumsum([0, *map(len, totals)])
        out = np.zeros((count, 2))
        for batch in batches:
            x = vectors_of(batch)
            own_labels = labels(batch, x)
            apart = np.maximum((x * x).sum(1)[:, None] + square - 2 * x @ mean.T, 0)
            apart[:, empty] = np.inf
            line = np.arange(len(x))
            for g in many:
                far = apart[:, starts[g] : starts[g + 1]]
                own = own_labels[g]
                n = totals[g][own, 0]
                inside = far[line, own] * n / np.maximum(n - 1, 1)
                far[line, own] = np.inf
                others = far.min(1)
                most = np.maximum(others, inside)
                value = np.where((n > 1) & (most > 0), (others - inside) / np.where(most > 0, most, 1), 0)
                out[g] += value.sum(), len(x)
        columns = [pa.array(range(count), pa.int32()), pa.array(out[:, 0]), pa.array(out[:, 1])]
        yield pa.RecordBatch.from_arrays(columns, ["g", "total", "n"])

    scored = map_batches(rows, scores, "g int, total double, n double").groupBy("g").agg((F.sum("total") / F.sum("n")).alias("v"))
    by_number = {r["g"]: r["v"] for r in scored.where(F.col("g").isin(many)).collect()} if many else {}
    return [by_number.get(g) for g in range(count)]
