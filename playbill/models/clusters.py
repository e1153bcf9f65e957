"""K-means clusters: assignments, choice of k, profiles."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.models.fits import held, kept, map_batches
from playbill.models.metrics import silhouettes, squared_distances, vectors_of
from playbill.operators.ranking import mark_best
from playbill.session import workers_find_package

MAX_ROUNDS, TOLERANCE = 20, 1e-4
# Rounds of candidate starts, and candidates of a round for each centre of the largest k.
_START_ROUNDS, _START_FACTOR = 3, 2


def _ready(df: DataFrame, cols: Sequence[str], nulls: str) -> DataFrame:
    """Rows fit for vectors. A gap is an error, unless ``nulls`` is skip (leave such rows out) or fill (with 0)."""
    if nulls not in ("error", "skip", "fill"):
        raise ValueError("nulls must be error, skip or fill")
    if nulls == "error":
        return df
    return df.na.drop(subset=list(cols)) if nulls == "skip" else df.na.fill(0, subset=list(cols))


def _stages(cols: Sequence[str]) -> Pipeline:
    """Columns to standardised vectors."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(cols), outputCol="__raw"),
            StandardScaler(inputCol="__raw", outputCol="features", withMean=True, withStd=True),
        ]
    )


def _uniform(h: np.ndarray, turn: int) -> np.ndarray:
    """A number in (0, 1) from a hash and the turn it is drawn for."""
    z = h.astype(np.int64).view(np.uint64) + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2**53 + 2**-54


def _starts(rows: DataFrame, ks: Sequence[int], seed: int) -> list[np.ndarray]:
    """First centres for each k, from one set of candidates.

    Candidates are drawn in rounds, a row's chance growing with its squared
    distance from the candidates so far; the draw is a hash of the row's key, so
    it doesn't move with the layout. Then each stands for the rows nearest to it,
    and of these few weighted points the driver draws the centres of each k.
    """
    most = _START_FACTOR * max(ks)
    schema = "score double, x array<double>"

    def drawn(found: np.ndarray | None, turn: int, take: int) -> np.ndarray:
        def rows_of(batches):
            best, points = np.zeros(0), None
            for batch in batches:
                x, h = vectors_of(batch), np.asarray(batch.column(1))
                weight = np.ones(len(x)) if found is None else squared_distances(x, found).min(1)
                some = np.flatnonzero(weight > 1e-12)
                score = -np.log(_uniform(h[some], turn)) / weight[some]
                points = x[some] if points is None else np.concatenate((points, x[some]))
                best = np.concatenate((best, score))
                first = np.argsort(best, kind="stable")[:take]
                best, points = best[first], points[first]
            xs = pa.array([] if points is None else list(points), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(best, pa.float64()), xs], ["score", "x"])

        top = map_batches(rows, rows_of, schema).orderBy("score", "x").limit(take).collect()
        return np.array([r["x"] for r in top], np.float64)

    found = drawn(None, seed, 1)
    if not len(found):
        return []
    for turn in range(_START_ROUNDS):
        more = drawn(found, seed + 1 + turn, most)
        found = np.concatenate((found, more)) if len(more) else found
    weights = _sums(rows, [found])[0][:, 0]
    out = []
    for k in ks:
        draw = np.random.default_rng([seed, k])
        chosen = [int(draw.choice(len(found), p=weights / weights.sum()))]
        while len(chosen) < min(k, len(found)):
            chance = weights * squared_distances(found, found[chosen]).min(1)
            if not chance.sum():
                break
            chosen.append(int(draw.choice(len(found), p=chance / chance.sum())))
        out.append(found[chosen])
    return out


def _sums(rows: DataFrame, centres: Sequence[np.ndarray]) -> list[np.ndarray]:
    """For each grouping, rows and summed vector of each centre, all from one pass."""
    edges = np.cumsum([0, *map(len, centres)])
    every = np.concatenate(centres)

    def parts(batches):
        total = np.zeros((len(every), every.shape[1] + 1))
        for batch in batches:
            x = vectors_of(batch)
            apart, full = squared_distances(x, every), np.column_stack((np.ones(len(x)), x))
            for a, b in zip(edges, edges[1:]):
                mark = np.zeros((len(x), b - a))
                mark[np.arange(len(x)), apart[:, a:b].argmin(1)] = 1
                total[a:b] += mark.T @ full
        at = pa.array(np.arange(total.size))
        yield pa.RecordBatch.from_arrays([at, pa.array(total.ravel())], ["at", "v"])

    found = map_batches(rows, parts, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(len(every) * (every.shape[1] + 1))
    for r in found:
        total[r["at"]] = r["v"]
    return np.split(total.reshape(len(every), -1), edges[1:-1])


def fit_centres(
    vectors: DataFrame, ks: Sequence[int], key: str = "id", features: str = "features", seed: int = 1,
    rounds: int = MAX_ROUNDS, tolerance: float = TOLERANCE,
) -> list[np.ndarray]:
    """Centres of k-means for each of ``ks``; every round moves all of them in one pass over the rows.

    A k is done when no centre moved by more than ``tolerance``; a centre without rows
    stays. Equal distances go to the first centre. Fewer different vectors than k
    give fewer centres. Sums per centre are all that comes to the driver. The rows
    are kept as arrays with their hash while the passes run.
    """
    points = vectors.select(vector_to_array(features).alias("x"), F.xxhash64(key, F.lit(seed)).alias("h"))
    with kept(points) as rows:
        centres = _starts(rows, ks, seed)
        active = list(range(len(centres)))
        for _ in range(rounds):
            if not active:
                break
            for i, sums in zip(active, _sums(rows, [centres[i] for i in active])):
                n = sums[:, :1]
                moved = np.where(n > 0, sums[:, 1:] / np.maximum(n, 1), centres[i])
                if ((moved - centres[i]) ** 2).sum(1).max() <= tolerance**2:
                    active = [a for a in active if a != i]
                centres[i] = moved
    return centres


def nearest(features: str, centres: np.ndarray):
    """Column with the number of the nearest centre."""
    workers_find_package(SparkSession.active())

    @F.pandas_udf("int")
    def number(x: pd.Series) -> pd.Series:
        return pd.Series(squared_distances(np.stack(x.to_numpy()), centres).argmin(1) if len(x) else [], dtype="int32")

    return number(vector_to_array(features))


def cluster(
    df: DataFrame, cols: Sequence[str], k: int = 6, seed: int = 1, nulls: str = "error",
    keep: Sequence[str] = ("id",), partitions: int | None = None, key: str = "id",
) -> DataFrame:
    """Cluster number per row, next to its ids and raw columns; the same for any layout of the rows."""
    with held(df.select(key, *cols), key, partitions) as rows:
        ready = _ready(rows, cols, nulls)
        scaled = _stages(cols).fit(ready)
        found = fit_centres(scaled.transform(ready), [k], key, seed=seed)
    shown = scaled.transform(_ready(df, cols, nulls))
    number = nearest("features", found[0]) if found else F.lit(None).cast("int")
    return shown.withColumn("prediction", number).select(*keep, "prediction", *cols)


def k_sweep(
    df: DataFrame, cols: Sequence[str], ks: Sequence[int] = range(2, 20), seed: int = 1, nulls: str = "error",
    partitions: int | None = None, key: str = "id",
) -> DataFrame:
    """Silhouette per number of clusters, best one flagged.

    The columns are read and standardised once. All k move in the same passes and
    are scored together, so the rows are read some thirty times for any number of k.
    """
    with held(df.select(key, *cols), key, partitions) as rows:
        ready = _ready(rows, cols, nulls)
        vectors = _stages(cols).fit(ready).transform(ready)
        found = silhouettes(vectors, fit_centres(vectors, ks, key, seed=seed))
    scores = list(zip([int(k) for k in ks], found or [None] * len(ks)))
    table = df.sparkSession.createDataFrame(scores, "k int, silhouette double")
    return mark_best(table, "silhouette")


def cluster_profile(
    df: DataFrame,
    cols: Sequence[str],
    cluster: str = "prediction",
    rescale: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Size and mean features per cluster; ``rescale`` adds ``(mean - shift) / scale`` columns."""
    means = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(f"avg_{c}") for c in cols]
    )
    return means.withColumns(
        {f"{c}_rescaled": (F.col(f"avg_{c}") - shift) / scale for c, (shift, scale) in (rescale or {}).items()}
    )
