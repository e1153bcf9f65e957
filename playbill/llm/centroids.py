"""Centroid clustering in whole numbers, with a filter of rotated leading coordinates."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.llm.groups import stored
from playbill.llm.tasks import map_text

DIMS, SCALE = 64, 1024
CLUSTERS, ROUNDS, SEED = 8, 10, 3
# Rotated coordinates kept with each vector; the rest is one residual norm.
LEADING = 16
# Larger whole numbers could carry a squared distance past 63 bits.
_MOST = 1 << 27
# Share of its length by which a stored coordinate of a vector may be off.
_OFF = 4e-6


def _numbers(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are vectors of ``dims`` finite numbers, and those in whole numbers."""
    sizes = np.asarray(column.value_lengths().fill_null(-1))
    good = sizes == dims
    some = column.filter(pa.array(good))
    values = np.asarray(some.flatten().cast(pa.float64()).fill_null(np.nan), np.float64).reshape(-1, dims)
    finite = np.isfinite(values).all(1)
    good[good] = finite
    whole = np.floor(scale * values[finite])
    if whole.size and np.abs(whole).max() >= _MOST:
        raise ValueError(f"a component beyond {_MOST // scale} makes squared distances longer than 63 bits")
    return good, whole.astype(np.int64)


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _read(batch: pa.RecordBatch, dims: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    v, s = batch.schema.get_field_index("v"), batch.schema.get_field_index("s")
    return _matrix(batch.column(v), "<i4", dims).astype(np.int64), _matrix(batch.column(s), "<f4", width)


@dataclass(frozen=True)
class Rotation:
    """Mean and leading principal directions (one a column) of all vectors."""

    mean: np.ndarray
    axes: np.ndarray

    def sketch(self, whole: np.ndarray) -> np.ndarray:
        """Leading coordinates, residual norm and length of each row, as 32-bit numbers."""
        centred = whole - self.mean
        lead = centred @ self.axes
        rest = np.sqrt(((centred - lead @ self.axes.T) ** 2).sum(1))
        return np.column_stack((lead, rest, np.sqrt((centred**2).sum(1)))).astype("<f4")


def rotation(source: DataFrame, dims: int = DIMS, scale: int = SCALE, leading: int = LEADING) -> Rotation:
    """Principal directions of all vectors in column ``v``.

    Each task sums up products of components; one row a pair of components is
    left, so the driver gets (``dims`` + 1) squared numbers at any size. Sums are floating: they decide
    how much the filter spares, never a result.
    """
    width = dims + 1

    def products(batches):
        total = np.zeros((width, width))
        for batch in batches:
            whole = _numbers(batch.column(0), dims, scale)[1]
            one = np.column_stack((whole, np.ones(len(whole))))
            total += one.T @ one
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "total"])

    found = map_text(source.select("v"), products, "at long, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()
    total = np.zeros(width * width)
    for r in found:
        total[r["at"]] = r["total"]
    total = total.reshape(width, width)
    n = max(total[dims, dims], 1.0)
    mean = total[dims, :dims] / n
    values, axes = np.linalg.eigh(total[:dims, :dims] / n - np.outer(mean, mean))
    return Rotation(mean, axes[:, np.argsort(-values)[:leading]])


def nearest(whole: np.ndarray, sketch: np.ndarray, centres: np.ndarray, centre_sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centre of each row (the first of equal ones), its squared distance, distances worked out.

    The distance of two sketches never exceeds that of their vectors, but for
    rounding, which is allowed for. The centre with the least bound is tried
    first; others whose bound is not beyond the distance found are worked out too.
    """
    lead, length = sketch[:, :-1].astype(np.float64), sketch[:, -1].astype(np.float64)
    their, their_length = centre_sketch[:, :-1].astype(np.float64), centre_sketch[:, -1].astype(np.float64)
    square = (lead**2).sum(1)[:, None] + (their**2).sum(1) - 2 * lead @ their.T
    bound = np.sqrt(np.maximum(square, 0)) - _OFF * (length[:, None] + their_length + 1)
    best = bound.argmin(1)

    def exact(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
        apart = rows - centre
        return np.einsum("ij,ij->i", apart, apart)

    guess, least, tried = best.copy(), exact(whole, centres[best]), len(whole)
    left = bound <= np.sqrt(least.astype(np.float64))[:, None] * (1 + 1e-12)
    for c in range(len(centres)):
        at = np.flatnonzero(left[:, c] & (guess != c))
        tried += len(at)
        own = exact(whole[at], centres[c])
        wins = (own < least[at]) | ((own == least[at]) & (c < best[at]))
        best[at[wins]], least[at[wins]] = c, own[wins]
    return best, least, tried


class VectorTable:
    """Vectors in whole numbers with their sketches, written once and read in each round."""

    def __init__(self, vectors: DataFrame, key: str, vector: str, dims: int, scale: int, leading: int):
        self.key, self.kind, self.dims = key, vectors.schema[key].dataType.simpleString(), dims
        source = vectors.select(vectors[key].alias("k"), vectors[vector].alias("v"))
        turn = self.turn = rotation(source, dims, scale, min(leading, dims))

        def rows(batches):
            for batch in batches:
                good, whole = _numbers(batch.column(1), dims, scale)
                sketches = turn.sketch(whole)
                arrays = [batch.column(0).filter(pa.array(good)), pa.array([x.tobytes() for x in whole.astype("<i4")], pa.binary())]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array([x.tobytes() for x in sketches], pa.binary())], ["k", "v", "s"])

        self.rows = stored(map_text(source, rows, f"k {self.kind}, v binary, s binary"), "vectors")

    def first(self, k: int, seed: int) -> np.ndarray:
        """The k vectors with the smallest hash of their key; of one key, smaller bytes first, null keys last."""
        mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("k").cast("string")), 256)
        found = self.rows.select(mark.alias("mark"), "v").orderBy(F.col("mark").asc_nulls_last(), "v").limit(k).collect()
        return np.array([np.frombuffer(r["v"], "<i4") for r in found], np.int64).reshape(-1, self.dims)

    def moved(self, centres: np.ndarray) -> np.ndarray:
        """Centres after one round: exact floors of the means of their vectors; one without vectors stays."""
        dims, count, sketch = self.dims, len(centres), self.turn.sketch(centres)

        def sums(batches):
            total = np.zeros((count, dims + 1), np.int64)
            for batch in batches:
                whole, own = _read(batch, dims, sketch.shape[1])
                best = nearest(whole, own, centres, sketch)[0]
                total[:, dims] += np.bincount(best, minlength=count)
                for c in np.unique(best):
                    total[c, :dims] += whole[best == c].sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "total"])

        found = map_text(self.rows.select("v", "s"), sums, "at long, total long")
        found = found.groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        total = {r["at"]: int(r["total"]) for r in found}
        after = centres.copy()
        for c in range(count):
            at = c * (dims + 1)
            if n := total.get(at + dims):
                after[c] = [total[at + i] // n for i in range(dims)]
        return after

    def assigned(self, centres: np.ndarray) -> DataFrame:
        """(key, cluster, distance) of every vector."""
        sketch, key, dims = self.turn.sketch(centres), self.key, self.dims

        def rows(batches):
            for batch in batches:
                best, least, _ = nearest(*_read(batch, dims, sketch.shape[1]), centres, sketch)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int32()), pa.array(least)], [key, "cluster", "distance"])

        return map_text(self.rows, rows, f"`{key}` {self.kind}, cluster int, distance long")


def _empty(spark: SparkSession, key: str, kind: str) -> tuple[DataFrame, DataFrame]:
    return (
        spark.createDataFrame([], f"`{key}` {kind}, cluster int, distance long"),
        spark.createDataFrame([], "cluster int, centroid array<long>, n long, inertia decimal(38,0)"),
    )


def cluster_vectors(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
    key: str = "vec_id", vector: str = "embedding", dims: int = DIMS, scale: int = SCALE, leading: int = LEADING,
) -> tuple[DataFrame, DataFrame]:
    """Cluster whole-number vectors by ``rounds`` of nearest centroids and floored means.

    Returns (key, cluster, distance) of each vector and one row a centroid:
    cluster, centroid, n, inertia. Components become floor(scale * x). Rows whose
    vector is null, has another length, or holds a null, NaN or infinity are left
    out; a component of 131,072 or more raises an error, as squared distances
    would leave 63 bits. Repeated rows count each, equal distances go to the smaller
    cluster number, a null key is kept but comes last as a first centroid. With
    fewer vectors than ``k`` there are that many clusters; without any, both
    tables are empty. Other columns are not read.

    A vector is written once, as whole numbers and a sketch: ``leading``
    coordinates along the principal directions and the norm of the rest. The
    distance of sketches bounds that of vectors from below, so few distances are
    worked out. A round brings k times ``dims`` + 1 sums to the driver.
    """
    table = VectorTable(vectors, key, vector, dims, scale, leading)
    centres = table.first(k, seed)
    if not len(centres):
        return _empty(vectors.sparkSession, key, table.kind)
    for _ in range(rounds):
        centres = table.moved(centres)
    rows = stored(table.assigned(centres), "clusters")
    found = {r["cluster"]: r for r in rows.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    described = [
        (c, [int(x) for x in v], found[c]["n"] if c in found else 0, found[c]["inertia"] if c in found else None) for c, v in enumerate(centres)
    ]
    schema = "cluster int, centroid array<long>, n long, inertia decimal(38,0)"
    return rows, vectors.sparkSession.createDataFrame(described, schema).na.fill(0)
