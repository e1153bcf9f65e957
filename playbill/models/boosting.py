"""Boosted trees of two classes, grown a whole fit to a task over one byte a feature and row.

The rules are those of the library's ``GBTClassifier`` (logistic loss, variance, 32 bins,
the first best split of a node, leaves by their mean), which runs a job for every level of
every tree and shuffles the sums of all nodes. Here a fit's rows go to one task once.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.models.fits import map_batches
from playbill.session import scratch_path

# Rows of a table whose fits are grown in a task each: below, the library is quick enough; above,
# a task would hold too much (some 60 bytes a row), so the library's spread fit has to do.
GROWN_FROM, GROWN_MOST = 50_000, 8_000_000
# Rows that bins are taken from; the library takes 10,000.
BINNED_ROWS, BINS, STEP = 100_000, 32, 0.1
# A category of more values does not fit into a byte.
VALUES = 250
_PURE, _NOISE = 2.3e-16, 1e-13


class Bins(NamedTuple):
    """How a row becomes bytes: the columns, and for each the number of slots (text) or the cuts (number)."""

    columns: list[str]
    slots: list[int | None]
    cuts: list[np.ndarray]

    def of(self, batch: pa.RecordBatch) -> np.ndarray:
        out = np.empty((len(self.columns), batch.num_rows), np.uint8)
        for i, c in enumerate(self.columns):
            values = batch.column(c)
            if values.null_count:
                raise ValueError(f"a value of {c} is missing")
            x = values.to_numpy(zero_copy_only=False)
            if self.slots[i] is None and np.isnan(x).any():
                raise ValueError(f"a value of {c} is not a number")
            out[i] = np.minimum(x, self.slots[i]) if self.slots[i] is not None else np.searchsorted(self.cuts[i], x)
        return out

    def feature(self, column: int, at: int) -> tuple[int, float]:
        """Slot of the features vector and threshold of a split."""
        before = sum(1 if n is None else n for n in self.slots[:column])
        return (before, float(self.cuts[column][at])) if self.slots[column] is None else (before + at, 0.5)


def cuts_of(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Thresholds between different values, ``bins - 1`` at most, with about as many rows between any two."""
    found, counts = np.unique(values, return_counts=True)
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) <= bins - 1:
        return middle
    total = np.cumsum(counts)
    # A threshold goes before the first value that is nearer to the target without itself.
    nearer, stride = total[:-1] + total[1:], len(values) / bins
    cuts, target, at = [], stride, 0
    while True:
        at = max(at, int(np.searchsorted(nearer, 2 * target, side="right")))
        if at >= len(middle):
            return np.array(cuts)
        cuts.append(middle[at])
        at, target = at + 1, target + stride


class Tree(NamedTuple):
    """Nodes by number, children after their parents: column and place of the split (-1 at a leaf), left child, sums."""

    column: np.ndarray
    at: np.ndarray
    left: np.ndarray
    rows: np.ndarray
    total: np.ndarray
    squares: np.ndarray
    gain: np.ndarray

    def predict(self, bins: np.ndarray, slots: np.ndarray) -> np.ndarray:
        node, active = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        while len(active := active[self.column[node[active]] >= 0]):
            own = node[active]
            node[active] = self.left[own] + _right(bins[self.column[own], active], self.column[own], self.at[own], slots)
        return (self.total / self.rows)[node]


def _right(b: np.ndarray, column: np.ndarray, at: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Whether rows with these bins go to the right child: the slot itself, or beyond the cut."""
    return np.where(slots[column], b == at, b > at)


def _going_on(some: np.ndarray, row, node, y, bins, mean, predicted):
    """Rows of ``some`` nodes, which are numbered anew; the others get the mean of theirs as ``predicted``."""
    if some.all():
        return row, node, y, bins
    on = some[node]
    predicted[row[~on]] = mean[node[~on]]
    return row[on], (np.cumsum(some) - 1)[node[on]], y[on], bins[:, on]


def _best_splits(bins, widths, slots, node, y, n, total) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, column and place of the first best split of each node; no column where none divides its rows."""
    nodes, line, mean = len(n), np.arange(len(n)), total / n
    best, column, place = np.zeros(nodes), np.full(nodes, -1), np.zeros(nodes, np.int64)
    for i, width in enumerate(widths if nodes else []):
        if not width:
            continue
        code = node * (width + 1) + bins[i]
        count, sums = (np.bincount(code, weights=w, minlength=nodes * (width + 1)).reshape(-1, width + 1) for w in (None, y))
        count, sums = (count[:, :width], sums[:, :width]) if slots[i] else (count.cumsum(1)[:, :width], sums.cumsum(1)[:, :width])
        rest = n[:, None] - count
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (sums * sums / count + (total[:, None] - sums) ** 2 / rest) / n[:, None] - (mean * mean)[:, None]
        gain[(count == 0) | (rest == 0)] = -1
        at = gain.argmax(1)
        gain = gain[line, at]
        more = gain > best
        best[more], column[more], place[more] = gain[more], i, at[more]
    return best, column, place


def grow(bins: np.ndarray, widths: Sequence[int], slots: np.ndarray, y: np.ndarray, depth: int) -> tuple[Tree, np.ndarray]:
    """A regression tree of ``y``, level by level, and its prediction for each row.

    ``widths`` are the numbers of splits of each column, ``slots`` tells columns of slots.
    """
    predicted, row, node = np.empty(len(y)), np.arange(len(y)), np.zeros(len(y), np.int64)
    levels, first, open_nodes = [], 0, 1
    for level in range(depth + 1):
        n = np.bincount(node, minlength=open_nodes)
        total, squares = (np.bincount(node, weights=w, minlength=open_nodes) for w in (y, y * y))
        mean = total / n
        impurity = squares / n - mean * mean
        column, place, gains = np.full(open_nodes, -1), np.zeros(open_nodes, np.int64), np.full(open_nodes, -1.0)
        # Rows of nodes that stay leaves are put aside before the sums by bins.
        tried = (n > 1) & ((level == 0) | (abs(impurity) >= _PURE)) & (level < depth)
        row, node, y, bins = _going_on(tried, row, node, y, bins, mean, predicted)
        tried = np.flatnonzero(tried)
        best, column[tried], place[tried] = _best_splits(bins, widths, slots, node, y, n[tried], total[tried])
        split = np.zeros(open_nodes, bool)
        split[tried] = best > _NOISE * squares[tried] / n[tried]
        column[~split] = -1
        gains[tried] = np.where(split[tried], best, -1.0)
        children = 2 * np.cumsum(split) - 2
        levels.append((column, place, np.where(split, first + open_nodes + children, -1), n, total, squares, gains))
        row, node, y, bins = _going_on(split[tried], row, node, y, bins, mean[tried], predicted)
        if not len(row):
            break
        column, place = column[split], place[split]
        own = column[node]
        node = 2 * node + _right(bins[own, np.arange(len(row))], own, place[node], slots)
        first, open_nodes = first + open_nodes, 2 * len(column)
    return Tree(*map(np.concatenate, zip(*levels))), predicted


def boost(bins: np.ndarray, widths: Sequence[int], slots: np.ndarray, label: np.ndarray, depth: int, rounds: int) -> Iterator[Tree]:
    """Trees of a fit, one a round: the first of the labels, the others of what is left, by their ``STEP``."""
    y = 2.0 * label - 1
    tree, margin = grow(bins, widths, slots, y, depth)
    yield tree
    for _ in range(1, rounds):
        with np.errstate(over="ignore"):
            rest = 4 * y / (1 + np.exp(2 * y * margin))
        tree, more = grow(bins, widths, slots, rest, depth)
        margin += STEP * more
        yield tree


def binning(encoder, cat: Sequence[str], num: Sequence[str], sample: pa.Table) -> Bins | None:
    """Bins of the encoded rows, thresholds from a sample; none where a category has too many values."""
    labels = {}
    for stage in encoder.stages:
        if isinstance(stage, StringIndexerModel) and stage.isSet("outputCols"):
            labels = dict(zip(stage.getOutputCols(), map(len, stage.labelsArray)))
    slots = [labels[f"{c}_index"] for c in cat]
    if any(n > VALUES for n in slots):
        return None
    cuts = [cuts_of(sample.column(c).to_numpy().astype(np.float64)) for c in num]
    return Bins([f"{c}_index" for c in cat] + list(num), [*slots, *[None] * len(num)], [*[np.empty(0)] * len(cat), *cuts])


def _shape(bins: Bins) -> tuple[list[int], np.ndarray]:
    return [len(c) if n is None else n for n, c in zip(bins.slots, bins.cuts)], np.array([n is not None for n in bins.slots])


def _packed(encoded: DataFrame, bins: Bins, tasks: Sequence[int]) -> DataFrame:
    """(task, part, at, train, test): the rows of a batch as bytes, a column after the other and the label last, for each task.

    ``__test`` of a row tells its side.
    """

    def rows(batches):
        part = TaskContext.get().partitionId()
        for at, batch in enumerate(batches):
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.uint8)
            every, test = np.vstack((bins.of(batch), label[None])), batch.column("__test").to_numpy(zero_copy_only=False)
            sides = [every[:, ~test].tobytes(), every[:, test].tobytes()]
            n = len(tasks)
            arrays = [pa.array(tasks, pa.int32()), pa.array([part] * n, pa.int32()), pa.array([at] * n, pa.int32())]
            arrays += [pa.array([x] * n, pa.binary()) for x in sides]
            yield pa.RecordBatch.from_arrays(arrays, ["task", "part", "at", "train", "test"])

    source = encoded.select("label", "__test", *(F.col(c).cast("double").alias(c) for c in bins.columns))
    return map_batches(source, rows, "task int, part int, at int, train binary, test binary")


def _each_alone(packed: DataFrame, tasks: int) -> DataFrame:
    """A partition for each task, its batches in the order of the rows."""
    spark = packed.sparkSession
    dealt = spark.range(200 * tasks).selectExpr("int(id) AS salt", f"pmod(hash(int(id)), {tasks}) AS place").groupBy("place").agg(F.min("salt").alias("salt")).collect()
    salts = {r["place"]: r["salt"] for r in dealt}
    salt = F.element_at(F.array(*(F.lit(salts[i]) for i in range(tasks))), F.col("task") + 1)
    return packed.withColumn("salt", salt).repartition(tasks, "salt").sortWithinPartitions("task", "part", "at")


def _sides(batches, columns: int) -> tuple[int | None, np.ndarray, np.ndarray]:
    task, sides = None, ([], [])
    for batch in batches:
        for own, name in zip(sides, ("train", "test")):
            own += [np.frombuffer(x.as_buffer(), np.uint8).reshape(columns, -1) for x in batch.column(name)]
        task = batch.column("task")[0].as_py() if batch.num_rows else task
    return task, *(np.concatenate(own, axis=1) if own else np.empty((columns, 0), np.uint8) for own in sides)


def cells_by_rounds(
    folds: Sequence[tuple[DataFrame, Bins]], fits: Sequence[tuple[int, int]], rounds: Sequence[int]
) -> dict[tuple[int, int], list[dict[tuple[float, float], int]]]:
    """For each (fold, depth) of ``fits`` and each of ``rounds``: counts of (label, prediction) on the fold's test rows.

    ``folds`` are encoded rows with ``__test``, and their bins. Every fit runs in a task of its own.
    """
    parts = [_packed(df, bins, [i for i, (fold, _) in enumerate(fits) if fold == f]) for f, (df, bins) in enumerate(folds)]
    packed = parts[0]
    for part in parts[1:]:
        packed = packed.union(part)
    shapes = [_shape(bins) for _, bins in folds]

    def rows(batches):
        columns = len(shapes[0][0]) + 1
        task, train, test = _sides(batches, columns)
        if task is None:
            return
        fold, depth = fits[task]
        widths, slots = shapes[fold]
        margin, out = np.zeros(test.shape[1]), []
        for i, tree in enumerate(boost(train[:-1], widths, slots, train[-1], depth, max(rounds)), 1):
            margin += (1.0 if i == 1 else STEP) * tree.predict(test[:-1], slots)
            if i in rounds:
                seen = np.bincount(2 * test[-1].astype(np.int64) + (margin > 0), minlength=4)
                out += [(task, i, code // 2, code % 2, int(n)) for code, n in enumerate(seen) if n]
        names = ["task", "rounds", "label", "prediction", "n"]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)] if out else [pa.array([], pa.int64())] * 5, names)

    found = map_batches(_each_alone(packed, len(fits)), rows, "task long, rounds long, label long, prediction long, n long").collect()
    cells: dict = {fit: [{} for _ in rounds] for fit in fits}
    for r in found:
        cells[fits[r["task"]]][list(rounds).index(r["rounds"])][float(r["label"]), float(r["prediction"])] = r["n"]
    return cells


_NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
    "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def fit_model(encoded: DataFrame, bins: Bins, params: Mapping[str, int], seed: int) -> GBTClassificationModel:
    """The library's model with trees grown in one task, from encoded rows with ``features``."""
    spark = encoded.sparkSession
    depth, rounds, columns = params.get("maxDepth", 5), params.get("maxIter", 20), len(bins.columns) + 1
    widths, slots = _shape(bins)

    def rows(batches):
        task, train, _ = _sides(batches, columns)
        if task is None:
            return
        for i, tree in enumerate(boost(train[:-1], widths, slots, train[-1], depth, rounds)):
            nodes = []
            for k, (column, at, left, n, total, squares, gain) in enumerate(zip(*(x.tolist() for x in tree))):
                feature, threshold = bins.feature(column, at) if column >= 0 else (-1, None)
                split = {"featureIndex": feature, "leftCategoriesOrThreshold": [] if threshold is None else [threshold], "numCategories": -1}
                nodes.append({
                    "id": k, "prediction": total / n, "impurity": squares / n - (total / n) ** 2, "impurityStats": [n, total, squares],
                    "rawCount": n, "gain": gain, "leftChild": left, "rightChild": left + 1 if left >= 0 else -1, "split": split,
                })
            split = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
            node = pa.struct([
                ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", split),
            ])
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(nodes), pa.int32()), pa.array(nodes, node)], ["treeID", "nodeData"])

    packed = _packed(encoded.withColumn("__test", F.lit(False)), bins, [0])
    # Two rows give a model of the same shape, whose nodes are then these.
    two = encoded.where("label = 0").limit(1).union(encoded.where("label = 1").limit(1)).coalesce(1)
    small = GBTClassifier(seed=seed, **params).fit(two)
    shape, path = scratch_path(spark, "model"), scratch_path(spark, "model")
    small.write().save(shape)
    map_batches(_each_alone(packed, 1), rows, _NODES).write.parquet(f"{path}/data")
    spark.read.parquet(f"{shape}/treesMetadata").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.read.text(f"{shape}/metadata").coalesce(1).write.text(f"{path}/metadata")
    return GBTClassificationModel.load(path)


def sampled(train: DataFrame, key: str, cols: Sequence[str], num: Sequence[str], rows: int) -> pa.Table:
    """Numbers and ``__fold`` of some ``BINNED_ROWS`` rows, drawn by a hash of the row."""
    every = max(1, rows // BINNED_ROWS)
    drawn = train.where(F.pmod(F.xxhash64(F.lit("bins"), key, *cols), F.lit(every)) == 0)
    return drawn.select("__fold", *(F.col(c).cast("double").alias(c) for c in num)).toArrow()
