"""Label indexes, indicator vectors, assembled and scaled vectors, stable splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.linalg import DenseVector, SparseVector, Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.session import scratch_path

# Vectors of more slots carry their size, but no name for each slot: the library keeps
# the names on the driver, some hundred bytes each.
NAMED_SLOTS = 20_000


def check_labels(df: DataFrame, cols: Sequence[str], max_labels: int) -> None:
    """Refuse columns with more than ``max_labels`` different values, counted exactly."""
    found = df.agg(*[F.count_distinct(F.col(f"`{c}`")).alias(c) for c in cols]).first()
    wide = [c for c in cols if found[c] > max_labels]
    if wide:
        raise ValueError(f"more than {max_labels} different values in {wide}")


def label_numbers(df: DataFrame, col: str) -> tuple[DataFrame, int]:
    """(label, number) of every value of a column by falling count, ties by name, and how many there are.

    Labels are counted and range sorted, each partition numbers its own, and one
    offset a partition is all that comes to the driver, so there may be any
    number of labels. The sorted table is written, so that its order stays.
    """
    spark = df.sparkSession
    counts = df.select(F.col(col).cast("string").alias("label")).where("label IS NOT NULL").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "labels")
    counts.orderBy(F.desc("n"), "label").select("label", F.monotonically_increasing_id().alias("at")).write.parquet(path)
    ranked = spark.read.parquet(path).select("label", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    sizes = sorted(ranked.groupBy("part").agg(F.max("place") + 1).collect())
    offsets, total = [], 0
    for part, size in sizes:
        offsets.append((part, total))
        total += size
    before = spark.createDataFrame(offsets, "part long, before long")
    numbered = ranked.join(F.broadcast(before), "part").select("label", (F.col("before") + F.col("place")).alias("number"))
    return numbered, total


def index(
    df: DataFrame, cols: Sequence[str], invalid: str = "keep", max_labels: int | None = None
) -> DataFrame:
    """Label numbers by falling count, ties by name, joined to the rows; no list of labels on the driver.

    A missing label gets a number of its own after all others (``keep``), is an
    ``error``, or its row is left out (``skip``). ``max_labels`` refuses columns with more.
    """
    if invalid not in ("keep", "error", "skip"):
        raise ValueError("invalid must be keep, error or skip")
    if max_labels is not None:
        check_labels(df, cols, max_labels)
    for c in cols:
        numbers, total = label_numbers(df, c)
        numbers = numbers.toDF("__label", "__number")
        joined = df.join(numbers, F.col(c).cast("string") == F.col("__label"), "inner" if invalid == "skip" else "left")
        missing = F.lit(total) if invalid == "keep" else F.raise_error(F.lit(f"missing label in {c}")).cast("long")
        values = total + (invalid == "keep")
        number = F.when(F.col("__number").isNotNull(), F.col("__number")).otherwise(missing).cast("double")
        slot = {"ml_attr": {"type": "nominal", "num_vals": values, "name": f"{c}_index"}}
        df = joined.withColumn(f"{c}_index", number).withMetadata(f"{c}_index", slot).drop("__label", "__number")
    return df


def one_hot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Indicator vectors from index columns; the last slot (the unseen one) is dropped.

    Slots are named, but not those of columns with more than ``NAMED_SLOTS`` labels.
    """
    wide = {c: n - 1 for c in cols if (n := _noted(df, f"{c}_index", "num_vals") or 0) > NAMED_SLOTS}
    narrow = [c for c in cols if c not in wide]
    if narrow:
        encoder = OneHotEncoder(inputCols=[f"{c}_index" for c in narrow], outputCols=[f"{c}_vec" for c in narrow])
        df = encoder.fit(df).transform(df)
    if not wide:
        return df
    for c, size in wide.items():
        df = df.withColumn(f"{c}_vec", _indicator(size)(f"{c}_index")).withMetadata(f"{c}_vec", _unnamed(size))
    others = [c for c in df.columns if c not in {f"{c}_vec" for c in cols}]
    return df.select(*others, *[f"{c}_vec" for c in cols])


def _noted(df: DataFrame, col: str, what: str) -> int | None:
    """A size that the stages before noted with a column."""
    found = df.schema[col].metadata.get("ml_attr", {}).get(what)
    return None if found is None else int(found)


def _unnamed(size: int) -> dict:
    return {"ml_attr": {"num_attrs": size}}


def _indicator(size: int):
    @F.udf(VectorUDT())
    def vector(slot):
        if slot is None or not 0 <= slot <= size:
            raise ValueError(f"no slot for label number {slot}")
        return Vectors.sparse(size, [] if slot == size else [int(slot)], [] if slot == size else [1.0])

    return vector


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", invalid: str = "error") -> DataFrame:
    """Columns to one vector. Nulls are an error unless ``invalid`` says skip or keep.

    Slots are named after their columns, up to ``NAMED_SLOTS`` of them.
    """
    if invalid not in ("error", "skip", "keep"):
        raise ValueError("invalid must be error, skip or keep")
    sizes = [_noted(df, c, "num_attrs") if df.schema[c].dataType == VectorUDT() else 1 for c in cols]
    if None in sizes or sum(sizes) <= NAMED_SLOTS:
        return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid).transform(df)
    parts = [F.col(c) if df.schema[c].dataType == VectorUDT() else F.col(c).cast("double") for c in cols]
    if invalid == "skip":
        gaps = [p.isNull() if df.schema[c].dataType == VectorUDT() else p.isNull() | F.isnan(p) for c, p in zip(cols, parts)]
        df = df.filter(~reduce(or_, gaps))
    return df.withColumn(out, _joined(sizes, invalid == "keep")(*parts)).withMetadata(out, _unnamed(sum(sizes)))


def _joined(sizes: Sequence[int], keep: bool):
    """Vectors and numbers of these sizes as one vector, sparse where that is shorter."""
    total = sum(sizes)

    @F.udf(VectorUDT())
    def vector(*parts):
        slots, values, start = [], [], 0
        for size, part in zip(sizes, parts):
            if part is None or part != part:
                if not keep:
                    raise ValueError("a value to assemble is null or not a number")
                at, found = range(size), [float("nan")] * size
            elif isinstance(part, SparseVector):
                at, found = part.indices.tolist(), part.values.tolist()
            elif isinstance(part, DenseVector):
                at, found = range(size), part.toArray().tolist()
            else:
                at, found = [0], [part]
            for i, v in zip(at, found):
                if v != 0:
                    slots.append(start + i)
                    values.append(v)
            start += size
        whole = Vectors.sparse(total, slots, values)
        return whole if 12 * len(slots) + 20 < 8 * total + 8 else Vectors.dense(whole.toArray())

    return vector


def standardise(df: DataFrame, col: str, out: str = "scaled") -> DataFrame:
    """Vector slots less their mean, over their sample deviation."""
    scaler = StandardScaler(inputCol=col, outputCol=out, withMean=True, withStd=True)
    return scaler.fit(df).transform(df)


def split(
    df: DataFrame, key: str, share: float = 0.7, seed: int = 42, bucket: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key, so a row keeps its side under any layout.

    ``bucket`` replaces the hash by an expression with values from 0 to 99.
    """
    if bucket is None:
        bucket = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(100))
    in_train = bucket < round(share * 100)
    return df.filter(in_train), df.filter(~in_train)


def feature_stages(cat: Sequence[str], num: Sequence[str], label: str | None = None) -> list:
    """Stages that index and encode the text columns and assemble all features."""
    stages = []
    if label:
        stages.append(StringIndexer(inputCol=label, outputCol="label"))
    if cat:
        indexes, vectors = [f"{c}_index" for c in cat], [f"{c}_vec" for c in cat]
        stages.append(StringIndexer(inputCols=list(cat), outputCols=indexes, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexes, outputCols=vectors))
    inputs = [f"{c}_vec" for c in cat] + list(num)
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def feature_pipeline(cat: Sequence[str], num: Sequence[str], label: str | None = None) -> Pipeline:
    """The feature stages as one estimator, to be fitted on training rows only."""
    return Pipeline(stages=feature_stages(cat, num, label))
