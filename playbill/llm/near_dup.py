"""Near duplicates: MinHash bands, Bayesian pruning on signature batches, exact check."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.llm.groups import freed, linked_groups, pick, stored
from playbill.llm.tasks import map_text, text_batches

WORDS = 5
PERCENT = 75
# 40 bands of 6 rows find a pair of similarity 0.75 but for 4 in 10,000 cases.
BANDS, ROWS = 40, 6
# Signature values; each leaves BITS bits in a sketch of longs, compared in batches.
VALUES, BITS = 256, 2
BATCHES = (2, 4, 8)
# Values of the longer sketch, computed where pairs across groups are left.
MORE_VALUES = 2048
# Chance that a batch rejects a pair although its similarity reaches the threshold.
MISS = 1e-5

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MEMORY = 500_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _WordHashes(dict):
    """64-bit hashes of words, kept while a word may come again."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str, memory: _WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text."""
    own = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not own:
        return np.zeros(0, np.uint64)
    if len(memory) > _MEMORY:
        memory.clear()
    h = np.fromiter(map(memory.__getitem__, own), np.uint64, len(own))
    size = min(words, len(h))
    total = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - size + 1 + k]
    return np.unique(_mix(total))


def _permutations(values: int = VALUES) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(values)
    a = rng.integers(0, 1 << 32, values, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    return a[:, None], rng.integers(0, 1 << 32, values, dtype=np.uint64).astype(np.uint32)[:, None]


def _least(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), np.uint32(0xFFFFFFFF))
    step = max(1, 500_000 // len(a))
    for i in range(0, len(x), step):
        np.minimum(out, (a * x[None, i : i + step] + b).min(1), out=out)
    return out


def _bands(least: np.ndarray) -> np.ndarray:
    own = least[:, : BANDS * ROWS].reshape(len(least), BANDS, ROWS).astype(np.uint64)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), own.shape[:2]).copy()
    for k in range(ROWS):
        total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + own[:, :, k])
    return total.view(np.int64)


def _sketches(least: np.ndarray) -> np.ndarray:
    few = ((least * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.uint64)
    per_long = 64 // BITS
    few = few.reshape(len(least), -1, per_long) << (np.arange(per_long, dtype=np.uint64) * np.uint64(BITS))
    return np.bitwise_or.reduce(few, axis=2).view(np.int64)


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, set_key, bands, sketch) of each row; empty lists without shingles."""

    def rows(batches):
        import xxhash

        memory = _WordHashes()
        a, b = _permutations()
        for batch, texts in text_batches(batches, "text"):
            sizes, keys, least = [], [], []
            for t in texts:
                own = shingle_set(t, memory)
                sizes.append(len(own))
                keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                least.append(_least(own, a, b))
            least = np.array(least, np.uint32)
            some = np.array(sizes) > 0
            bands, sketches = _bands(least), _sketches(least)
            longs = pa.list_(pa.int64())
            arrays = [
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                pa.array([list(x) if s else [] for x, s in zip(bands, some)], longs),
                pa.array([list(x) if s else [] for x, s in zip(sketches, some)], longs),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_shingles", "set_key", "bands", "sketch"])

    source = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"))
    return map_text(source, rows, "id long, n_shingles long, set_key binary, bands array<long>, sketch array<long>")


def allowed_differences(values: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """Most signature values of ``values`` that may differ.

    With one more, the posterior chance that the similarity reaches the threshold
    falls below ``miss`` (all similarities alike beforehand).
    """
    s = (np.arange(4000) + 0.5) / 4000
    same = s + (1 - s) / 2**BITS
    for differ in range(values + 1):
        log = (values - differ) * np.log(same) + differ * np.log1p(-same)
        weight = np.exp(log - log.max())
        if weight[s >= percent / 100].sum() / weight.sum() < miss:
            return differ - 1
    return values


def close_sketches(a: Column, b: Column) -> Column:
    """Sequential test: after each batch, stop if too many values differ so far."""
    per_long, tests, differ = 64 // BITS, None, F.lit(0)
    for i in range(max(BATCHES)):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differ = differ + F.bit_count(x)
        if i + 1 in BATCHES:
            own = differ <= allowed_differences((i + 1) * per_long)
            tests = own if tests is None else tests & own
    return tests


def closer_sketches(a: Column, b: Column) -> Column:
    """The same test on the longer sketches."""
    low = F.lit(0x5555555555555555)

    def differ(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        return F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(low))

    total = F.aggregate(F.zip_with(a, b, differ), F.lit(0), lambda n, d: n + d)
    return total <= allowed_differences(MORE_VALUES)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of documents whose sets of five-word shingles overlap by 75 percent or more.

    One output row per input row: key, n_shingles, component_id (the smallest key
    reached over links) and kept (whether that is the row's own). Equal sets are
    one class with one representative before anything is compared; candidates
    share a MinHash band; pairs are pruned by the posterior bound on batches of
    their signatures and checked on full sets at the end.

    Texts without words (null, empty, white space) link with nothing. A text of
    fewer than five words is one shingle. Rows with the same key are one
    document, linked by each of their texts. A row without key links with nothing
    and has no component; it is kept. Keys are integers; other columns are not
    read; an empty table gives no row.
    """
    with freed(docs.sparkSession):
        return stored(_grouped(docs, key, text), "near", keep=True)


def _grouped(docs: DataFrame, key: str, text: str) -> DataFrame:
    marks = stored(signatures(docs, key, text), "signatures")
    some = marks.where("n_shingles > 0 and id is not null")
    # A class is one set. It goes by the smallest document that has it or, where that
    # document has several sets, by a number below all keys.
    classes = some.groupBy("set_key").agg(F.min("id").alias("rep"))
    low = min(0, some.agg(F.min("id")).first()[0] or 0)
    single = classes.groupBy("rep").agg(F.count("*").alias("n"))
    number = F.when(F.col("n") == 1, F.col("rep")).otherwise(F.lit(low) - 1 - F.monotonically_increasing_id())
    classes = stored(classes.join(single, "rep").select("set_key", "rep", number.alias("class")), "classes")
    reps = some.join(classes, "set_key").where("id = rep").dropDuplicates(["class"])
    reps = stored(reps.select(F.col("class").alias("id"), "bands", "sketch"), "reps")
    buckets = reps.select(F.explode("bands").alias("bucket"), "id")
    # Only where one key has several texts: their classes belong together.
    texts_of = some.join(classes, "set_key").groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("b"), F.collect_set("class").alias("all"))
    known = texts_of.where("a < b").select("a", F.explode("all").alias("b")).where("a <> b")

    texts = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"))

    def of_classes(ids: DataFrame, name: str, work) -> DataFrame:
        """(id, ``name``) of classes: ``work`` turns a list of shingle sets into an array of longs each."""

        def rows(batches):
            import xxhash

            memory = _WordHashes()
            for batch, own in text_batches(batches, "text"):
                sets = [shingle_set(t, memory) for t in own]
                keys = pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([keys, pa.array(work(sets), pa.list_(pa.int64()))], ["set_key", name])

        wanted = stored(classes.join(ids.withColumnRenamed("id", "class"), "class", "left_semi"), "wanted")
        near = pick(texts, stored(wanted.select(F.col("rep").alias("id")).distinct(), "ids"), "id")
        found = map_text(near, rows, f"set_key binary, {name} array<long>").join(wanted, "set_key")
        return stored(found.select(F.col("class").alias("id"), name).dropDuplicates(["id"]), name)

    def refine(ids: DataFrame) -> DataFrame:
        a, b = _permutations(MORE_VALUES)
        return of_classes(ids, "more", lambda sets: list(_sketches(np.array([_least(x, a, b) for x in sets], np.uint32))))

    def confirm(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        sets = of_classes(ids, "shingles", lambda sets: [x.view(np.int64) for x in sets])
        a, b = sets.toDF("a", "x"), sets.toDF("b", "y")
        both = F.size(F.array_intersect("x", "y"))
        full = pairs.join(a, "a").join(b, "b").withColumn("both", both)
        return full.where(100 * F.col("both") >= PERCENT * (F.size("x") + F.size("y") - F.col("both"))).select("a", "b").distinct()

    groups = linked_groups(buckets, reps.select("id", "sketch"), close_sketches, confirm, known, refine, closer_sketches)
    grouped = classes.join(groups.withColumnRenamed("id", "class"), "class", "left").withColumn("label", F.coalesce("component", "class"))
    least = grouped.where("component is not null").groupBy("label").agg(F.min("rep").alias("least"))
    of_set = grouped.join(least, "label", "left").select("set_key", F.coalesce("least", "rep").alias("component"))
    found = marks.select("id", "n_shingles", "set_key").join(of_set, "set_key", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
    out = found.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col(key), F.lit(True)))
