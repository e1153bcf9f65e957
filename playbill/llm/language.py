"""Language of a text by prediction by partial matching over bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playbill.llm.tasks import map_text, text_batches

ORDER = 3
# Symbols: 0 stands before the text, 1 is a byte no training text has.
_PAD, _OTHER = 0, 1


class ByteTrees:
    """Frozen code lengths (in nats) of each next byte, for all languages at once.

    A context tree per language, up to ORDER bytes deep. A byte not seen after a
    context costs the escape of that context and is then coded one byte
    shallower; below the empty context all 256 bytes are alike. The escape has
    the weight of the number of different bytes seen there.

    ``tables[k][c]`` holds the code lengths after context ``c`` of ``k`` bytes
    (numbered over all languages); ``steps[k]`` leads from a context number and
    the byte before it to the longer context, or -1 where no language has it.
    """

    def __init__(self, counts: list[tuple[str, bytes, int, int]]):
        """``counts``: (language, context of ORDER symbols, next symbol, how often)."""
        self.langs = sorted({c[0] for c in counts})
        seen = sorted({x for c in counts for x in (*c[1], c[2])} - {_PAD})
        self.classes = np.full(256, _OTHER, np.int64)
        for i, x in enumerate(seen):
            self.classes[x - 2] = i + 2
        self.width = len(seen) + 2
        where = {_PAD: _PAD} | {x: i + 2 for i, x in enumerate(seen)}
        n_langs = len(self.langs)
        lang = np.array([self.langs.index(c[0]) for c in counts], np.int64)
        ctx = np.array([[where[x] for x in c[1]] for c in counts], np.int64).reshape(-1, ORDER)
        sym = np.array([where[c[2]] for c in counts], np.int64)
        times = np.array([c[3] for c in counts], float)
        table = np.full((1, self.width, n_langs), np.log(256.0))
        names = np.zeros(len(counts), np.int64)
        self.steps: list[np.ndarray] = []
        tables = []
        for k in range(ORDER + 1):
            if k:
                # A longer context: the shorter one's number and one more byte before it.
                long = names * self.width + ctx[:, ORDER - k]
                codes, names = np.unique(long, return_inverse=True)
                step = np.full(len(tables[-1]) * self.width, -1, np.int32)
                step[codes] = np.arange(len(codes))
                self.steps.append(step)
                table = tables[-1][codes // self.width].astype(float)
            n = len(table)
            seen_here = np.zeros((n, self.width, n_langs))
            np.add.at(seen_here, (names, sym, lang), times)
            total = seen_here.sum(1, keepdims=True)
            kinds = (seen_here > 0).sum(1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log(kinds / (total + kinds)), 0.0)
                direct = -np.log(seen_here / (total + kinds))
            table = np.where(seen_here > 0, direct, table + escape)
            tables.append(table.astype(np.float32))
        self.tables = [t.reshape(-1, n_langs) for t in tables]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Exact code length of each whole text under each language."""
        sizes = np.array([len(t) for t in texts], np.int64)
        glue = bytes(0)
        raw = np.frombuffer(glue.join(texts), np.uint8)
        sym = np.zeros(len(raw) + ORDER * len(texts), np.int64)
        begins = np.cumsum(sizes + ORDER) - sizes
        spots = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(raw))
        sym[spots] = self.classes[raw]
        out = np.zeros((len(texts), len(self.langs)))
        context = np.zeros(len(raw), np.int64)
        depth = np.zeros(len(raw), np.int8)
        alive = np.ones(len(raw), bool)
        for k in range(ORDER):
            longer = self.steps[k][context * self.width + sym[spots - 1 - k]]
            alive &= longer >= 0
            context = np.where(alive, longer, context)
            depth += alive
        owner = np.repeat(np.arange(len(texts)), sizes)
        for k in range(ORDER + 1):
            at = np.flatnonzero(depth == k)
            if len(at):
                cost = self.tables[k][context[at] * self.width + sym[spots[at]]]
                for j in range(len(self.langs)):
                    out[:, j] += np.bincount(owner[at], weights=cost[:, j], minlength=len(texts))
        return out


def context_counts(docs: DataFrame, key: str, text: str, label: str, per_label: int) -> DataFrame:
    """(label, context, symbol, times) of ORDER-byte contexts over a sample of texts.

    The sample is bounded: of each label the ``per_label`` rows with the smallest
    hash of the key. Counts are combined in the tasks before the shuffle.
    """
    rows_of = docs.where(docs[label].isNotNull() & docs[text].isNotNull()).select(
        docs[label].alias("label"), docs[text].alias("text"), F.xxhash64(docs[key].cast("string")).alias("h")
    )
    order = Window.partitionBy("label").orderBy("h")
    # First the cut alone, so that no text is sorted; then equal hashes are broken.
    first = rows_of.select("label", "h").withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_label)
    # One number a language comes to the driver, so the texts are only filtered.
    cuts = first.groupBy("label").agg(F.max("h").alias("cut")).collect()
    wanted = F.lit(False)
    for r in cuts:
        wanted = wanted | ((F.col("label") == r["label"]) & (F.col("h") <= r["cut"]))
    few = rows_of.where(wanted).withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_label)

    def rows(batches):
        for batch, texts in text_batches(batches, "text"):
            labels = batch.column(0).to_pylist()
            for name in sorted(set(labels)):
                grams = []
                for own, t in zip(labels, texts):
                    if own == name and t:
                        raw = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64) + 2
                        padded = np.concatenate((np.zeros(ORDER, np.int64), raw))
                        code = np.zeros(len(raw), np.int64)
                        for k in range(ORDER + 1):
                            code = code * 258 + padded[k : k + len(raw)]
                        grams.append(code)
                if grams:
                    codes, times = np.unique(np.concatenate(grams), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(codes)), pa.array(codes), pa.array(times.astype(np.int64))],
                        ["label", "gram", "times"],
                    )

    partial = map_text(few.select("label", "text"), rows, "label string, gram long, times long")
    return partial.groupBy("label", "gram").agg(F.sum("times").alias("times"))


def fit_trees(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", per_label: int = 400) -> ByteTrees | None:
    """Trees of the labelled rows; None where there are none.

    What comes to the driver are the counts of at most ``per_label`` texts of each
    language, so its size does not follow the table.
    """
    rows = context_counts(docs, key, text, label, per_label).collect()
    counts = []
    for r in rows:
        gram, symbols = r["gram"], []
        for _ in range(ORDER + 1):
            symbols.append(gram % 258)
            gram //= 258
        symbols.reverse()
        counts.append((r["label"], tuple(symbols[:ORDER]), symbols[ORDER], r["times"]))
    return ByteTrees(sorted(counts)) if counts else None


def predict_language(docs: DataFrame, trees: ByteTrees | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Language of each whole text: the one whose trees code it in the fewest bits.

    Adds lang_pred and score, the posterior of that language when all are equally
    likely at first. Ties go to the first name. A text that is null or has no
    letter is ``und`` with score 0; so is every text if nothing was learned.
    Returns the ``keep`` columns and these two, one row per input row.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(trees)

    def rows(batches):
        trees = model.value
        for batch, texts in text_batches(batches, "__text"):
            known = np.array([trees is not None and any(map(str.isalpha, t)) for t in texts], bool)
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            if known.any():
                at = np.flatnonzero(known)
                cost = trees.code_lengths([texts[i].encode("utf-8", "surrogatepass") for i in at])
                best = cost.argmin(1)
                with np.errstate(under="ignore"):
                    scores[at] = 1 / np.exp(cost.min(1, keepdims=True) - cost).sum(1)
                for i, b in zip(at, best):
                    names[i] = trees.langs[b]
            arrays = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(names), pa.array(scores)], [*keep, "lang_pred", "score"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    source = docs.select(*(docs[c] for c in keep), docs[text].alias("__text"))
    return map_text(source, rows, f"{fields}, lang_pred string, score double")
