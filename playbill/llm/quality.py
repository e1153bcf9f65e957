"""Quality by hierarchical empirical Bayes: what a text shows, and where it was found."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.llm.groups import stored
from playbill.llm.tasks import map_text, text_batches

# Labelled rows the text classifier is fitted on: the documented bound of the fit.
TRAIN_ROWS = 20_000
# Words that enter the classifier, the ones most unevenly spread over the labels.
TELLING_WORDS = 100
_LEAST_DOCS = 10
# Rows of a site table that may be broadcast.
_FEW_SITES = 200_000
_SYMBOLS = b"#*$%&|<>{}[]=_~^@"


def _shape(raw: bytes, words: list[bytes]) -> list[float]:
    """What a text looks like, as shares and logarithms."""
    n, size = max(1, len(words)), max(1, len(raw))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    return [
        math.log1p(len(words)) / 5,
        min(1.0, 5 * symbols / size),
        min(1.0, 2 * upper / size),
        min(1.0, 5 * digits / size),
        min(2.0, len(raw) / n / 8),
        len(set(words)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        min(1.0, 20 * (raw.count(b"!") + raw.count(b"?")) / size),
        min(1.0, max(map(len, words), default=0) / 100),
        float(not words),
        float(len(words) < 20),
    ]


def _words(text: str) -> tuple[bytes, list[bytes]]:
    raw = text.encode("utf-8", "surrogatepass")
    return raw, raw.split()


def _plain(words: list[bytes]) -> set[bytes]:
    return {w.strip(b".,;:!?()\"'").lower() for w in words}


def _telling_words(train: DataFrame) -> list[bytes]:
    """Words whose share of documents differs most between good and bad (chi-square)."""

    def rows(batches):
        for batch, texts in text_batches(batches, "text"):
            good: Counter[bytes] = Counter()
            bad: Counter[bytes] = Counter()
            for y, t in zip(batch.column(0).to_pylist(), texts):
                (good if y else bad).update(_plain(_words(t)[1]))
            names = sorted((good | bad).keys())
            arrays = [pa.array(names, pa.binary()), *(pa.array([c[w] for w in names], pa.int64()) for c in (good, bad))]
            yield pa.RecordBatch.from_arrays(arrays, ["word", "good", "bad"])

    counts = map_text(train.select("good", "text"), rows, "word binary, good long, bad long")
    total = train.agg(F.sum("good").alias("g"), F.sum(1 - F.col("good")).alias("b")).first()
    g, b = float(total["g"] or 0) + 1, float(total["b"] or 0) + 1
    n = F.col("good") + F.col("bad")
    off = F.col("good") - n * (g / (g + b))
    found = counts.groupBy("word").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).where(n >= _LEAST_DOCS)
    best = found.orderBy((off * off / n).desc(), "word").limit(TELLING_WORDS)
    return [bytes(r["word"]) for r in best.collect()]


def text_features(docs: DataFrame, words: list[bytes], keep: list[str]) -> DataFrame:
    """The ``keep`` columns and the features of ``text`` as an array."""
    place = {w: i for i, w in enumerate(words)}

    def rows(batches):
        for batch, texts in text_batches(batches, "text"):
            out = []
            for t in texts:
                raw, own = _words(t)
                row = np.zeros(len(place))
                row[[place[w] for w in _plain(own) if w in place]] = 1
                out.append(np.concatenate((_shape(raw, own), row)))
            arrays = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(out, pa.list_(pa.float64()))], [*keep, "x"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_text(docs.select(*keep, "text"), rows, f"{fields}, x array<double>")


class TextClassifier:
    """Log-odds of a good text; without labels of both kinds it says nothing."""

    def __init__(self, train: DataFrame):
        """``train``: good (0 or 1) and text, of at most TRAIN_ROWS rows."""
        kinds = {r["good"]: r["n"] for r in train.groupBy("good").agg(F.count("*").alias("n")).collect()}
        self.words: list[bytes] = []
        self.weights, self.intercept = np.zeros(11), 0.0
        if len(kinds) < 2:
            return
        self.words = _telling_words(train)
        table = text_features(train, self.words, ["good"]).select(array_to_vector("x").alias("features"), F.col("good").cast("double").alias("label"))
        model = LogisticRegression(regParam=1e-3, maxIter=60).fit(table)
        self.weights = np.array(model.coefficients.toArray())
        # Evidence is what the text adds to the share of good rows it was trained on.
        self.intercept = float(model.intercept) - math.log(kinds[1] / kinds[0])

    def evidence(self, x: Column) -> Column:
        w = F.array(*(F.lit(float(v)) for v in self.weights))
        return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(self.intercept), lambda a, v: a + v)


def _logit(p: Column) -> Column:
    q = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(q / (1 - q))


def _strength(groups: DataFrame) -> float:
    """How many documents the prior of a level is worth, by the method of moments.

    Groups (n, s: documents and their summed chances) that differ no more than
    chance does make a strong prior, groups that differ widely a weak one.
    """
    rate = F.col("s") / F.col("n")
    r = groups.agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("k"), F.sum(F.col("n") * rate * rate).alias("q")
    ).first()
    if not r["n"]:
        return 1.0
    mean = r["s"] / r["n"]
    spread = r["q"] / r["n"] - mean * mean
    chance = mean * (1 - mean)
    between = spread - chance * r["k"] / r["n"]
    return float(min(1_000.0, max(1.0, chance / between - 1))) if between > 0 else 1_000.0


def _few(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.limit(_FEW_SITES + 1).count() <= _FEW_SITES else table


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    good: Column,
    key: str = "doc_id",
    text: str = "text",
    least: float = 0.3,
) -> DataFrame:
    """Posterior chance that each document is good, from its text and its site.

    ``good`` is a 0/1 expression over the columns of ``labels``, which has the
    key; ``host`` and ``path`` are expressions over ``docs``. A classifier of the
    text is fitted on at most TRAIN_ROWS labelled rows, those with the smallest
    hash of their key. Its chances are summed by path, host and over all in
    grouped aggregates; the rate of a host is shrunk toward the global rate and
    that of a path toward its host's, each by a prior whose strength comes from
    how much groups differ. The document's own evidence then meets the rate of
    its path, from which its own share is left out.

    One output row per input row: key, evidence, host_rate, path_rate, score (0
    to 1) and kept (score is ``least`` or more). A null host or path is a site
    of its own; null text is empty; labels that repeat count once, by the worst;
    labels of no document are left out. Without labels of both kinds texts say
    nothing and every score is one half. An empty table gives no row.
    """
    known = labels.select(F.col(key).alias("k"), good.cast("int").alias("good")).where("good is not null").groupBy("k").agg(F.min("good").alias("good"))
    sample = known.orderBy(F.xxhash64(F.col("k").cast("string")), "k").limit(TRAIN_ROWS)
    train = docs.select(docs[key].alias("k"), docs[text].alias("text")).join(F.broadcast(sample), "k").select("good", "text")
    model = TextClassifier(stored(train, "train"))
    site = docs.select(docs[key].alias("k"), F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(path.cast("string"), F.lit("")).alias("path"), docs[text].alias("text"))
    seen = text_features(site, model.words, ["k", "host", "path"]).select("k", "host", "path", model.evidence(F.col("x")).alias("evidence"))
    seen = stored(seen.withColumn("p", 1 / (1 + F.exp(-F.col("evidence")))), "evidence")
    paths = stored(seen.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    total = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    prior = total["s"] / total["n"] if total["n"] else 0.5
    k_host = _strength(hosts.select(F.col("host_n").alias("n"), F.col("host_s").alias("s")))
    k_path = _strength(paths)
    hosts = hosts.withColumn("host_rate", (F.col("host_s") + k_host * prior) / (F.col("host_n") + k_host))
    sites = stored(paths.join(hosts.select("host", "host_rate"), "host"), "sites")
    both = seen.join(_few(sites), ["host", "path"])
    own = (F.col("s") - F.col("p") + k_path * F.col("host_rate")) / (F.col("n") - 1 + k_path)
    score = 1 / (1 + F.exp(-(F.col("evidence") + _logit(own))))
    out = both.select(F.col("k").alias(key), "evidence", "host_rate", own.alias("path_rate"), score.alias("score"))
    return out.withColumn("kept", F.col("score") >= least)
