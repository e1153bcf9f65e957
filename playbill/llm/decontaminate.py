"""Benchmark decontamination by a positional inverted index of rare test terms.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbill.llm.groups import pick, stored

WINDOW = 13
# Rarest terms of each window that must stand at their places.
RARE = 2
# Rows of a table of terms that may be broadcast; a row has a word and a few numbers.
BROADCAST_TERMS = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words: ASCII letters in lower case, digits, and all beyond ASCII. Null for null."""
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), "")


def _small(terms: DataFrame) -> DataFrame:
    """Broadcast a stored table of terms if it is small; else leave it to a shuffled join."""
    few = terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    return F.broadcast(terms) if few else terms.hint("merge")


class PositionalIndex:
    """Postings (row, pos, term) of the test terms that are rarest in the documents.

    ``tokens`` has each distinct document row with its words; ``items`` the
    benchmark's; ``anchors`` the rare terms of each item with their places: of
    every window of the item the ``RARE`` terms with the fewest occurrences in
    all documents. A window with a term that no document has cannot occur and
    has none.
    """

    def __init__(self, docs: DataFrame, benchmark: DataFrame, key: str, text: str, item: str, item_text: str, window: int):
        self.window = window
        row = F.xxhash64(F.lit(1), docs[key], docs[text])
        words = docs.select(row.alias("row"), words_of(docs[text]).alias("words"))
        self.tokens = stored(words.select("row", "words", F.coalesce(F.size("words").cast("long"), F.lit(0)).alias("n_words")), "tokens")
        name = benchmark[item].cast("string")
        items = benchmark.select(F.xxhash64(F.lit(2), name, item_text).alias("item_row"), name.alias("item"), words_of(benchmark[item_text]).alias("own"))
        self.items = stored(items.where(F.size("own") > 0).dropDuplicates(["item_row"]), "items")
        places = self.items.select("item_row", F.size("own").alias("size"), F.posexplode("own").alias("place", "term"))
        vocabulary = stored(places.select("term").distinct(), "vocabulary")
        self._spelled = self.tokens.select("row", F.posexplode("words").alias("pos", "term"))
        counted = self._spelled.select("term").join(_small(vocabulary), "term").groupBy("term").agg(F.count("*").alias("n"))
        known = places.join(counted, "term", "left")
        span = F.least(F.col("size"), F.lit(window))
        starts = F.sequence(F.greatest(F.lit(0), F.col("place") - span + 1), F.least(F.col("place"), F.col("size") - span))
        per_window = Window.partitionBy("item_row", "start")
        ranked = (
            known.withColumn("start", F.explode(starts))
            .withColumn("absent", F.max(F.col("n").isNull()).over(per_window))
            .withColumn("rank", F.row_number().over(per_window.orderBy("n", "term", "place")))
        )
        rare = ranked.where(~F.col("absent") & (F.col("rank") <= RARE))
        need = F.least(F.lit(RARE), F.col("size")).alias("need")
        self.anchors = stored(rare.select("term", "item_row", "place", need).distinct(), "anchors")
        terms = stored(self.anchors.select("term").distinct(), "terms")
        self.postings = stored(self._spelled.join(_small(terms), "term"), "postings")

    def offsets(self) -> DataFrame:
        """(row, item_row, offset, place, need): where the item would begin, by each rare term found."""
        joined = self.postings.join(_small(self.anchors), "term")
        return joined.select("row", "item_row", (F.col("pos") - F.col("place")).alias("offset"), "place", "need")

    def alignments(self) -> DataFrame:
        """(row, item_row, offset) on which enough rare terms agree."""
        agree = self.offsets().groupBy("row", "item_row", "offset").agg(F.count("*").alias("n"), F.min("need").alias("need"))
        return agree.where("n >= need").select("row", "item_row", "offset")

    def phrases(self) -> DataFrame:
        """(row, item, offset, size, starts): windows of the item that stand there word by word.

        Starts count from the item's first word.
        """
        found = stored(self.alignments(), "alignments")
        rows = stored(found.select("row").distinct(), "rows")
        texts = pick(self.tokens.select("row", "words"), rows, "row").groupBy("row").agg(F.first("words").alias("words"))
        both = found.join(texts, "row").join(self.items, "item_row").withColumn("size", F.least(F.size("own"), F.lit(self.window)))
        first = F.greatest(F.lit(0), -F.col("offset"))
        last = F.least(F.size("own"), F.size("words") - F.col("offset")) - F.col("size")

        def same(s: Column) -> Column:
            return F.slice("words", F.col("offset") + s + 1, F.col("size")) == F.slice("own", s + 1, F.col("size"))

        starts = F.when(first <= last, F.filter(F.sequence(first, last), same))
        return both.select("row", "item", "offset", "size", starts.alias("starts")).where(F.size("starts") > 0)

    def proximity(self, slop: int, share: float = 0.8) -> DataFrame:
        """(row, item, offset, n_terms): items most of whose rare terms stand near their places.

        The rare terms may be off by up to ``slop`` words in all; at least
        ``share`` of an item's anchors must be found. Offset is the last one.
        """
        near = Window.partitionBy("row", "item_row").orderBy("offset").rangeBetween(-slop, 0)
        found = self.offsets().withColumn("places", F.size(F.collect_set("place").over(near)))
        best = found.groupBy("row", "item_row").agg(F.max(F.struct("places", "offset")).alias("best"))
        total = self.anchors.groupBy("item_row").agg(F.count("*").alias("total"))
        kept = best.join(total, "item_row").where(F.col("best.places") >= share * F.col("total"))
        return kept.join(self.items, "item_row").select("row", "item", "best.offset", F.col("best.places").alias("n_terms"))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """How much of each document stands in windows of benchmark items.

    A window is ``window`` words of an item in a row, or the whole of a shorter
    item. Adds to the input columns: n_words, n_hit (words inside any occurrence
    of a window), n_items, items (their ids as sorted strings), contaminated (hit
    words are a twentieth or more).

    One output row per input row; null and empty texts have no words and are
    clean. Items without words match nothing; items of one id count once, an
    item without id counts as hit words only. Repeated rows get equal results.
    Either table may be empty.
    """
    index = PositionalIndex(docs, benchmark, key, text, item, item_text, window)
    hits = index.phrases()
    spots = F.flatten(F.transform("starts", lambda s: F.sequence(F.col("offset") + s, F.col("offset") + s + F.col("size") - 1)))
    per_row = (
        hits.select("row", "item", spots.alias("spots"))
        .groupBy("row")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("spots")))).cast("long").alias("__hit"),
            F.sort_array(F.collect_set("item")).alias("__items"),
        )
    )
    sizes = index.tokens.groupBy("row").agg(F.first("n_words").alias("__words"))
    marks = sizes.join(per_row, "row", "left").withColumnRenamed("row", "__row")
    out = docs.withColumn("__row", F.xxhash64(F.lit(1), docs[key], docs[text])).join(marks, "__row", "left")
    n, hit = F.col("__words"), F.coalesce("__hit", F.lit(0).cast("long"))
    items = F.coalesce("__items", F.array().cast("array<string>"))
    new = {"n_words": n, "n_hit": hit, "n_items": F.size(items).cast("long"), "items": items, "contaminated": (hit > 0) & (20 * hit >= n)}
    return out.select(*(F.col(c) for c in docs.columns if c not in new), *(v.alias(c) for c, v in new.items()))
