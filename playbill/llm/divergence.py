"""How far sources of a language differ in their words: a cube of exact partial sums."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbill.llm.groups import stored
from playbill.llm.tasks import map_text

LEAST_DOCS, SMOOTHING, ONE = 30, 5, 1_000_000_000
TOP = 50
# Edges of a cell of the cube: groups on each side, and terms, on average.
GROUP_BLOCK, TERM_BLOCK = 64, 8_000
# Different (group, term) counts held by a task before they are sent on.
_HELD = 400_000

# A-Z become lower case, other letters and bytes beyond ASCII stay, the rest parts terms.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of a term in a group, and its documents with it.

    Counts are added up in the task that reads the texts. Every group that occurs
    also has a row with a null term and its number of documents.
    """

    def rows(batches):
        held: dict[tuple, Counter] = {}
        own_docs: dict[tuple, Counter] = {}
        size = 0

        def out():
            cells = [(g, t, n, own_docs[g][t]) for g, terms in held.items() for t, n in terms.items()]
            held.clear()
            own_docs.clear()
            for i in range(0, len(cells), 50_000):
                part = cells[i : i + 50_000]
                names = ["lang", "source", "term", "n", "docs"]
                arrays = [pa.array([c[0][0] for c in part], pa.string()), pa.array([c[0][1] for c in part], pa.string())]
                terms = pa.array([c[1] for c in part], pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays([*arrays, terms, pa.array([c[2] for c in part]), pa.array([c[3] for c in part])], names)

        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, t in enumerate(batch.column(2)):
                group = langs[i] or "", sources[i] or ""
                words = Counter((t.as_buffer().to_pybytes() if t.is_valid else b"").translate(_LETTERS).split(b" "))
                words.pop(b"", None)
                if group not in held:
                    held[group], own_docs[group] = Counter(), Counter()
                total = held[group]
                size -= len(total)
                total.update(words)
                own_docs[group].update(words.keys())
                total[None] = 0
                own_docs[group][None] += 1
                size += len(total)
                if size > _HELD:
                    yield from out()
                    size = 0
        yield from out()

    parted = map_text(docs.select(lang, source, text), rows, "lang string, source string, term string, n long, docs long")
    return parted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """Smoothed share of a term in whole parts of a thousand millionth, exact; at least 1."""
    over = F.lit(ONE).cast("decimal(38,0)") * (n + SMOOTHING).cast("decimal(20,0)")
    # The remainder is taken off first: a decimal quotient could be rounded up.
    under = (total + SMOOTHING * terms).cast("decimal(20,0)")
    return 1 + ((over - F.pmod(over, under)) / under).cast("long")


def _cell_sums(table: pa.Table) -> pa.Table:
    """Partial divergence of each pair of groups in a cell: one term block, two group blocks.

    Rows without a term tell of a group: its share for terms it doesn't have, and
    how many terms the block holds. No group on one side, no pairs.
    """
    if len(set(table.column("side").to_pylist())) < len({table.column("i")[0].as_py(), table.column("j")[0].as_py()}):
        return pa.table([pa.array([], t) for t in (pa.string(), pa.string(), pa.string(), pa.int64())], names=["lang", "a", "b", "value"])
    frame = table.select(["lang", "i", "j", "side", "source", "term", "p", "n_terms"]).to_pandas()
    heads, rows = frame[frame["term"].isna()], frame[frame["term"].notna()]
    i, j, lang, n_terms = heads["i"].iloc[0], heads["j"].iloc[0], heads["lang"].iloc[0], heads["n_terms"].iloc[0]
    codes, known = pd.factorize(rows["term"])
    shares = {}
    for side in {i, j}:
        own = heads[heads["side"] == side].sort_values("source")
        names, rest = list(own["source"]), own["p"].to_numpy(np.int64)
        at = rows["side"].to_numpy() == side
        dense = np.repeat(rest[:, None], len(known), 1)
        dense[np.searchsorted(np.array(names, object), rows["source"].to_numpy()[at]), codes[at]] = rows["p"].to_numpy(np.int64)[at]
        shares[side] = names, rest, dense
    (a, rest_a, x), (b, rest_b, y) = shares[i], shares[j]
    left, right, sums = [], [], []
    for k, name in enumerate(a):
        first = k + 1 if i == j else 0
        own = np.abs(y[first:] - x[k]).sum(1) + (n_terms - len(known)) * np.abs(rest_b[first:] - rest_a[k])
        left += [name] * len(own)
        right += b[first:]
        sums += own.tolist()
    arrays = [pa.array([lang] * len(left), pa.string()), pa.array(left, pa.string()), pa.array(right, pa.string()), pa.array(sums, pa.int64())]
    return pa.Table.from_arrays(arrays, ["lang", "a", "b", "value"])


class Divergence:
    """Shares of terms in the groups of each language, and what is derived from them.

    ``terms`` has the kept (lang, term, all), ``groups`` (lang, source, n), ``langs``
    (lang, groups, terms, total), ``shares`` (lang, source, term, n, p, q) for the
    terms a group has; all are stored tables.
    """

    def __init__(self, docs: DataFrame, lang: str, source: str, text: str, least_docs: int, group_block: int, term_block: int):
        self.group_block, self.term_block = group_block, term_block
        counts = stored(term_counts(docs, lang, source, text), "counts")
        found = counts.where("term is not null")
        kept = found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all")).where(F.col("docs") >= least_docs)
        kept = self.terms = stored(kept.select("lang", "term", "all"), "terms")
        own = stored(found.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "kept")
        every = counts.where("term is null").select("lang", "source")
        sizes = own.groupBy("lang", "source").agg(F.sum("n").alias("n"))
        self.groups = stored(every.join(sizes, ["lang", "source"], "left").na.fill(0, ["n"]), "groups")
        by_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all").alias("total"))
        langs = self.groups.groupBy("lang").agg(F.count("*").alias("groups"))
        self.langs = stored(langs.join(by_lang, "lang", "left").na.fill(0, ["terms", "total"]), "langs")
        totals = self.groups.withColumnRenamed("n", "size").join(self.langs, "lang")
        p, q = _share(F.col("n"), F.col("size"), F.col("terms")), _share(F.col("all"), F.col("total"), F.col("terms"))
        shares = own.join(totals, ["lang", "source"]).select("lang", "source", "term", "n", p.alias("p"), q.alias("q"))
        self.shares = stored(shares, "shares")

    def pairs(self) -> DataFrame:
        """(lang, source, item, value): each source of a language against each other one.

        Groups and terms are dealt to blocks by hash. A cell of the cube is two
        group blocks and a term block; it gets the slices of both, works out what
        its terms add to each pair, and sums along the terms follow.
        """
        most = self.langs.agg(F.max("groups"), F.max("terms")).first()
        group_blocks = -(-(most[0] or 1) // self.group_block)
        term_blocks = max(1, -(-(most[1] or 1) // self.term_block))
        side = F.pmod(F.xxhash64("source"), F.lit(group_blocks)).cast("int")
        block = F.pmod(F.xxhash64("term", F.lit(1)), F.lit(term_blocks)).cast("int")
        shares = self.shares.select("lang", "source", "term", "p", side.alias("side"), block.alias("block"))
        sizes = self.terms.groupBy("lang", block.alias("block")).agg(F.count("*").alias("n_terms"))
        rest = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("n"), F.col("terms"))).otherwise(F.lit(0))
        heads = self.groups.join(self.langs, "lang").select("lang", "source", rest.alias("p"), side.alias("side"))
        heads = heads.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(term_blocks - 1))))
        heads = heads.join(sizes, ["lang", "block"], "left").na.fill(0, ["n_terms"])
        heads = heads.select("lang", "source", F.lit(None).cast("string").alias("term"), "p", "side", "block", "n_terms")
        slices = shares.withColumn("n_terms", F.lit(0).cast("long")).unionByName(heads)
        other = F.explode(F.sequence(F.lit(0), F.lit(group_blocks - 1)))
        copies = slices.withColumn("other", other).withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")})
        cells = copies.groupBy("lang", "i", "j", "block")
        partial = cells.applyInArrow(_cell_sums, "lang string, a string, b string, value long")
        total = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
        return total.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
            total.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
        )

    def overused(self) -> DataFrame:
        """(lang, source, item, value): terms a group has more often than its language."""
        more = self.shares.where("p > q")
        return more.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))


def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
    least_docs: int = LEAST_DOCS, top: int = TOP, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK,
) -> DataFrame:
    """How the sources of each language differ: (lang, source, part, item, value, rank).

    A language keeps the terms that ``least_docs`` of its documents have; shares
    are smoothed and whole (see :func:`_share`). Part ``pair`` sums the absolute
    differences of the shares of two sources over all kept terms, ranked by value;
    part ``term`` has the ``top`` terms of a source that it uses more than its
    language does. Ties go by item, as UTF-8.

    Null lang, source and text are empty strings; repeated rows count each. A
    source without kept terms still stands in pairs, a language without kept
    terms has the value 0 in all. A language with one source has no pairs. An
    empty table gives no row; other columns are not read.
    """
    found = Divergence(docs, lang, source, text, least_docs, group_block, term_block)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = found.pairs().withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    terms = found.overused().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
