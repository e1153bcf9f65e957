"""Passages that repeat across documents, by FM-indexes of bounded shards."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.fm_index import FmIndex
from playbill.llm.groups import freed, stored
from playbill.llm.tasks import map_text

WINDOW = 50
# A window is known by its least run of GRAM words; equal windows have equal ones.
GRAM = 20
# Windows of one passage at most; a longer run of windows is cut, not dropped.
PASSAGE = 64
# Words of a shard on average, and passages that one gram may bring into it.
SHARD_WORDS, GRAM_PASSAGES = 300_000, 1_000
_MEMORY, _SEEN, _BATCH_WORDS = 500_000, 200_000, 200_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class _Powers:
    """Powers of a factor modulo 2**64 and those of its inverse, as many as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 18)
            self.up, self.down = (np.full(size + 1, x, np.uint64) for x in (int(_STEP), pow(int(_STEP), -1, 1 << 64)))
            self.up[0] = self.down[0] = 1
            self.up, self.down = self.up.cumprod(), self.down.cumprod()
        return self.up[:n], self.down[:n]


def _grams(hashes: np.ndarray, powers: _Powers) -> np.ndarray:
    """A hash of each ``GRAM`` words in a row."""
    up, down = powers.upto(len(hashes) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1])))
    x = (total[GRAM:] - total[:-GRAM]) * down[: len(total) - GRAM]
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _least_grams(grams: np.ndarray, window: int) -> np.ndarray:
    """The least gram of each window, the first of equal ones, compared by their upper halves."""
    span = window - GRAM + 1
    low = np.uint64(32)
    keys = (grams >> low << low) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while size * 2 <= span:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    keys = np.minimum(keys[: len(grams) - span + 1], keys[span - size :][: len(grams) - span + 1])
    return grams[(keys & np.uint64(0xFFFFFFFF)).astype(np.int64)]


def passages(sizes: np.ndarray, hashes: np.ndarray, window: int, powers: _Powers) -> tuple[np.ndarray, ...]:
    """Runs of windows with one least gram: text number, first window, windows, gram.

    ``sizes`` are the words of each text, ``hashes`` those of all in a row.
    """
    if len(hashes) < window:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    least = _least_grams(_grams(hashes, powers), window)
    counts = np.maximum(sizes - window + 1, 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    first = np.cumsum(sizes) - sizes
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    own = least[first[text] + at]
    new = np.ones(len(own), bool)
    new[1:] = (text[1:] != text[:-1]) | (own[1:] != own[:-1])
    begins = np.flatnonzero(new)
    inside = np.arange(len(own)) - begins[np.cumsum(new) - 1]
    begins = np.flatnonzero(inside % PASSAGE == 0)
    return text[begins], at[begins], np.diff(np.append(begins, len(own))), own[begins]


def _word_batches(batch: pa.RecordBatch, column: int):
    """Slices (first, stop) of a batch with the words of their texts, of bounded size together."""
    held, first, size = [], 0, 0
    for i, t in enumerate(batch.column(column)):
        own = t.as_buffer().to_pybytes().split() if t.is_valid else []
        if size and size + len(own) > _BATCH_WORDS:
            yield first, i, held
            held, first, size = [], i, 0
        held.append(own)
        size += len(own)
    if held:
        yield first, batch.num_rows, held


def _runs(texts: DataFrame, window: int) -> DataFrame:
    """(id, mark, start, n, gram) of every run of windows."""

    def rows(batches):
        memory, powers = _Hashes(), _Powers()
        for batch in batches:
            for first, stop, words in _word_batches(batch, 2):
                if len(memory) > _MEMORY:
                    memory.clear()
                sizes = np.array([len(w) for w in words], np.int64)
                hashes = np.fromiter((memory[x] for w in words for x in w), np.uint64, int(sizes.sum()))
                text, start, n, gram = passages(sizes, hashes, window, powers)
                at = pa.array(text + first)
                arrays = [batch.column(0).take(at), batch.column(1).take(at), pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(gram.view(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "mark", "start", "n", "gram"])

    return map_text(texts.select("id", "mark", "text"), rows, "id long, mark long, start int, n int, gram long")


def _cut(near: DataFrame, window: int) -> DataFrame:
    """(id, mark, start, gram, passage, words) of the runs of each text; words only once in a task, if it remembers."""

    def rows(batches):
        seen: set[bytes] = set()
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column(2)[i].as_buffer().to_pybytes().split()
                runs = batch.column(3)[i].as_py()
                marks, texts = [], []
                for r in runs:
                    words = b" ".join(own[r["start"] : r["start"] + r["n"] + window - 1])
                    marks.append(hashlib.md5(words, usedforsecurity=False).digest())
                    texts.append(None if marks[-1] in seen else words)
                    seen.add(marks[-1])
                if len(seen) > _SEEN:
                    seen.clear()
                k = len(runs)
                keys = [pa.array([batch.column(c)[i].as_py()] * k, pa.int64()) for c in (0, 1)]
                arrays = [*keys, pa.array([r["start"] for r in runs], pa.int32()), pa.array([r["gram"] for r in runs], pa.int64())]
                arrays += [pa.array(marks, pa.binary()), pa.array(texts, pa.binary()).view(pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "mark", "start", "gram", "passage", "words"])

    return map_text(near, rows, "id long, mark long, start int, gram long, passage binary, words string")


def _search(window: int):
    """Index the passages of a shard, stream them, report the runs of windows of one first owner."""

    def shard(table: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        texts = [[known.setdefault(w, len(known) + 1) for w in t.as_buffer().to_pybytes().split(b" ")] for t in table.column("words")]
        texts = [np.array(t, np.int64) for t in texts]
        index = FmIndex(texts, np.array(table.column("owner").to_pylist(), np.int64), window)
        _, first = index.matching_statistics(texts)
        ends = np.cumsum([len(t) for t in texts])
        places, passage, at, n, owner = 0, [], [], [], []
        for k, stop in enumerate(ends):
            own = first[places : stop - window + 1]
            begins = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            passage += [k] * len(begins)
            at += begins.tolist()
            n += np.diff(np.append(begins, len(own))).tolist()
            owner += own[begins].tolist()
            places = stop
        keys = table.column("passage").combine_chunks().take(pa.array(passage, pa.int64()))
        return pa.Table.from_arrays([keys, pa.array(at, pa.int32()), pa.array(n, pa.int32()), pa.array(owner, pa.int64())], ["passage", "at", "n", "owner"])

    return shard


def _first_owners(pieces: DataFrame, window: int) -> DataFrame:
    """(passage, at, n, owner): the smallest document that holds each window of each passage.

    Passages of one gram meet in one shard, as equal windows must. A gram with very
    many different passages is dealt out finer, by whole windows, so that a shard
    stays small; windows that recur are first made one.
    """
    classes = pieces.groupBy("gram", "passage").agg(F.min("id").alias("owner"), F.max("words").alias("words"))
    classes = stored(classes, "passages")
    hot = classes.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > GRAM_PASSAGES).select("gram")
    hot = stored(hot, "grams")
    many = hot.limit(1).count() > 0
    calm = classes.join(hot, "gram", "left_anti") if many else classes
    entries = calm.select(F.xxhash64("gram").alias("deal"), "passage", "owner", "words")
    if many:
        w = F.split("words", " ")
        each = F.transform(F.sequence(F.lit(1), F.size(w) - window + 1), lambda i: F.array_join(F.slice(w, i, window), " "))
        single = classes.join(hot, "gram", "left_semi").select(F.col("passage").alias("whole"), "owner", F.posexplode(each).alias("at", "words"))
        single = stored(single.withColumn("passage", F.unhex(F.md5("words"))), "windows")
        once = single.groupBy("passage", "words").agg(F.min("owner").alias("owner"))
        entries = entries.union(once.select(F.xxhash64("passage"), "passage", "owner", "words"))
        entries = stored(entries, "entries")
    total = entries.agg(F.sum(F.size(F.split("words", " ")))).first()[0] or 0
    shards = -(-total // SHARD_WORDS) or 1
    dealt = entries.withColumn("shard", F.pmod("deal", F.lit(shards))).select("shard", "passage", "owner", "words")
    found = dealt.groupBy("shard").applyInArrow(_search(window), "passage binary, at int, n int, owner long")
    if not many:
        return stored(found, "found")
    found = stored(found, "found")
    parts = single.select("whole", "passage", F.col("at").alias("from")).join(found.select("passage", "owner"), "passage")
    parts = parts.select(F.col("whole").alias("passage"), F.col("from").alias("at"), F.lit(1).alias("n"), "owner")
    return found.join(single.select("passage").distinct(), "passage", "left_anti").union(parts)


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, mark, spans): words [start, stop) of windows that a document with a smaller key has too.

    ``mark`` tells texts of one key apart (the 64-bit hash of the text).
    """
    if window < 2 * GRAM or window > 63:
        raise ValueError(f"windows have {2 * GRAM} to 63 words")
    texts = docs.select(docs[key].cast("long").alias("id"), F.xxhash64(docs[text]).alias("mark"), docs[text].alias("text"))
    texts = texts.where("id is not null and text is not null")
    runs = stored(_runs(texts, window), "runs")
    shared = runs.groupBy("gram").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("gram")
    near = runs.join(shared.hint("merge"), "gram", "left_semi").groupBy("id", "mark")
    near = stored(near.agg(F.collect_set(F.struct("start", "n", "gram")).alias("runs")), "near")
    # Both sides grow with the input, so texts are shuffled to their runs at every size.
    own = texts.join(near.hint("merge"), ["id", "mark"])
    pieces = stored(_cut(own.select("id", "mark", "text", "runs"), window), "pieces")
    owners = _first_owners(pieces, window)
    found = pieces.select("id", "mark", "start", "passage").join(owners, "passage").where("owner < id")
    begin = F.col("start") + F.col("at")
    spans = found.select("id", "mark", F.struct(begin.alias("start"), (begin + F.col("n") + window - 1).alias("stop")).alias("span"))
    return spans.groupBy("id", "mark").agg(F.sort_array(F.collect_set("span")).alias("spans"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Take out each word in a window of ``window`` words that starts in a document with a smaller key too.

    Words are runs of anything but ASCII white space, unchanged. Returns key,
    n_words, n_removed, text (the words left, one space between them) and
    removed (spans of word numbers, ascending, apart). Windows are judged on the
    texts as given. Equal windows share the least of their ``GRAM``-word hashes;
    passages around hashes that two documents share meet in shards of bounded
    size, each an FM-index that all passages of the shard are streamed through.

    Null text has no words and an empty result; a row without key is left whole
    and counts for no other; rows of one key are one document and don't repeat
    each other. Keys are integers. An empty table gives no row; other columns
    are not read.
    """
    with freed(docs.sparkSession):
        spans = stored(repeated_spans(docs, key, text, window), "spans", keep=True)
    spans = spans.toDF("__id", "__mark", "spans")
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    match = (F.col("key").cast("long") == F.col("__id")) & (F.xxhash64("text") == F.col("__mark"))
    own = source.join(spans.hint("merge"), match, "left").select("key", "text", "spans")

    def rows(batches):
        for batch in batches:
            sizes, gone, left, removed = [], [], [], []
            for t, spans in zip(batch.column(1), batch.column(2).to_pylist()):
                words = t.as_buffer().to_pybytes().split() if t.is_valid else []
                merged: list[dict] = []
                for s in spans or ():
                    if merged and s["start"] <= merged[-1]["stop"]:
                        merged[-1]["stop"] = max(merged[-1]["stop"], s["stop"])
                    else:
                        merged.append(dict(s))
                sizes.append(len(words))
                gone.append(sum(s["stop"] - s["start"] for s in merged))
                removed.append(merged)
                for s in reversed(merged):
                    del words[s["start"] : s["stop"]]
                left.append(b" ".join(words))
            span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(left, pa.binary()).view(pa.string()), pa.array(removed, span)]
            yield pa.RecordBatch.from_arrays(arrays, [key, "n_words", "n_removed", "text", "removed"])

    return map_text(own, rows, f"`{key}` {kind}, n_words long, n_removed long, text string, removed array<struct<start int, stop int>>")
