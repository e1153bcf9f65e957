"""Quality rules by a suffix array: repeated passages inside one document."""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from playbill.llm.tasks import map_text, text_batches

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def _suffix_repeats(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each word position, the longest passage from there that its document has twice.

    One suffix array over all documents of the batch: ranks of passages of 1, 2,
    4, ... words, each round sorting only suffixes that still tie, until none
    does. The document is part of the first rank, so no passage spans two. The
    longest common prefix of neighbours in suffix order follows from the kept
    ranks, largest power first. The deepest interval that holds a suffix has the
    larger of its two neighbour values.
    """
    n = len(words)
    ends = np.repeat(np.cumsum(sizes), sizes)
    docs = np.repeat(np.arange(len(sizes)), sizes)
    key = docs * (int(words.max(initial=0)) + 1) + words
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels, step = [rank], 1
    while True:
        tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        if not len(tied):
            break
        after = tied + step
        second = np.where(after < ends[tied], rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[tied] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        tied, key = tied[order], key[order]
        own = rank[tied]
        at = np.arange(len(tied))
        group = np.maximum.accumulate(np.where(np.concatenate(([True], own[1:] != own[:-1])), at, 0))
        part = np.maximum.accumulate(np.where(np.concatenate(([True], key[1:] != key[:-1])), at, 0))
        rank = rank.copy()
        rank[tied] = own + part - group
        levels.append(rank)
        step *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    left, right = suffixes[:-1], suffixes[1:]
    pairs = np.flatnonzero(levels[0][left] == levels[0][right])
    left, right = left[pairs], right[pairs]
    common = np.zeros(len(pairs), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        a, b = left + common, right + common
        inside = (a < ends[left]) & (b < ends[right])
        same = inside & (levels[level][np.minimum(a, n - 1)] == levels[level][np.minimum(b, n - 1)])
        common[same] += 1 << level
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, left, common)
    np.maximum.at(longest, right, common)
    return longest


def _covered(longest: np.ndarray, least: int, length: np.ndarray | int, docs: np.ndarray, n_docs: int) -> np.ndarray:
    """Words of each document in the union of the repeated spans of ``least`` words or more."""
    n = len(longest)
    starts = np.flatnonzero(longest >= least)
    stops = starts + (length[starts] if isinstance(length, np.ndarray) else length)
    edges = np.bincount(starts, minlength=n + 1) - np.bincount(stops, minlength=n + 1)
    return np.bincount(docs, weights=np.cumsum(edges[:n]) > 0, minlength=n_docs).astype(np.int64)


def _measures(texts: list[str], min_words: int) -> dict[str, np.ndarray]:
    index: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids, sizes, chars, symbols, repeats = [], [], [], [], []
    for t in texts:
        words = t.encode("utf-8", "surrogatepass").split()
        ids.extend(map(index.__getitem__, words))
        sizes.append(len(words))
        chars.append(len(t) - sum(map(t.count, _SPACES)))
        symbols.append(sum(map(t.count, _SYMBOLS)))
        lines = [x for x in t.split("\n") if x.strip(_SPACES)]
        repeats.append(len(lines) - len(set(lines)))
    sizes = np.array(sizes, np.int64)
    if ids:
        docs = np.repeat(np.arange(len(sizes)), sizes)
        longest = _suffix_repeats(np.array(ids, np.int64), sizes)
        per_doc = np.zeros(len(sizes), np.int64)
        np.maximum.at(per_doc, docs, longest)
        windows = _covered(longest, 3, 3, docs, len(sizes))
        covered = _covered(longest, min_words, longest, docs, len(sizes))
    else:
        per_doc = windows = covered = np.zeros(len(sizes), np.int64)
    return {
        "n_words": sizes,
        "word_chars": np.array(chars, np.int64),
        "n_symbols": np.array(symbols, np.int64),
        "n_dup_lines": np.array(repeats, np.int64),
        "n_repeat_words": windows,
        "n_covered_words": covered,
        "longest_repeat": per_doc,
    }


def quality_rules(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_words: int = 10,
    max_covered: float = 0.4,
    max_longest: float = 0.25,
    least_longest: int = 50,
    keep: list[str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """Measures and verdict of each document, by repeated passages of whole words.

    A suffix array over the words of a document gives its maximal repeated
    passages. A document goes if passages of ``min_words`` words or more cover
    over ``max_covered`` of its words, or if one passage of over
    ``least_longest`` words has more than ``max_longest`` of them; also if it has
    under 50 words, or over half of its words lie in three-word windows found
    twice.

    One output row per input row with key, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_covered_words, longest_repeat, base_failed and
    kept. ``keep`` names input columns to carry along instead of the key alone;
    ``prefix`` goes before the new names, where the input has them too. Null and
    empty texts have no words and fail. Repeated rows are judged one by one. An
    empty table gives none.
    """
    keep = keep or [key]

    def rows(batches):
        for batch, texts in text_batches(batches, "__text"):
            m = _measures(texts, min_words)
            n, rep = m["n_words"], m["n_repeat_words"]
            failed = (n < 50) | (100 * rep > 50 * n)
            good = (m["n_covered_words"] <= max_covered * n) & (
                (m["longest_repeat"] <= least_longest) | (m["longest_repeat"] <= max_longest * n)
            )
            arrays = [pa.array(v, pa.int64()) for v in m.values()]
            arrays += [pa.array(failed), pa.array(~failed & good)]
            names = [prefix + c for c in (*m, "base_failed", "kept")]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *arrays], [*keep, *names])

    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat")
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    fields += [f"`{prefix}{c}` long" for c in measures] + [f"`{prefix}{c}` boolean" for c in ("base_failed", "kept")]
    source = docs.select(*(docs[c] for c in keep), docs[text].alias("__text"))
    return map_text(source, rows, ", ".join(fields))
