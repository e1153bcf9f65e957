"""License scan by a positional index of the rarest license words."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.tasks import map_text, text_batches

# Phrases that label a document by themselves.
PHRASES = {
    "all rights reserved": "reserved",
    "cc by": "cc-by",
    "general public license": "gpl",
}


class Template(NamedTuple):
    label: str
    text: str
    phrases: tuple[str, ...]


# License notices, and the phrases each must have.
TEMPLATES = (
    Template("agpl-3.0", "licensed under the GNU Affero General Public License, version 3", ("affero general public license",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "version 2 0")),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution", "4 0")),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    Template("lgpl", "licensed under the GNU Lesser General Public License", ("lesser general public license",)),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        ("permission is hereby granted free of charge",),
    ),
    Template(
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license",),
    ),
)

# ASCII letters to lower case, other ASCII signs but digits to a space.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_RARE = 6
_SLACK = 3


def words_of(text: str) -> list[bytes]:
    """Words as UTF-8: ASCII letters in lower case, digits, and all beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def template_words(templates: tuple[Template, ...] = TEMPLATES) -> list[str]:
    return sorted({w.decode() for t in templates for w in words_of(t.text)})


def word_frequencies(docs: DataFrame, vocabulary: list[str], text: str = "text") -> DataFrame:
    """(word, n_docs) over all documents, for the words of the vocabulary only."""
    known = {w.encode() for w in vocabulary}

    def rows(batches):
        total: Counter[bytes] = Counter()
        for _, texts in text_batches(batches, "text"):
            for t in texts:
                total.update(known.intersection(words_of(t)))
        if total:
            words, counts = zip(*sorted(total.items()))
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in words]), pa.array(counts, pa.int64())], ["word", "n_docs"])

    partial = map_text(docs.select(docs[text].alias("text")), rows, "word string, n_docs long")
    return partial.groupBy("word").agg(F.sum("n_docs").alias("n_docs"))


class RareIndex:
    """For each template its rarest words with their places; postings by word."""

    def __init__(self, templates: tuple[Template, ...], frequencies: dict[str, int], n_docs: int, rare: int = _RARE):
        self.templates = templates
        self.words = [words_of(t.text) for t in templates]
        self.phrases = [[b" " + b" ".join(words_of(p)) + b" " for p in t.phrases] for t in templates]
        self.idf = {
            w: math.log((1 + n_docs) / (1 + frequencies.get(w.decode(), 0))) + 1 for own in self.words for w in own
        }
        self.postings: defaultdict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.weight = []
        for number, own in enumerate(self.words):
            top = sorted(set(own), key=lambda w: (-self.idf[w], w))[:rare]
            places = [(w, i) for i, w in enumerate(own) if w in top]
            for w, i in places:
                self.postings[w].append((number, i))
            self.weight.append(sum(self.idf[w] for w, _ in places))

    def matches(self, words: list[bytes], least: float) -> list[tuple[str, int, float]]:
        """(label, first word, share of template words in place), one per template and place.

        Template places are subtracted from the file's; words that agree on the
        difference vote for it with their weight. A difference with at least
        ``least`` of the template's weight, slips of ``_SLACK`` words included, is
        kept if all key phrases stand there.
        """
        votes: defaultdict[tuple[int, int], float] = defaultdict(float)
        for at in (i for i, w in enumerate(words) if w in self.postings):
            for number, place in self.postings[words[at]]:
                votes[number, at - place] += self.idf[words[at]]
        found = []
        for (number, start), own in sorted(votes.items()):
            near = [votes.get((number, start + d), 0.0) for d in range(-_SLACK, _SLACK + 1)]
            if own < max(near) or own == max(near) and max(near[:_SLACK], default=0) == own:
                continue
            if sum(near) < least * self.weight[number]:
                continue
            size = len(self.words[number])
            around = b" " + b" ".join(words[max(0, start - _SLACK) : max(0, start + size + _SLACK)]) + b" "
            if all(p in around for p in self.phrases[number]):
                hits = sum(0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(self.words[number]))
                found.append((self.templates[number].label, max(0, start), hits / size))
        return found


def scan_licenses(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: tuple[Template, ...] = TEMPLATES,
    least: float = 0.8,
) -> DataFrame:
    """License labels of each whole text.

    Two passes: how many documents hold each template word (its weight), then the
    scan. What comes to the driver is one number per template word. Result
    per input row: key, n_words, n_base, first_word, last_word, base_labels,
    labels, matches (label, first word, score), score (the largest share of a
    template in place; 1 for a phrase of ``PHRASES``; else 0). Null and empty
    texts have no words and no label; an empty table gives no row.
    """
    n_docs = docs.count()
    frequencies = {r["word"]: r["n_docs"] for r in word_frequencies(docs, template_words(templates), text).collect()}
    index = RareIndex(templates, frequencies, n_docs)
    base = [(b" " + b" ".join(words_of(p)) + b" ", label) for p, label in PHRASES.items()]

    def rows(batches):
        for batch, texts in text_batches(batches, "text"):
            out: list[list] = [[] for _ in range(8)]
            for t in texts:
                words = words_of(t)
                line = b" " + b" ".join(words) + b" "
                starts, labels = [], set()
                for phrase, label in base:
                    at = line.find(phrase)
                    while at >= 0:
                        starts.append(line.count(b" ", 0, at))
                        labels.add(label)
                        at = line.find(phrase, at + 1)
                found = index.matches(words, least)
                score = max([0.0, *(m[2] for m in found), *([1.0] if labels else [])])
                row = (
                    len(words), len(starts), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted(labels)), ",".join(sorted(labels | {m[0] for m in found})),
                    [{"label": m[0], "first_word": m[1], "score": m[2]} for m in found], score,
                )
                for column, v in zip(out, row):
                    column.append(v)
            match = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("score", pa.float64())]))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [match, pa.float64()]
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "matches", "score"]
            arrays = [pa.array(v, k) for v, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [key, *names])

    kind = docs.schema[key].dataType.simpleString()
    return map_text(
        docs.select(docs[key], docs[text].alias("text")),
        rows,
        f"`{key}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
        " matches array<struct<label:string,first_word:long,score:double>>, score double",
    )
