"""Free-style text operators against brute force on small tables."""

import functools
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from playbill.llm import language, licenses, packing, queries, repetition, token_files
from playbill.llm.encode import Encoder, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n\n", "a", "a b  c\n d\t\te  f", "x" * 5000, "wort " * 700, "wort\n" * 80, "́a İIΣ Σ",
    "a\x00b c \x00 d", "tail  ", " \n lead", "<|endoftext|> 's 'll don't", "\x1c \x85 y", "All rights reserved. CC BY general public license",
    "hello <|endoftext|> world  <|startoftext|>", "<|endoftext|>", "a<|endoftext|>b <|ENDOFTEXT|>\n<|endoftext|> <|endoftext|>c", "cc by cc by cc by", "\U0001f600 中文 naïve #*$%&|<>", "one two three four five six " * 60,
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(ODD)] + [(3, "a b", "y", 1), (3, "a b", "y", 1), (None, "null key", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words long").repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def words_in(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rules_by_hand(text, min_words=10):
    w = words_in(text)
    n = len(w)
    lines = [x for x in (text or "").split("\n") if words_in(x)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    again = {j for i in range(n - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again))


def repeats_by_hand(w, least):
    longest, covered = 0, set()
    for i in range(len(w)):
        best = 0
        for j in range(len(w)):
            k = 0
            while i != j and max(i, j) + k < len(w) and w[i + k] == w[j + k]:
                k += 1
            best = max(best, k)
        longest = max(longest, best)
        if best >= least:
            covered |= set(range(i, i + best))
    return len(covered), longest


def test_quality_rules(odd, docs):
    for df in (odd, docs):
        texts = sorted((str(r["doc_id"]), r["text"] or "") for r in df.collect())
        got = repetition.quality_rules(df).collect()
        assert len(got) == len(texts)
        wanted = Counter((k, *rules_by_hand(t)) for k, t in texts)
        assert wanted == Counter(
            (str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got
        )
        for r in got:
            failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
            assert r.base_failed == failed and not (failed and r.kept)


def test_repeats_are_maximal(spark):
    a = "the cat sat on the mat and the cat sat on the rug and the cat ran " * 2
    b = " ".join(f"w{i % 37}" for i in range(120))
    texts = [a, b, a + b, "q " * 30, "x y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_covered_words, r.longest_repeat) for r in repetition.quality_rules(df, min_words=4).collect()}
    assert got == {i: repeats_by_hand(t.split(), 4) for i, t in enumerate(texts)}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_gives_the_librarys_ids(docs, name):
    plain = plain_tokenizer(name)
    texts = [t or "" for t in ODD] + [r["text"] or "" for r in docs.collect()]
    for memory in (10, 1_000_000):
        own, at = Encoder(name, memory), 0
        for few in (texts[:7], texts[7:60], texts[60:], texts):
            flat, sizes = own.encode(few)
            at = 0
            for t, n in zip(few, sizes):
                assert flat[at : at + n].tolist() == plain.encode(t, add_special_tokens=False).ids
                at += n


@functools.cache
def plain_tokenizer(name):
    return Tokenizer.from_file(tokenizer_path(name))


def ids_by_hand(text, name, end):
    return plain_tokenizer(name).encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


@pytest.mark.parametrize("packers", [8, 100_000])
def test_packing_holds_every_id_once(odd, docs, packers):
    for df in (odd, docs):
        got = packing.pack_documents(df, pieces_per_packer=packers, with_ids=True).collect()
        by_doc = {}
        for r in got:
            assert r["ids_crc32"] == crc(r["ids"]) and r["length"] == len(r["ids"]) > 0
            by_doc.setdefault(r["doc_id"], []).append((r["start"], r["ids"], r["doc_tokens"]))
        for row in df.dropDuplicates(["doc_id"]).where("doc_id is not null and doc_id <> 3").collect():
            parts = sorted(by_doc[row["doc_id"]])
            ids = [i for p in parts for i in p[1]]
            assert ids == ids_by_hand(row["text"], "byte_bpe_50k.json", 0) and {p[2] for p in parts} == {len(ids)}
        rows = {}
        for r in got:
            rows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for parts in rows.values():
            end = 0
            for offset, size in sorted(parts):
                assert offset == end
                end += size
            assert end <= packing.WINDOW


def test_packing_wastes_little(spark):
    pieces = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(0).alias("start"), (F.pmod(F.xxhash64("id"), F.lit(1024)) + 1).alias("length"))
    got = packing.pack_pieces(pieces, 1)
    full = got.agg(F.sum("length").alias("n"), F.countDistinct("sequence_id").alias("s")).first()
    assert full["n"] / (full["s"] * 1024) > 0.95


def test_token_files(spark, odd, docs, tmp_path):
    for i, df in enumerate((odd, docs)):
        got = token_files.token_files(df, str(tmp_path / str(i))).collect()
        rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in df.collect()))
        start, wanted = 0, []
        for known, key, text in rows:
            ids = ids_by_hand(text, "word_bpe_49k.json", 2)
            wanted.append((key if known else None, start, len(ids), crc(ids)))
            start += len(ids)
        assert sorted(map(tuple, got), key=lambda r: r[1]) == wanted


def test_token_file_rows(tmp_path):
    import numpy as np

    ids = np.arange(1, 2501, dtype=np.uint32)
    token_files.write_file(str(tmp_path), "a.arrow", ids, np.array([9, 2499]), [5, None], 16)
    file = token_files.TokenFile(str(tmp_path), "a.arrow")
    assert file.doc_ids == [5, None]
    row, mask = file.sequence(100)
    assert row.tolist() == list(range(1601, 1617)) and mask.tolist() == [1] * 16
    row, mask = file.sequence(156)
    assert row.tolist() == [2497, 2498, 2499, 2500] + [0] * 12 and mask.tolist() == [1, 1, 1, 2] + [0] * 12


def test_document_over_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "_FILE_ROWS", 2)
    df = spark.createDataFrame([(1, "a b " * 30), (2, "c"), (3, "d e f " * 50)], "doc_id long, text string")
    got = token_files.token_files(df, str(tmp_path), length=8).collect()
    wanted = [(k, len(ids_by_hand(t, "word_bpe_49k.json", 2)), crc(ids_by_hand(t, "word_bpe_49k.json", 2))) for k, t in df.collect()]
    assert sorted((r[0], r[2], r[3]) for r in got) == wanted


def license_words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def test_license_base(odd, docs):
    for df in (odd, docs):
        wanted = Counter()
        for r in df.collect():
            w, starts, labels = license_words(r["text"]), [], set()
            for phrase, label in licenses.PHRASES.items():
                p = phrase.split()
                own = [i for i in range(len(w)) if w[i : i + len(p)] == p]
                starts += own
                labels |= {label} if own else set()
            wanted[r["doc_id"], len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))] += 1
        got = licenses.scan_licenses(df).collect()
        assert Counter(tuple(r)[:6] for r in got) == wanted
        assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got)


def test_license_templates(spark):
    rows = [(i, f"some words first\n{t.text}. and more behind it") for i, t in enumerate(licenses.TEMPLATES)]
    rows += [(98, "version 3 of the public work is here under mit rule"), (99, "Licensed under the Apache Licence")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.scan_licenses(df).collect()}
    assert all(t.label in got[i] for i, t in enumerate(licenses.TEMPLATES)) and got[98] == got[99] == [""]


def test_language_held_out(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op9_language_ppm(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
    held = got.where("held_out")
    assert held.where("lang_pred = lang").count() >= 0.98 * held.count() > 0


def test_language_odd_rows(spark, odd):
    trees = language.fit_trees(odd.withColumn("lang", F.coalesce("lang", F.lit("z"))))
    got = language.predict_language(odd, trees, keep=("doc_id", "text")).collect()
    assert len(got) == odd.count()
    for r in got:
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, r["text"] or "")))
        assert 0 <= r["score"] <= 1
    assert language.fit_trees(odd.limit(0)) is None
    assert {r["lang_pred"] for r in language.predict_language(odd, None).collect()} == {"und"}


def test_code_length_by_hand(spark):
    trees = language.ByteTrees([("a", (2 + 97, 2 + 98, 2 + 97), 2 + 98, 3), ("a", (2 + 97, 2 + 98, 2 + 97), 2 + 99, 1)])
    import numpy as np

    got = trees.code_lengths([b"abab"])[0, 0]
    # Seen after "aba": b 3 and c 1, so b costs ln 2 and the escape ln 3 at every depth.
    unseen = np.log(3) + np.log(256.0)
    # No context of the first or third letter holds it: "" knows b and c only.
    assert got == pytest.approx(unseen + np.log(2) + unseen + np.log(2), rel=1e-6)


def test_empty_tables(spark, odd, tmp_path):
    none = odd.limit(0)
    assert repetition.quality_rules(none).count() == 0
    assert packing.pack_documents(none).count() == 0
    assert token_files.token_files(none, str(tmp_path)).count() == 0
    assert licenses.scan_licenses(none).count() == 0

