"""FM-indexes and repeated passages against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest

from playbill.llm import fm_index, queries, repeats


def words_in(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(rows, window):
    low = {}
    for key, text in rows:
        w = words_in(text)
        for i in range(len(w) - window + 1):
            if key is not None:
                g = tuple(w[i : i + window])
                low[g] = min(low.get(g, key), key)
    out = []
    for key, text in rows:
        w = words_in(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if key is not None and low[tuple(w[i : i + window])] < key:
                gone |= set(range(i, i + window))
        out.append((-1 if key is None else key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_matching_statistics_of_any_patterns(seed):
    rng = random.Random(seed)
    base = [rng.randrange(1, 4 + seed * 40) for _ in range(400)]
    known = [np.array([*base[i : i + rng.randrange(1, 90)], *([1] * rng.randrange(3))]) for i in rng.sample(range(390), 25)]
    owners = np.array([rng.randrange(100) for _ in known])
    most = 50 if seed % 2 else 40
    index = fm_index.FmIndex(known, owners, most)
    asked = [*known[:5], *(np.array([*base[i : i + 60], rng.randrange(0, 5), *base[i + 7 : i + 40]]) for i in rng.sample(range(300), 10)), np.zeros(0, np.int64), np.array([0, 0, 1])]
    lengths, first = index.matching_statistics(asked)
    texts = [tuple(k) for k in known]
    at = 0
    for p in asked:
        for i in range(len(p)):
            own = tuple(p[i : i + most])
            best = max((k for k in range(len(own) + 1) if any(t[j : j + k] == own[:k] for t in texts for j in range(len(t) - k + 1)) and 0 not in own[:k]))
            assert lengths[at] == best
            wanted = min((o for t, o in zip(texts, owners) if any(t[j : j + most] == own for j in range(len(t)))), default=-1) if best == most else -1
            assert first[at] == wanted
            at += 1


def test_rank_counts_symbols():
    rng = np.random.default_rng(0)
    text = rng.integers(0, 37, 1000)
    tree = fm_index.WaveletMatrix(text, 37)
    symbol, at = rng.integers(0, 37, 300), rng.integers(0, 1001, 300)
    assert tree.rank(symbol, at).tolist() == [int((text[:a] == s).sum()) for s, a in zip(symbol, at)]


def table():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "中文", "W1", "\x00", "x\x1cy", "\xa0"]
    shared = [[rng.choice(vocabulary) for _ in range(n)] for n in (49, 50, 51, 70, 200)]
    rows = []
    for i in range(120):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 90))]
        for _ in range(rng.randrange(0, 3)):
            own += rng.choice(shared) + [rng.choice(vocabulary) for _ in range(rng.randrange(0, 30))]
        rows.append((rng.randrange(10**6), rng.choice([" ", "\n", " \t "]).join(own)))
    rows += [(7, "a " * 3000), (8, "a " * 49), (9, "a " * 50), (10, "b a " * 700), (3, "a b " * 60), (4, " a" * 77), (11, "p q r s t u v " * 90), (2, "q r s t u v p " * 30)]
    rows += [(None, rows[0][1]), (None, rows[0][1]), (12, None), (13, ""), (14, " \n"), rows[1], rows[1], (rows[1][0], rows[2][1])]
    return rows


@pytest.mark.parametrize("passages_of_a_gram", [1000, 2])
def test_odd_rows(spark, monkeypatch, passages_of_a_gram):
    monkeypatch.setattr(repeats, "GRAM_PASSAGES", passages_of_a_gram)
    monkeypatch.setattr(repeats, "SHARD_WORDS", 4_000)
    rows = table()
    df = spark.createDataFrame([(*r, r[0], "x", 1) for r in rows], "doc_id long, text string, id long, words string, n int")
    got = repeats.remove_repeats(df.repartition(5)).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got) == plain(rows, 50)
    for r in got:
        assert sum(s["stop"] - s["start"] for s in r["removed"]) == r["n_removed"]


def test_other_window(spark):
    rows = table()[40:]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = repeats.remove_repeats(df, window=41).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got) == plain(rows, 41)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted = [(k, n, g, hashlib.sha256(t.encode()).hexdigest()) for k, n, g, t in plain([(r["doc_id"], r["text"]) for r in docs.collect()], 50)]
    got = queries.op13_fm_index(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == wanted


def test_grams_follow_their_words_alone():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    words[3000:3100] = words[100:200]
    grams = repeats._grams(words, repeats._Powers())
    assert (grams[3000:3081] == grams[100:181]).all()
    assert len(np.unique(grams)) == len(grams) - 81


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
