"""The divergence cube against a plain version over dictionaries."""

import re
from collections import Counter

import pytest

from playbill.llm import divergence, queries


def plain(rows, least=30, top=50):
    groups, found = {}, {}
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low))
        groups.setdefault(lang, {}).setdefault(source, Counter()).update(words)
        found.setdefault(lang, Counter()).update(words.keys())
    out = []
    for lang, own in groups.items():
        kept = [t for t, n in found[lang].items() if n >= least]
        def share(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}
        shares = {s: share(c) for s, c in own.items()}
        whole = share(sum(own.values(), Counter()))
        for s in own:
            pairs = [(-sum(abs(shares[s][t] - shares[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(whole[t] - shares[s][t], t) for t in kept if own[s][t] and shares[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -v, k + 1) for k, (v, item) in enumerate(items[:most])]
    return sorted(out)


WORDS = ["alpha", "Beta", "γάμμα", "éa", "don't", "x1y", "中文", "\U0001f600", "-", "zz"]


@pytest.mark.parametrize("group_block, term_block", [(64, 8000), (2, 3)])
def test_odd_rows_in_one_and_many_cells(spark, group_block, term_block):
    rows = [(("en", "de", "", None)[i % 4], f"s{i % 7}" if i % 11 else None, " ".join(WORDS[(i * k + k) % 10] * (1 + k % 2) for k in range(i % 13))) for i in range(300)]
    rows += [("en", "s1", "alpha " * 5000), ("en", "no words", "123"), ("fr", "a", "x"), ("fr", "b", None), ("fr", "c", ""), ("it", "only", "y y")]
    rows += [rows[8]] * 20 + [("en", "big", f"word{i} alpha") for i in range(200)]
    df = spark.createDataFrame([(*r, r[0], 1, 2) for r in rows], "lang string, source string, text string, term string, side int, n long")
    got = divergence.audit(df.repartition(5), least_docs=10, top=3, group_block=group_block, term_block=term_block)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 10, 3)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted = plain([(r["lang"], r["source"], r["text"]) for r in docs.collect()])
    got = queries.op12_divergence_cube(spark, "/root/testdata/sf0.001")
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == wanted


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_share_is_exact_for_large_counts(spark):
    cases = [(10**12 + 7, 3 * 10**12 + 1, 999_983), (0, 0, 7), (5, 5, 1), (2**61, 2**62, 10**6)]
    df = spark.createDataFrame(cases, "n long, total long, terms long")
    got = [r[0] for r in df.select(divergence._share(df["n"], df["total"], df["terms"])).collect()]
    assert got == [1 + 10**9 * (n + 5) // (t + 5 * v) for n, t, v in cases]
