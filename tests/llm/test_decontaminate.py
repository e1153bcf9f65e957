"""Contamination against DuckDB and against a plain search."""

import re

import oracle
import pytest

from playbill.llm import decontaminate, queries


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def by_hand(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        own = words(t)
        n = min(13, len(own))
        for s in range(len(own) - n + 1 if n else 0):
            for i in range(len(w) - n + 1):
                if w[i : i + n] == own[s : s + n]:
                    hit |= set(range(i, i + n))
                    if item is not None:
                        found.add(str(item))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def check(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string, row string, items long").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.contamination(d.drop("items"), b)
    got = [(r["doc_id"], r["text"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in out.collect()]
    wanted = [(i, t, *by_hand(t, items)) for i, t, *_ in docs]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_given_tables(spark, folder):
    df = queries.op8_positional_index(spark, folder)
    assert oracle.differences(df, oracle.connect(folder), queries.OP8_SQL) is None


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(40))
    items = [(1, long), (2, "Short item"), (3, None), (4, ""), (5, "the " * 20), (6, long.upper()), (None, "no id here at all"), (2, "another short"), (7, "É é, naïve"), (8, "unseen words only")]
    docs = [
        (1, long), (2, f"before {long} after"), (3, " ".join(long.split()[5:30]) + "!"), (4, long.replace("w20", "x")), (5, None), (6, ""), (7, "short, ITEM short item"),
        (8, "the " * 100), (9, "no id here at all " + "pad " * 200), (10, "é É NAÏVE É é naïve"), (1, long), (1, "other text of one key"), (None, long), (11, " ".join(long.split()[-12:])),
        (12, " ".join(long.split()[:13]) + " and " + " ".join(long.split()[1:14])), (13, "-" * 1000), (14, "another short another short item"),
    ]
    check(spark, [(*d, "x", 1) for d in docs], items)
    check(spark, [(*d, "x", 1) for d in docs], [])
    check(spark, [], items)


def test_proximity(spark):
    item = " ".join(f"w{i}" for i in range(20))
    near = item.replace("w10", "w10 extra")
    df = spark.createDataFrame([(1, near), (2, item), (3, "w1 w2 " + "x " * 50 + "w18 w19")], "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    index = decontaminate.PositionalIndex(df, b, "doc_id", "text", "item_id", "text", 13)
    got = index.proximity(slop=2).join(index.tokens, "row")
    assert sorted(r["n_words"] for r in got.collect()) == [20, 21]


def test_no_python_on_executors(spark):
    df = queries.op8_positional_index(spark, "/root/testdata/sf0.001")
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
