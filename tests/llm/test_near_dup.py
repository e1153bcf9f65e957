"""Near duplicates against all pairs, on whole small tables."""

import re

from playbill.llm import near_dup
from playbill.llm.groups import connected


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


def groups_by_hand(docs):
    """doc -> (set size, smallest doc reached), by comparing all sets that share a shingle."""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for d in sorted(sets):
        shared = {}
        for s in sets[d]:
            for other in holders.setdefault(s, []):
                shared[other] = shared.get(other, 0) + 1
            holders[s].append(d)
        for other, n in shared.items():
            if 100 * n >= 75 * (len(sets[d]) + len(sets[other]) - n):
                a, b = find(d), find(other)
                root[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def check(df):
    wanted = groups_by_hand([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(df).collect()}
    assert got == wanted


def test_given_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_chains_and_odd_rows(spark):
    base = [f"w{i}" for i in range(150)]
    rows = [(100 + k, " ".join([f"x{k}.{i}" if i < 2 * k else w for i, w in enumerate(base)])) for k in range(40)]
    rows += [(300 + k, " ".join(w if i not in (k, 149 - k) else "new" for i, w in enumerate(base)).upper()) for k in range(30)]
    rows += [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "b a"), (7, "q " * 400), (8, "Q " * 9), (9, "a b c d e")]
    df = spark.createDataFrame([(i, t, i, t, None) for i, t in rows], "doc_id long, text string, id long, sketch string, a long")
    check(df.repartition(4))


def test_repeated_and_missing_keys(spark):
    rows = [(5, "a b c d e f"), (5, "g h i j k l"), (7, "g h i j k l"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f")]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, True), (3, 3, True), (3, 3, True), (5, 3, False), (5, 3, False), (7, 3, False),
    ]
    assert near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").limit(0)).count() == 0


def test_two_texts_of_one_key_and_near_copies_of_both(spark):
    first, second = [f"a{i}" for i in range(80)], [f"b{i}" for i in range(80)]
    near = [" ".join(x if i != 40 else "new" for i, x in enumerate(w)) for w in (first, second)]
    rows = [(-7, " ".join(first)), (-7, " ".join(second)), (3, near[0]), (4, near[1]), (5, "c " * 9)]
    for order in (rows, [rows[1], rows[0], *rows[2:]]):
        df = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(df).collect())
        assert got == [(-7, -7, True), (-7, -7, True), (3, -7, False), (4, -7, False), (5, 5, True)]


def test_connected(spark):
    chain = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(200, 230)] + [(900, 901), (901, 900)]
    got = {r["id"]: r["component"] for r in connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(101)} | {i: 200 for i in range(200, 230)} | {500: 200, 900: 900, 901: 900}


def test_bounds_fall_with_more_values():
    share = [near_dup.allowed_differences(n) / n for n in (64, 128, 256)]
    assert share == sorted(share, reverse=True) and 0.19 < share[-1] < 0.4
