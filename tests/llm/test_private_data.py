"""Base spans against the patterns of the contract; labelers and EM on small cases."""

import re

import pytest
from pyspark.sql import functions as F

from playbill.llm import private_data, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ODD = [
    None, "", "a@b.c_d@e.f x@y@z.com @a.b a@b a@b. a.b@c..d", "é a.b+c%d@host-1.example.com, 😀 q@w.er",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 999999999999999.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1111-1 4111111111111111 5 6 7",
    "12 34  4111111111111111", "0000000000000000 000000000000 00000000000000000000", "+1 (988) 555-2485 +1 2 +49 (0) 30 123456-7. +1-2 ++33 1 23 45 67 89", "+1 988 555 2485 4111 1111 1111 1111",
    "write to joe [at] mail [dot] com or call (555) 123-4567, token = \"0641917ea4e9feb9cda83477\"", "a" * 20_000 + " " + "1" * 20_000 + " " + "a.b" * 5000 + "@", "x@y.zz " * 400,
    "1-2-3-4-5-6-7-8-9-0-1-2-3 4539 1488 0343 6467", "\n+4 9 3 0 1 2 3 4 5 6 7 8\n", "10.0.0.1:80 v1.2.3.4",
]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_by_hand(text):
    out = []
    for n, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), n, m.end()))
    return sorted(out)


def check(df):
    wanted = sorted((r["doc_id"], base_by_hand(r["text"])) for r in df.select("doc_id", "text").collect())
    got = private_data.find_private_data(df).collect()
    assert sorted((r["doc_id"], [tuple(s)[:3] for s in r["base"]]) for r in got) == wanted
    for r in got:
        assert {tuple(s)[:3] for s in r["base"]} <= {tuple(s)[:3] for s in r["spans"]}
        assert [s["start"] for s in r["spans"]] == sorted(s["start"] for s in r["spans"])
    return got


def test_given_documents(spark):
    got = check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert any(s["kind"] == 4 for r in got for s in r["spans"])


def test_odd_texts(spark):
    rows = [(i, t, "x", i, t) for i, t in enumerate(ODD)] + [(3, ODD[3], "x", 3, None)]
    check(spark.createDataFrame(rows, "doc_id long, text string, spans string, t long, base string").repartition(3))
    df = spark.createDataFrame(rows[:2], "doc_id long, text string, spans string, t long, base string")
    check(df)
    assert private_data.find_private_data(df.limit(0)).count() == 0


def test_query_columns(spark):
    df = queries.op4_weak_supervision(spark, "/root/testdata/sf0.001")
    assert df.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    row = df.where("n_email > 0 and n_phone > 0").first()
    assert re.fullmatch(r"(\w+:\d+:\d+,?)+", row["spans"])
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


def test_em_learns_who_is_right():
    # Labeler 0 and 1 agree with the truth, 2 is a coin, 3 never speaks.
    patterns = [(0, (1, 1, c, -1), 100) for c in (0, 1)] + [(0, (0, 0, c, -1), 300) for c in (0, 1)] + [(0, (1, 0, 1, -1), 5)]
    truth = private_data.label_reliabilities(patterns)
    assert min(truth[0, (1, 1, c, -1)] for c in (0, 1)) > 0.95 > 0.05 > max(truth[0, (0, 0, c, -1)] for c in (0, 1))
    assert private_data.label_reliabilities([]) == {}


@pytest.mark.parametrize("digits", ["4539148803436467", "0", "18", "8273123273520569"])
def test_luhn(spark, digits):
    assert spark.range(1).select(private_data.luhn(F.lit(digits))).first()[0] == luhn(digits)
