"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.llm.groups import stored

KINDS = ("email", "ip", "card", "phone", "secret")


class Pattern(NamedTuple):
    """A labeler by pattern; strict ones make base spans."""

    kind: str
    strict: bool
    regex: str
    hint: str


# A match of a run begins where the run begins or the last match ended (\G), so
# long runs are tried once. Possessive quantifiers never give back.
PATTERNS = (
    Pattern("email", True, r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Pattern("ip", True, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    Pattern("card", True, r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])", ""),
    Pattern("phone", True, r"\+[0-9][ ().0-9-]*[ ().0-9-][0-9]", "+"),
    Pattern("email", False, r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]++)++", "at"),
    Pattern("phone", False, r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])", ""),
    Pattern("secret", False, r"(?i:token|secret|passwor[dt]|api[_-]?key) ?[=:] ?[\"']?[A-Za-z0-9_/+-]{12,}+", ""),
)

# Cue words that speak for and against each kind, just before a span.
CUES = {
    "email": ("mail|contact|write to|reach", "import|package"),
    "ip": ("ip|host|server|address|login", "version|release|section|chapter"),
    "card": ("card|visa|credit|pay|amex|account", "isbn|order|serial|tracking"),
    "phone": ("phone|tel|call|fax|mobile|contact", "isbn|order|serial|score"),
    "secret": ("token|secret|passwor|key", "example|sample"),
}
# Gazetteers of domain ends, card number beginnings and country codes.
DOMAIN_ENDS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|ch|at|us|ca|nl|be|pl|pt|mx|br|jp|cn|in"
CARD_STARTS = "4|5[1-5]|2[2-7]|3[47]|6011|65"
COUNTRY_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"

LABELERS = ("pattern", "gazetteer", "context", "shape")
_BLOCK = 128


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def _block_totals(sizes: str) -> Column:
    """Sums of every _BLOCK sizes, so that a place needs few additions."""
    blocks = F.sequence(F.lit(0), F.floor(F.size(sizes) / _BLOCK).cast("int"))
    return F.transform(blocks, lambda b: _total(F.slice(sizes, b * _BLOCK + 1, F.lit(_BLOCK))))


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    back = F.reverse(digits)

    def value(i: Column) -> Column:
        d = F.substr(back, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    """The base rule of a kind for a match of its strict pattern."""
    part = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
    rules = {
        "ip": hit.rlike(rf"^{part}(?:\.{part}){{3}}$"),
        "card": luhn(_digits(hit)),
        "phone": F.length(_digits(hit)).between(9, 15),
    }
    return rules.get(kind, F.lit(True))


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1 for, 0 against, -1 if the labeler has nothing to say."""
    out = F.when(yes, 1)
    return (out.when(no, 0).otherwise(-1) if no is not None else out.otherwise(0)).cast("int")


def _votes(kind: str, base: Column, hit: Column, before: Column) -> list[Column]:
    digits, low = _digits(hit), F.lower(before)
    gazetteer = {
        "email": _vote(hit.rlike(rf"(?i)[.\])] ?(?:{DOMAIN_ENDS})$")),
        "ip": _vote(~hit.rlike(r"^(?:0|127|255)\.")),
        "card": _vote(digits.rlike(f"^(?:{CARD_STARTS})")),
        "phone": _vote(hit.startswith("+") & digits.rlike(f"^(?:{COUNTRY_CODES})"), hit.startswith("+")),
        "secret": _vote(hit.rlike("[=:].*[0-9]") & hit.rlike("[=:].*[A-Za-z]")),
    }[kind]
    shape = {
        "email": _vote(~hit.contains("..") & (F.length(hit) <= 64)),
        "ip": _vote(~hit.rlike(r"(?:^|\.)0[0-9]")),
        "card": _vote(F.length(digits).between(13, 16) & (hit.rlike("^[0-9]+$") | hit.rlike("^[0-9]{4}[ -]"))),
        "phone": _vote(F.length(digits).between(10, 13) & ~hit.rlike(r"[ .-]{2}")),
        "secret": _vote(F.length(hit) >= 20),
    }[kind]
    yes, no = CUES[kind]
    context = _vote(low.rlike(rf"(?:^|[^a-z])(?:{yes})"), low.rlike(rf"(?:^|[^a-z])(?:{no})"))
    return [_vote(base), gazetteer, context, shape]


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) of each row: all that some pattern finds, with the votes on it.

    A span: start, end (code points, end exclusive), kind (number in KINDS), base,
    votes, and size (its length in steps of eight, seven at most).
    """
    rows = docs.select(docs[key].alias("__key"), F.coalesce(docs[text], F.lit("")).alias("t"))
    empty = F.array().cast("array<string>")
    for n, p in enumerate(PATTERNS):
        may = F.instr("t", p.hint) > 0 if p.hint else F.col("t").rlike("[0-9]")
        hits = F.when(may, F.regexp_extract_all("t", F.lit(p.regex), F.lit(0))).otherwise(empty)
        rows = rows.withColumn(f"h{n}", hits)
    # Between two matches lies one part of the split text; places follow from lengths.
    for n, p in enumerate(PATTERNS):
        parts = F.when(F.size(f"h{n}") > 0, F.split("t", p.regex, -1)).otherwise(empty)
        rows = rows.withColumn(f"p{n}", parts)
    numbers = range(len(PATTERNS))
    rows = rows.withColumns({f"s{n}": F.zip_with(f"h{n}", F.slice(f"p{n}", F.lit(1), F.size(f"h{n}")), lambda h, p: F.length(h) + F.length(p)) for n in numbers})
    rows = rows.withColumns({f"b{n}": _block_totals(f"s{n}") for n in numbers})

    def spans_of(n: int, p: Pattern) -> Column:
        def span(h: Column, i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            ahead = _total(F.slice(f"b{n}", F.lit(1), block)) + _total(F.slice(f"s{n}", block * _BLOCK + 1, i % _BLOCK))
            part = F.get(f"p{n}", i)
            start = (ahead + F.length(part)).cast("long")
            base = _valid(p.kind, h) if p.strict else F.lit(False)
            votes = F.array(*_votes(p.kind, base, h, F.right(part, F.lit(32))))
            size = F.least(F.floor(F.length(h) / 8), F.lit(7)).cast("int")
            return F.struct(
                start.alias("start"), F.lit(KINDS.index(p.kind)).alias("kind"), (start + F.length(h)).alias("end"),
                base.alias("base"), votes.alias("votes"), size.alias("size"),
            )

        return F.transform(f"h{n}", span)

    spans = F.concat(*(spans_of(n, p) for n, p in enumerate(PATTERNS)))
    return rows.select("__key", F.array_sort(spans).alias("spans"))


def label_reliabilities(patterns: list[tuple[int, tuple[int, ...], int]], steps: int = 100) -> dict[tuple[int, tuple[int, ...]], float]:
    """Expectation-maximisation over vote patterns: (kind, votes) -> chance of a true span.

    ``patterns`` has (kind, votes, how many). Each labeler has, for each kind, a
    rate of yes on true spans and on false ones; votes are independent given the
    truth, abstaining says nothing. It starts from the share of yes votes.
    """
    found: dict[tuple[int, tuple[int, ...]], float] = {}
    for kind in sorted({p[0] for p in patterns}):
        own = sorted((v, n) for k, v, n in patterns if k == kind)
        truth = {v: (1 + v.count(1)) / (2 + v.count(1) + v.count(0)) for v, _ in own}
        for _ in range(steps):
            prior = (1 + sum(n * truth[v] for v, n in own)) / (2 + sum(n for _, n in own))
            rates = []
            for j in range(len(own[0][0])):
                spoke = [(v, n) for v, n in own if v[j] >= 0]
                true = sum(n * truth[v] for v, n in spoke)
                false = sum(n * (1 - truth[v]) for v, n in spoke)
                # One true and one false span are added on the expected side.
                yes_true = (2 + sum(n * truth[v] for v, n in spoke if v[j])) / (3 + true)
                yes_false = (1 + sum(n * (1 - truth[v]) for v, n in spoke if v[j])) / (3 + false)
                rates.append((yes_true, yes_false))
            for v, _ in own:
                odds = math.log(prior / (1 - prior))
                for vote, (t, f) in zip(v, rates):
                    if vote >= 0:
                        odds += math.log(t / f) if vote else math.log((1 - t) / (1 - f))
                truth[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        found |= {(kind, v): p for v, p in truth.items()}
    return found


def _features(kind: Column, votes: Column, size: Column) -> list[Column]:
    """Numbers the span classifier sees: kind, each labeler's yes and no, length."""
    out = [(kind == k).cast("double") for k in range(len(KINDS))]
    for j in range(len(LABELERS)):
        out += [(F.get(votes, F.lit(j)) == v).cast("double") for v in (1, 0)]
    return [*out, size.cast("double") / 7]


def span_classifier(spark: SparkSession, found: DataFrame) -> list[float] | None:
    """Weights of a logistic regression on the EM labels, its intercept last.

    Spans are first counted by kind, votes and length, so at most a few thousand
    rows come to the driver and into the fit, however many spans there are.
    """
    each = found.select(F.explode("spans").alias("s"))
    counted = each.groupBy("s.kind", "s.votes", "s.size").agg(F.count("*").alias("n")).collect()
    patterns: dict[tuple[int, tuple[int, ...]], int] = {}
    for r in counted:
        k = (r["kind"], tuple(r["votes"]))
        patterns[k] = patterns.get(k, 0) + r["n"]
    if not patterns:
        return None
    truth = label_reliabilities([(k, v, n) for (k, v), n in patterns.items()])
    rows = []
    for r in sorted(counted):
        p = truth[r["kind"], tuple(r["votes"])]
        votes = F.array(*(F.lit(v) for v in r["votes"]))
        for label, weight in ((1.0, r["n"] * p), (0.0, r["n"] * (1 - p))):
            rows.append(F.struct(
                F.lit(r["kind"]).alias("kind"), votes.alias("votes"), F.lit(r["size"]).alias("size"),
                F.lit(label).alias("label"), F.lit(float(weight)).alias("weight"),
            ))
    table = spark.range(0, 1, 1, 1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    x = array_to_vector(F.array(*_features(F.col("kind"), F.col("votes"), F.col("size"))))
    model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=50, standardization=False).fit(
        table.select(x.alias("features"), "label", "weight")
    )
    return [*map(float, model.coefficients), float(model.intercept)]


def find_private_data(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """Spans of personal data in each whole text.

    Base spans are matches of the strict patterns that pass their rule; they
    always stay. A candidate that is none of these is added if the classifier
    gives it ``least`` or more and it overlaps no base span.

    One output row per input row: key, base and spans, both arrays of (start,
    kind, end, p) by start and kind; kind is a number in KINDS, p the
    classifier's probability. Null and empty texts have no spans, repeated rows
    are searched each, an empty table gives no row.
    """
    spark = docs.sparkSession
    found = stored(candidates(docs, key, text), "spans")
    weights = span_classifier(spark, found) or [0.0]

    def scored(s: Column) -> Column:
        total = F.lit(weights[-1])
        for w, x in zip(weights[:-1], _features(s["kind"], s["votes"], s["size"])):
            total = total + w * x
        p = 1 / (1 + F.exp(-total))
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), p.alias("p"), s["base"].alias("base"))

    scores = found.select("__key", F.transform("spans", scored).alias("all"))
    base = scores.withColumn("base", F.filter("all", lambda s: s["base"]))

    def added(s: Column) -> Column:
        clear = ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return s["base"] | ((s["p"] >= least) & clear)

    kept = base.withColumn("all", F.filter("all", added))
    plain = lambda c: F.transform(c, lambda s: F.struct(s["start"], s["kind"], s["end"], s["p"]))
    return kept.select(F.col("__key").alias(key), plain("base").alias("base"), plain("all").alias("spans"))


def span_text(spans: str) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])))
