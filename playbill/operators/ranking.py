"""Orders, limits, top-k and best rows. Every cut has a tie key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbill.functions import contains_ignoring_case, split_trimmed
from playbill.functions.text import NO_DATA
from playbill.operators.derive import explode_list

_SALTS = 64


def order_by(df: DataFrame, by: Sequence[tuple[str, str]]) -> DataFrame:
    """Sort by ``[(column, "asc" | "desc")]``."""
    return df.orderBy(*[F.desc(c) if d == "desc" else F.asc(c) for c, d in by])


def n_largest(df: DataFrame, col: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The n rows with the largest values; planned as a top-k, not as a sort."""
    rest = ties or [c for c in df.columns if c != col]
    return df.orderBy(F.desc(col), *rest).limit(n)


def top_k_by(
    df: DataFrame, key: str, score: str, k: int, ties: Sequence[str], out: str = "rank"
) -> DataFrame:
    """The k best rows per key.

    The planner turns a small k into a group limit ahead of the shuffle, so a
    task sends at most k rows per key. For a k above its threshold the rows of a
    key are first cut within salted parts, which keeps a hot key off one task.
    """
    best = [F.desc(score), *ties]
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k > threshold:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS))
        parts = Window.partitionBy(key, "__salt").orderBy(*best)
        df = (
            df.withColumn("__salt", salt)
            .withColumn("__cut", F.row_number().over(parts))
            .filter(F.col("__cut") <= k)
            .drop("__salt", "__cut")
        )
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*best))
    return df.withColumn(out, rank).filter(F.col(out) <= k)


def top_members(
    df: DataFrame, col: str, k: int = 50, sentinels: Sequence[str] = ("", NO_DATA), out: str = "category"
) -> DataFrame:
    """The k commonest list members, rarest first; cells that stand for missing are left out."""
    cells = df.select(col).filter(~F.col(col).isin(*sentinels))
    counts = explode_list(cells, col, out).groupBy(out).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), out).limit(k).orderBy("count", F.desc(out))


def matched_countries(countries: Column, wanted: Sequence[str], match: str = "member") -> Column:
    """The wanted countries a title belongs to, each once.

    ``member`` compares list members, ``contains`` looks for the name anywhere in
    the text, whatever the case. Works on a literal list, so no join is needed.
    """
    names = F.array(*[F.lit(c) for c in wanted])
    if match == "member":
        return F.array_intersect(names, split_trimmed(countries))
    flags = [F.when(contains_ignoring_case(countries, c), F.lit(c)) for c in wanted]
    return F.array_compact(F.array(*flags))


def top_people(
    titles: DataFrame,
    wanted: Sequence[str],
    k: int = 25,
    credits: DataFrame | None = None,
    match: str = "member",
    trim: bool = True,
    countries: str = "countries",
    length: str = "duration",
    cast: str = "cast",
    role: str = "ACTOR",
) -> DataFrame:
    """Per country, the k people with most appearances in its titles, in one job.

    People come from the titles' own list column, or from a credits table
    (id, name, role). Titles without a length and the ``No Data`` cast are left
    out. With credits, the join on the title id is an ordinary shuffle join: AQE
    splits a title that holds a large part of all credits.
    """
    dated = titles.filter(F.col(length).isNotNull())
    if titles.schema[length].dataType.typeName() == "string":
        dated = dated.filter(F.col(length) != "")
    located = F.explode(matched_countries(F.col(countries), wanted, match)).alias("country")
    if credits is None:
        listed = dated.select(located, cast)
        if titles.schema[cast].dataType.typeName() == "string":
            listed = listed.filter(F.col(cast) != NO_DATA)
        people = explode_list(listed, cast, "name", trim=trim)
    else:
        name = F.trim("name") if trim else F.col("name")
        cast_rows = credits.filter(F.col("role") == role).select("id", name.alias("name"))
        people = dated.select("id", located).join(cast_rows, "id")
    people = people.filter(~F.col("name").isin("", NO_DATA))
    counts = people.groupBy("country", "name").agg(F.count(F.lit(1)).alias("count"))
    return top_k_by(counts, "country", "count", k, ["name"])


def mark_best(df: DataFrame, metric: str, out: str = "is_best") -> DataFrame:
    """Flag the rows that reach the highest value; a row without one is not among them."""
    best = F.col(metric) == df.agg(F.max(metric)).scalar()
    return df.withColumn(out, F.coalesce(best, F.lit(False)))


def arg_best(df: DataFrame, name: str, metric: str) -> DataFrame:
    """The name with the highest value, the smaller name on a tie, and that value."""
    return n_largest(df.select(name, metric), metric, 1, [name])


def stack(dfs: Sequence[DataFrame]) -> DataFrame:
    """Append tables with the same columns."""
    return reduce(DataFrame.unionByName, dfs)
