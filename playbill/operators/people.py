"""People per title: counts, cast lists and the enrichment of titles with both.

A list cell can hold only so much, and one title may own a large part of all
credits. So a cast is rows of (id, part, cast) at every size: up to ``part_rows``
names a row, one row for an ordinary title, more for a longer cast. No task
gathers an unbounded group and no name is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.functions.text import NO_DATA

PART_ROWS = 1_000_000


def people_per_title(credits: DataFrame, role: str = "ACTOR", out: str = "actor_count") -> DataFrame:
    """People of a role per title."""
    return credits.filter(F.col("role") == role).groupBy("id").agg(F.count(F.lit(1)).alias(out))


def _cast_rows(credits: DataFrame, role: str, part_rows: int) -> DataFrame:
    """(id, actor_count, part, cast) of every title with credits of the role.

    All rows of the role count, those with a name are listed. Repeats of a name
    collapse to a number first; counts and lists both come from that one
    aggregate. A name goes to a part by its hash, one that repeats more than
    ``part_rows`` times fills parts of its own, and a part that comes out longer
    than ``part_rows`` is cut.
    """
    named = credits.filter(F.col("role") == role).groupBy("id", "name").agg(F.count(F.lit(1)).alias("n"))
    listed = F.sum(F.when(F.col("name").isNotNull(), F.col("n")).otherwise(0))
    totals = named.groupBy("id").agg(F.sum("n").alias("actor_count"), listed.alias("listed"))
    rows = named.join(totals, "id").filter("name IS NOT NULL OR listed = 0")
    parts = F.greatest(F.ceil(F.col("listed") / part_rows), F.lit(1))
    last = F.when(F.col("name").isNull(), F.lit(0)).otherwise(F.ceil(F.col("n") / part_rows) - 1)
    chunks = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("chunk"))
    part = F.col("chunk") * parts + F.pmod(F.xxhash64("name"), parts)
    taken = F.least(F.lit(part_rows), F.col("n") - F.col("chunk") * part_rows).cast("int")
    name = F.when(F.col("name").isNotNull(), F.struct(F.col("name"), taken.alias("n")))
    gathered = (
        chunks.select("id", "actor_count", part.alias("part"), name.alias("named"))
        .groupBy("id", "actor_count", "part")
        .agg(F.sort_array(F.collect_list("named")).alias("names"))
    )
    whole = gathered.select(
        "id", "actor_count", "part", F.flatten(F.transform("names", lambda x: F.array_repeat(x["name"], x["n"]))).alias("all")
    )
    last = F.greatest(F.ceil(F.size("all") / part_rows) - 1, F.lit(0)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("all", i * part_rows + 1, F.lit(part_rows)))
    cut = whole.select("id", "actor_count", "part", F.posexplode(pieces).alias("piece", "cast"))
    return cut.select("id", "actor_count", (F.col("part") + F.shiftleft(F.col("piece").cast("long"), 32)).alias("part"), "cast")


def cast_list(credits: DataFrame, role: str = "ACTOR", part_rows: int = PART_ROWS) -> DataFrame:
    """Sorted names per title as an array, ``(id, part, cast)``.

    ``part`` is 0 for every title with at most ``part_rows`` names; a longer list
    comes as several rows that together hold all names, each at most
    ``part_rows``.
    """
    return _cast_rows(credits, role, part_rows).filter(F.size("cast") > 0).select("id", "part", "cast")


def cast_text(lists: DataFrame, sep: str = ",") -> DataFrame:
    """List cells as text, for export; inside, arrays keep names with commas whole."""
    return lists.withColumn("cast", F.array_join("cast", sep))


def attach_people(
    titles: DataFrame, credits: DataFrame, role: str = "ACTOR", part_rows: int = PART_ROWS
) -> DataFrame:
    """Titles with actor_count, part and cast (an array, ``[No Data]`` where nobody is listed).

    One row per title and part of its cast: one for every title with at most
    ``part_rows`` names, several that together hold all names for a longer cast.
    The count, the same in each of them, is that of all rows of the role.
    """
    joined = titles.join(_cast_rows(credits, role, part_rows), "id", "left")
    nobody = F.array(F.lit(NO_DATA))
    return joined.select(
        *titles.columns,
        F.coalesce("actor_count", F.lit(0)).cast("long").alias("actor_count"),
        F.coalesce("part", F.lit(0)).cast("long").alias("part"),
        F.when(F.size("cast") > 0, F.col("cast")).otherwise(nobody).alias("cast"),
    )
