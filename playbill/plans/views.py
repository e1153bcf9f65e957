"""Title and people tables derived from the driver's tables, in Spark and as SQL text."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.functions import first_list_member, first_number

# The same views for the SQL oracle.
CATALOG_SQL = """
SELECT o_orderkey AS id,
 CASE o_orderstatus WHEN 'F' THEN 'MOVIE' WHEN 'O' THEN 'SHOW' ELSE 'OTHER' END AS type,
 'T' || CAST(o_orderkey AS VARCHAR) AS title,
 CAST(year(o_orderdate) AS INT) AS release_year,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE strftime(o_orderdate, '%B %-d, %Y') END AS date_added,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS rating,
 CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 180 + 1 AS VARCHAR) || ' min'
      ELSE CAST(o_orderkey % 9 + 1 AS VARCHAR) || ' Seasons' END AS duration,
 CASE WHEN o_orderkey % 7 = 0 THEN NULL
      ELSE CAST(floor(o_totalprice / 5000) AS DOUBLE) / CAST(10 AS DOUBLE) END AS score,
 n1.n_name || CASE WHEN o_orderkey % 3 = 0 THEN ', ' || n2.n_name ELSE '' END AS countries,
 CASE WHEN o_orderkey % 17 = 0 THEN 'No Data'
      ELSE lower(c_mktsegment) || ', ' || lower(substr(o_orderpriority, 3)) END AS genres
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation n1 ON c_nationkey = n1.n_nationkey
JOIN nation n2 ON (c_nationkey + 1) % 25 = n2.n_nationkey"""

CREDITS_SQL = """
SELECT l_orderkey AS id, s_name AS name,
 CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE 'C' || CAST(l_partkey AS VARCHAR) END AS "character",
 CASE WHEN l_returnflag = 'R' THEN 'DIRECTOR' ELSE 'ACTOR' END AS role
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""

CATALOG_SCHEMA = (
    "id bigint, type string, title string, release_year int, date_added string, rating string, "
    "duration string, score double, countries string, genres string"
)


class Tables:
    """Lazy access to one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def catalog(self) -> DataFrame:
        """One row per title."""
        key = F.col("o_orderkey")
        near = self["nation"].select(
            F.col("n_nationkey").alias("__near"), F.col("n_name").alias("near_name")
        )
        rows = (
            self["orders"]
            .join(self["customer"], F.col("o_custkey") == F.col("c_custkey"))
            .join(self["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
            .join(near, (F.col("c_nationkey") + 1) % 25 == F.col("__near"))
        )
        is_movie = F.col("o_orderstatus") == "F"
        return rows.select(
            key.alias("id"),
            F.when(is_movie, "MOVIE").when(F.col("o_orderstatus") == "O", "SHOW").otherwise("OTHER").alias("type"),
            F.concat(F.lit("T"), key.cast("string")).alias("title"),
            F.year("o_orderdate").alias("release_year"),
            F.when(key % 11 != 0, F.date_format("o_orderdate", "MMMM d, yyyy")).alias("date_added"),
            F.when(key % 13 != 0, F.col("o_orderpriority")).alias("rating"),
            F.when(is_movie, F.concat((key % 180 + 1).cast("string"), F.lit(" min")))
            .otherwise(F.concat((key % 9 + 1).cast("string"), F.lit(" Seasons")))
            .alias("duration"),
            F.when(key % 7 != 0, F.floor(F.col("o_totalprice") / 5000).cast("double") / 10).alias("score"),
            F.concat(
                F.col("n_name"),
                F.when(key % 3 == 0, F.concat(F.lit(", "), F.col("near_name"))).otherwise(""),
            ).alias("countries"),
            F.when(key % 17 == 0, "No Data")
            .otherwise(F.concat(F.lower("c_mktsegment"), F.lit(", "), F.lower(F.substring("o_orderpriority", 3, 99))))
            .alias("genres"),
        )

    @cached_property
    def credits(self) -> DataFrame:
        """One row per person, title and role."""
        rows = self["lineitem"].join(self["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        return rows.select(
            F.col("l_orderkey").alias("id"),
            F.col("s_name").alias("name"),
            F.when(F.col("l_partkey") % 6 != 0, F.concat(F.lit("C"), F.col("l_partkey").cast("string"))).alias("character"),
            F.when(F.col("l_returnflag") == "R", "DIRECTOR").otherwise("ACTOR").alias("role"),
        )

    @cached_property
    def model_titles(self) -> DataFrame:
        """Movies and shows with the features of the models; gaps as in the catalog."""
        lines = self["lineitem"].groupBy(F.col("l_orderkey").alias("id")).agg(
            F.count_if(F.col("l_returnflag") != "R").alias("actor_count"),
            (F.avg("l_extendedprice") / 1000).alias("popularity"),
            (F.avg("l_quantity") / 5).alias("second_score"),
        )
        titles = self.catalog.filter(F.col("type").isin("MOVIE", "SHOW"))
        return titles.join(lines, "id", "left").select(
            "id",
            "title",
            "type",
            first_list_member(F.col("genres")).alias("main_genre"),
            "rating",
            "score",
            "second_score",
            "popularity",
            first_number(F.col("duration")).alias("runtime"),
            F.coalesce("actor_count", F.lit(0)).alias("actor_count"),
            "release_year",
        )
