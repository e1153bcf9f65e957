"""Queries over sources, profiles, repairs, filters and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.operators import clean, derive, filters, profile
from playbill.operators.aggregates import count_by, country_total, trend, type_ratio
from playbill.operators.joins import with_total
from playbill.plans.registry import over_views, register, rounded
from playbill.plans.views import CATALOG_SCHEMA, Tables
from playbill.session import scratch_path
from playbill.sources import (
    first_columns,
    read_result,
    read_titles_csv,
    write_partitioned,
    write_result,
    write_table,
)

TYPES = ["MOVIE", "SHOW"]

# -- sources and sinks ---------------------------------------------------------


def _through(t: Tables, label: str, write) -> str:
    path = scratch_path(t.spark, label)
    write(path)
    return path


def _csv_scan(t: Tables) -> DataFrame:
    path = _through(t, "csv", lambda p: write_table(t.catalog, p, "csv"))
    return read_titles_csv(t.spark, path, CATALOG_SCHEMA)


def _result_scan(t: Tables) -> DataFrame:
    return read_result(t.spark, _through(t, "result", lambda p: write_table(count_by(t.catalog, "type"), p)))


def _result_sink(t: Tables) -> DataFrame:
    result = rounded(trend(t.catalog, "release_year", TYPES), "percent")
    path = _through(t, "trend", lambda p: write_result(result, p))
    return read_result(t.spark, path, "type string, release_year int, count bigint, percent double", "csv")


def _keyed_sink(t: Tables) -> DataFrame:
    counts = country_total(t.catalog).withColumnRenamed("country", "key")
    path = _through(t, "keyed", lambda p: write_result(counts, p, label="country"))
    return read_result(t.spark, path, "country string, count bigint", "csv")


def _partitioned_sink(t: Tables) -> DataFrame:
    path = _through(t, "parts", lambda p: write_partitioned(t.catalog, p, "rating"))
    back = read_result(t.spark, path)
    return count_by(back, ["rating_key", "rating"])


COUNTRY_SQL = "SELECT trim(unnest(string_split(countries, ','))) AS country FROM catalog"
TREND_SQL = """
WITH g AS (SELECT type, {year} AS y, count(*) AS n FROM catalog WHERE type IN ('MOVIE', 'SHOW') GROUP BY 1, 2),
s AS (SELECT type, y, n, sum(n) OVER (PARTITION BY type) AS total FROM g)
SELECT type, y AS {out}, n AS "count", round(CAST(n * 100 / total AS DOUBLE), 6) AS "percent"
FROM s WHERE y IS NOT NULL"""

register("s01_csv_scan", _csv_scan, over_views("SELECT * FROM catalog"))
register(
    "s02_first_n_columns",
    lambda t: first_columns(t["orders"], 3),
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
)
register("s03_result_scan", _result_scan, over_views('SELECT type, count(*) AS "count" FROM catalog GROUP BY 1'))
register(
    "s04_table_sink",
    lambda t: read_result(t.spark, _through(t, "table", lambda p: write_table(t.catalog, p))),
    over_views("SELECT * FROM catalog"),
)
register("s05_result_sink", _result_sink, over_views(TREND_SQL.format(year="release_year", out="release_year")))
register(
    "s06_keyed_sink",
    _keyed_sink,
    over_views(f'SELECT country, count(*) AS "count" FROM ({COUNTRY_SQL}) GROUP BY 1'),
)
register(
    "s07_partitioned_sink",
    _partitioned_sink,
    over_views(
        "SELECT replace(rating, ' ', '_') AS rating_key, rating, count(*) AS \"count\" FROM catalog "
        "GROUP BY 1, 2"
    ),
)

# -- profiles and repairs ------------------------------------------------------

CATALOG_TYPES = [c.strip().split(" ") for c in CATALOG_SCHEMA.split(",")]


def _per_column(select: str) -> str:
    return over_views(
        "SELECT * FROM ("
        + " UNION ALL ".join(f"SELECT {select.format(c=c, t=t)} FROM catalog" for c, t in CATALOG_TYPES)
        + ")"
    )


register(
    "c01_shape",
    lambda t: profile.shape(t["orders"]),
    'SELECT count(*) AS "rows", CAST(6 AS INT) AS "columns" FROM orders',
)
register(
    "c02_column_profile",
    lambda t: profile.column_profile(t.catalog),
    _per_column("'{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null"),
)
register(
    "c03_preview",
    lambda t: profile.preview(t["orders"], 100, ["o_orderkey"]).withColumn("o_orderdate", F.col("o_orderdate").cast("string")),
    "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate) FROM orders ORDER BY o_orderkey LIMIT 100",
)
register(
    "c04_null_rate",
    lambda t: profile.null_rate(t.catalog),
    _per_column(
        "'{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 100.0::DOUBLE ELSE 0 END), 2) AS null_rate"
    )
    + " WHERE null_rate > 0",
)
register(
    "c05_null_count",
    lambda t: profile.null_count(t.catalog),
    _per_column("'{c}' AS \"column\", count(*) - count({c}) AS null_count"),
)
register(
    "c06_fill_mode",
    lambda t: clean.fill_mode(t.catalog, ["rating"]).select("id", "rating"),
    over_views(
        "WITH m AS (SELECT rating AS common FROM catalog WHERE rating IS NOT NULL "
        "GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) "
        "SELECT id, coalesce(rating, common) AS rating FROM catalog, m"
    ),
)
register(
    "c07_fill_median",
    lambda t: clean.fill_median(t.catalog, ["score"]).select("id", "score"),
    over_views(
        "WITH m AS (SELECT median(score) AS middle FROM catalog) "
        "SELECT id, coalesce(score, middle) AS score FROM catalog, m"
    ),
)
register(
    "c07_fill_median_wide",
    lambda t: clean.fill_median(
        t["lineitem"].select(
            "l_orderkey",
            *[F.when(F.col("l_partkey") % 5 != 0, F.col(c)).alias(c) for c in ("l_extendedprice", "l_quantity")],
        ),
        ["l_extendedprice", "l_quantity"],
    ),
    """WITH v AS (SELECT l_orderkey, CASE WHEN l_partkey % 5 <> 0 THEN l_extendedprice END AS l_extendedprice,
    CASE WHEN l_partkey % 5 <> 0 THEN l_quantity END AS l_quantity FROM lineitem),
    m AS (SELECT median(l_extendedprice) AS p, median(l_quantity) AS q FROM v)
    SELECT l_orderkey, coalesce(l_extendedprice, p) AS l_extendedprice, coalesce(l_quantity, q) AS l_quantity
    FROM v, m""",
)
register(
    "c08_fill_constant",
    lambda t: clean.fill_constant(t.catalog, {"rating": "No Data", "score": 0}).select("id", "rating", "score"),
    over_views("SELECT id, coalesce(rating, 'No Data') AS rating, coalesce(score, 0) AS score FROM catalog"),
)
register(
    "c09_drop_null_any",
    lambda t: clean.drop_nulls(t.catalog),
    over_views(
        "SELECT * FROM catalog WHERE date_added IS NOT NULL AND rating IS NOT NULL AND score IS NOT NULL"
    ),
)
register(
    "c10_drop_null_subset",
    lambda t: clean.drop_nulls(t.catalog, ["rating", "score"]),
    over_views("SELECT * FROM catalog WHERE rating IS NOT NULL AND score IS NOT NULL"),
)
register(
    "c11_dedup_all",
    lambda t: clean.dedup(t["lineitem"].select("l_returnflag", "l_linestatus", "l_linenumber")),
    "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
)
register(
    "c12_dedup_key",
    lambda t: clean.dedup_by(
        t["lineitem"].withColumn("l_shipdate", F.col("l_shipdate").cast("string")), ["l_orderkey"], ["l_linenumber", "l_partkey"]
    ),
    """SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
    l_returnflag, l_linestatus, l_shipdate) = 1""",
)
register(
    "c13_cast",
    lambda t: clean.cast_columns(
        t["orders"].select("o_orderkey", "o_custkey", "o_totalprice"),
        {"o_custkey": "string", "o_totalprice": "int"},
    ),
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(trunc(o_totalprice) AS INT) AS o_totalprice "
    "FROM orders",
)
register(
    "c14_coerce_numeric",
    lambda t: clean.coerce_numeric(
        t.catalog.select("id", "duration", F.split_part("duration", F.lit(" "), F.lit(1)).alias("amount")),
        ["duration", "amount"],
    ),
    over_views(
        "SELECT id, TRY_CAST(duration AS DOUBLE) AS duration, "
        "TRY_CAST(split_part(duration, ' ', 1) AS DOUBLE) AS amount FROM catalog"
    ),
)
register(
    "c15_sentinel_filter",
    lambda t: clean.drop_sentinels(t.catalog, "genres").select("id", "genres"),
    over_views("SELECT id, genres FROM catalog WHERE genres NOT IN ('', 'No Data')"),
)

# -- filters -------------------------------------------------------------------

register(
    "p01_project_rename",
    lambda t: filters.project(t["orders"], {"id": "o_orderkey", "price": "o_totalprice"}),
    "SELECT o_orderkey AS id, o_totalprice AS price FROM orders",
)
register(
    "p02_filter_eq",
    lambda t: filters.by_type(t["orders"], "o_orderstatus", "F").select("o_orderkey", "o_orderstatus"),
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
)
register(
    "p03_filter_or",
    lambda t: filters.by_type(t["orders"], "o_orderstatus", ["F", "O"]).select("o_orderkey", "o_orderstatus"),
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' OR o_orderstatus = 'O'",
)
register(
    "p04_filter_not_null",
    lambda t: filters.not_null(t.catalog, "score").select("id", "score"),
    over_views("SELECT id, score FROM catalog WHERE score IS NOT NULL"),
)
register(
    "p05_filter_in",
    lambda t: filters.in_set(t["nation"], "n_name", ["NATION_1", "NATION_3", "NATION_10", "NATION_99"]),
    "SELECT * FROM nation WHERE n_name IN ('NATION_1', 'NATION_3', 'NATION_10', 'NATION_99')",
)
register(
    "p06_filter_range",
    lambda t: filters.between(t.catalog, "release_year", 1996, 2000).select("id", "release_year"),
    over_views("SELECT id, release_year FROM catalog WHERE release_year BETWEEN 1996 AND 2000"),
)
register(
    "p07_filter_positive",
    lambda t: filters.positive(t["events"].select("event_id", (F.col("value") - 5).alias("value")), "value"),
    "SELECT event_id, value - 5 AS value FROM events WHERE value - 5 > 0",
)
register(
    "p08_contains_ci",
    lambda t: filters.contains_ci(t.catalog, "countries", "nation_1").select("id", "countries"),
    over_views("SELECT id, countries FROM catalog WHERE contains(lower(countries), 'nation_1')"),
)
register(
    "p09_member_match",
    lambda t: filters.has_member(t.catalog, "countries", "NATION_1").select("id", "countries"),
    over_views("SELECT id, countries FROM catalog WHERE list_contains(string_split(countries, ', '), 'NATION_1')"),
)

# -- derived columns -----------------------------------------------------------


def _list_text(t: Tables) -> DataFrame:
    """Genres as list literals, with some missing and some marked as missing."""
    quoted = F.concat(F.lit("['"), F.replace("genres", F.lit(", "), F.lit("', '")), F.lit("']"))
    return t.catalog.select(
        "id",
        F.when(F.col("id") % 19 != 0, F.when(F.col("genres") == "No Data", F.col("genres")).otherwise(quoted)).alias("genres"),
    )


LIST_SQL = """WITH v AS (SELECT id, CASE WHEN id % 19 <> 0 THEN CASE WHEN genres = 'No Data' THEN genres
 ELSE '[''' || replace(genres, ', ', ''', ''') || ''']' END END AS genres FROM catalog)"""

register(
    "f01_parse_date",
    lambda t: derive.parse_date(t.catalog, "date_added").select(
        "id", F.date_format("date_added", "yyyy-MM-dd").alias("date_added")
    ),
    over_views("SELECT id, strftime(try_strptime(date_added, '%B %d, %Y'), '%Y-%m-%d') AS date_added FROM catalog"),
)
register(
    "f02_year",
    lambda t: derive.year_of(t["orders"], "o_orderdate").select("o_orderkey", "year"),
    'SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS "year" FROM orders',
)
register(
    "f03_decade",
    lambda t: derive.decade_of(t.catalog, "release_year").select("id", "decade"),
    over_views('SELECT id, CAST(floor(release_year / 10) * 10 AS INT) AS "decade" FROM catalog'),
)
register(
    "f04_main_genre",
    lambda t: derive.first_member(_list_text(t), "genres").select("id", "main_genre"),
    over_views(
        LIST_SQL + " SELECT id, CASE WHEN genres IS NULL OR genres = 'No Data' THEN 'No Data' "
        "ELSE trim(split_part(trim(genres, '[]'''), ',', 1), ' ''') END AS main_genre FROM v"
    ),
)
register(
    "f05_strip_list",
    lambda t: derive.strip_list_text(_list_text(t), "genres"),
    over_views(LIST_SQL + " SELECT id, replace(replace(replace(genres, '[', ''), ']', ''), '''', '') AS genres FROM v"),
)
register(
    "f06_split_trim",
    lambda t: derive.split_list(t.catalog, "countries").select("id", F.array_join("countries", "|").alias("countries")),
    over_views("SELECT id, replace(countries, ', ', '|') AS countries FROM catalog"),
)
register(
    "f07_explode",
    lambda t: derive.explode_list(t.catalog, "countries", "country").select("id", "country"),
    over_views("SELECT id, trim(unnest(string_split(countries, ','))) AS country FROM catalog"),
)
register(
    "f07_explode_untrimmed",
    lambda t: derive.explode_list(t.catalog, "countries", "country", trim=False).select("id", "country"),
    over_views("SELECT id, unnest(string_split(countries, ',')) AS country FROM catalog"),
)
register(
    "f08_extract_number",
    lambda t: derive.extract_number(t.catalog, "duration").select("id", "duration"),
    over_views("SELECT id, TRY_CAST(regexp_extract(duration, '[0-9]+') AS DOUBLE) AS duration FROM catalog"),
)

BUCKET_SQL = (
    "CASE WHEN score >= 9 THEN '9-10' WHEN score >= 8 THEN '8-9' WHEN score >= 7 THEN '7-8' "
    "WHEN score >= 6 THEN '6-7' WHEN score >= 5 THEN '5-6' ELSE '<5' END"
)

register(
    "f09_bucket",
    lambda t: derive.bucket(t.catalog, "score").select("id", "bucket"),
    over_views(f"SELECT id, {BUCKET_SQL} AS bucket FROM catalog"),
)
register(
    "f10_percent_of",
    lambda t: rounded(derive.percent_of(with_total(count_by(t.catalog, "type"), "count"), "count", "total"), "percent"),
    over_views(
        'WITH g AS (SELECT type, count(*) AS "count" FROM catalog GROUP BY 1), '
        's AS (SELECT CAST(sum("count") AS BIGINT) AS total FROM g) '
        'SELECT type, "count", total, round(CAST("count" * 100 / total AS DOUBLE), 6) AS "percent" FROM g, s'
    ),
)
register(
    "f11_rescale",
    lambda t: rounded(derive.rescale(t.catalog, "release_year", 1900, 10).select("id", "release_year"), "release_year"),
    over_views("SELECT id, round((release_year - 1900) / CAST(10 AS DOUBLE), 6) AS release_year FROM catalog"),
)
register(
    "f12_percent_label",
    lambda t: derive.percent_label(
        type_ratio(derive.explode_list(t.catalog, "countries", "country"), "country", TYPES, 25), "MOVIE", 0.32, 1
    ).select("country", "label"),
    over_views(
        f"WITH b AS (SELECT type, {COUNTRY_SQL[7:]}), g AS (SELECT country, "
        "CAST(count(*) FILTER (type = 'MOVIE') AS DOUBLE) / count(*) AS r FROM b GROUP BY 1) "
        "SELECT country, CASE WHEN r > 0.32 THEN format('{:.1f}%', r * 100) ELSE '' END AS \"label\" FROM g"
    ),
)
register(
    "f13_normal_density",
    lambda t: rounded(
        derive.normal_density(t["events"], "value", 50, 20).select("event_id", "density"), "density", digits=9
    ),
    "SELECT event_id, round(exp(-(value - 50) * (value - 50) / 800) / (20 * sqrt(2 * pi())), 9) AS density FROM events",
)
