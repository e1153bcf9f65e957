"""Queries over joins, aggregates, windows, rankings, stacks and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.operators import aggregates, distribution, joins, people, profile, ranking
from playbill.operators.clean import drop_sentinels
from playbill.operators.derive import bucket, decade_of, explode_list, parse_date, year_of
from playbill.plans import reports
from playbill.plans.registry import over_views, register, rounded
from playbill.plans.table_queries import BUCKET_SQL, COUNTRY_SQL, TREND_SQL, TYPES
from playbill.plans.views import Tables
from playbill.session import scratch_path

SIX_COUNTRIES = ["NATION_1", "NATION_2", "NATION_3", "NATION_10", "NATION_12", "NATION_20"]
SCORE_AXIS = ["<5", "5-6", "6-7", "7-8", "8-9", "9-10"]


def by_country(t: Tables) -> DataFrame:
    return explode_list(t.catalog, "countries", "country")


COUNTRY_ROWS = f"b AS (SELECT id, type, score, {COUNTRY_SQL[7:]})"

# -- joins ---------------------------------------------------------------------

CAST_SQL = """SELECT id, count(*) AS actor_count, string_agg(name, ',' ORDER BY name) AS "cast"
FROM credits WHERE role = 'ACTOR' GROUP BY 1"""

register(
    "j01_left_enrich",
    lambda t: people.cast_text(people.attach_people(t.catalog.select("id", "title"), t.credits)),
    over_views(
        f"WITH p AS ({CAST_SQL}) SELECT id, title, coalesce(actor_count, 0) AS actor_count, "
        'CAST(0 AS BIGINT) AS part, coalesce("cast", \'No Data\') AS "cast" FROM catalog LEFT JOIN p USING (id)'
    ),
)
register(
    "j01_attach_defaults",
    lambda t: joins.attach(
        t.catalog.select("id", "title"), people.people_per_title(t.credits, "DIRECTOR", "directors"), "id", {"directors": 0}
    ),
    over_views(
        "WITH d AS (SELECT id, count(*) AS n FROM credits WHERE role = 'DIRECTOR' GROUP BY 1) "
        "SELECT id, title, coalesce(n, 0) AS directors FROM catalog LEFT JOIN d USING (id)"
    ),
)
register(
    "j02_topkey_filter",
    lambda t: joins.keep_top_keys(by_country(t), "country", 5).select("id", "country"),
    over_views(
        f"WITH {COUNTRY_ROWS}, k AS (SELECT country FROM b GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5) "
        "SELECT id, country FROM b SEMI JOIN k USING (country)"
    ),
)
DOMAIN_SQL = (
    "WITH d AS (SELECT CAST(unnest(range(7)) AS INT) AS \"position\", "
    "unnest(['<5', '5-6', '6-7', '7-8', '8-9', '9-10', 'unrated']) AS bucket), "
    f"g AS (SELECT {BUCKET_SQL} AS bucket, count(*) AS n FROM catalog GROUP BY 1) "
    'SELECT "position", bucket, {count} AS "count" FROM d LEFT JOIN g USING (bucket)'
)


def _score_buckets(t: Tables) -> DataFrame:
    return aggregates.count_by(bucket(t.catalog, "score"), "bucket")


register(
    "j03_domain_reindex",
    lambda t: joins.reindex(_score_buckets(t), "bucket", [*SCORE_AXIS, "unrated"]),
    over_views(DOMAIN_SQL.format(count="n")),
)
register(
    "j03_domain_reindex_filled",
    lambda t: joins.reindex(_score_buckets(t), "bucket", [*SCORE_AXIS, "unrated"], {"count": 0}),
    over_views(DOMAIN_SQL.format(count="coalesce(n, 0)")),
)
register(
    "j04_scalar_attach",
    lambda t: joins.with_total(aggregates.count_by(by_country(t), "country"), "count"),
    over_views(
        f'WITH g AS (SELECT country, count(*) AS "count" FROM ({COUNTRY_SQL}) GROUP BY 1) '
        'SELECT country, "count", (SELECT CAST(sum("count") AS BIGINT) FROM g) AS total FROM g'
    ),
)

# -- aggregates ----------------------------------------------------------------

register(
    "a01_type_count",
    lambda t: aggregates.count_by(t.catalog, "type"),
    over_views('SELECT type, count(*) AS "count" FROM catalog GROUP BY 1'),
)
register(
    "a02_year_trend",
    lambda t: rounded(aggregates.trend(t.catalog, "release_year", TYPES), "percent"),
    over_views(TREND_SQL.format(year="release_year", out="release_year")),
)
register(
    "a02_year_added_trend",
    lambda t: rounded(
        aggregates.trend(year_of(parse_date(t.catalog, "date_added"), "date_added", "year_added"), "year_added", TYPES),
        "percent",
    ),
    over_views(
        TREND_SQL.format(year="CAST(year(try_strptime(date_added, '%B %d, %Y')) AS INT)", out="year_added")
    ),
)
register(
    "a03_country_total",
    lambda t: aggregates.country_total(t.catalog),
    over_views(f'SELECT country, count(*) AS "count" FROM ({COUNTRY_SQL}) GROUP BY 1'),
)
register(
    "a03_country_total_raw",
    lambda t: aggregates.country_total(t.catalog, exploded=False),
    over_views('SELECT countries AS country, count(*) AS "count" FROM catalog GROUP BY 1'),
)
register(
    "a04_multi_key_count",
    lambda t: aggregates.count_by(by_country(t), ["country", "type"]),
    over_views(f'WITH {COUNTRY_ROWS} SELECT country, type, count(*) AS "count" FROM b GROUP BY 1, 2'),
)
register(
    "a05_country_score",
    lambda t: rounded(
        aggregates.avg_by(by_country(t), "country", "score", 20).orderBy(F.desc("avg_score"), "country"), "avg_score"
    ),
    over_views(
        f'WITH {COUNTRY_ROWS} SELECT country, round(avg(score), 6) AS avg_score, count(*) AS "count" '
        "FROM b GROUP BY 1 HAVING count(*) > 20"
    ),
)
register(
    "a06_decade_score",
    lambda t: rounded(
        aggregates.avg_by(decade_of(t.catalog, "release_year"), "decade", "score", 10, True).orderBy("decade"), "avg_score"
    ),
    over_views(
        'SELECT CAST(floor(release_year / 10) * 10 AS INT) AS "decade", round(avg(score), 6) AS avg_score, '
        'count(*) AS "count" FROM catalog WHERE score IS NOT NULL GROUP BY 1 HAVING count(*) > 10'
    ),
)
register(
    "a07_genre_score",
    lambda t: rounded(
        aggregates.avg_by(
            drop_sentinels(explode_list(t.catalog, "genres", "genre"), "genre"), "genre", "score", 20, True
        ).orderBy(F.desc("avg_score"), "genre"),
        "avg_score",
    ),
    over_views(
        "WITH b AS (SELECT score, trim(unnest(string_split(genres, ','))) AS genre FROM catalog) "
        'SELECT genre, round(avg(score), 6) AS avg_score, count(*) AS "count" FROM b '
        "WHERE genre NOT IN ('', 'No Data') AND score IS NOT NULL GROUP BY 1 HAVING count(*) > 20"
    ),
)
register(
    "a08_type_stats",
    lambda t: rounded(aggregates.stats_by(t["events"], "event_type", "value"), "avg_score", "std_score"),
    "SELECT event_type, round(avg(value), 6) AS avg_score, round(stddev_samp(value), 6) AS std_score, "
    'min(value) AS min_score, max(value) AS max_score, count(*) AS "count" FROM events GROUP BY 1',
)
register(
    "a09_score_split",
    lambda t: rounded(aggregates.bucket_split(t.catalog, TYPES, "score"), "percent").orderBy("type", "bucket"),
    over_views(TREND_SQL.format(year=BUCKET_SQL, out="bucket")),
)
register(
    "a10_rating_split",
    lambda t: rounded(aggregates.category_split(t.catalog, TYPES, "rating"), "percent"),
    over_views(TREND_SQL.format(year="rating", out="rating")),
)
register(
    "a11_cast_size",
    lambda t: people.people_per_title(t.credits),
    over_views("SELECT id, count(*) AS actor_count FROM credits WHERE role = 'ACTOR' GROUP BY 1"),
)
register(
    "a12_cast_list",
    lambda t: people.cast_text(people.cast_list(t.credits)),
    over_views(f'SELECT id, CAST(0 AS BIGINT) AS part, "cast" FROM ({CAST_SQL})'),
)
register(
    "a13_group_means",
    lambda t: rounded(
        aggregates.means_by(t.catalog, "type", ["score", "release_year"]), "avg_score", "avg_release_year"
    ),
    over_views(
        "SELECT type, round(avg(score), 6) AS avg_score, round(avg(release_year), 6) AS avg_release_year "
        "FROM catalog GROUP BY 1"
    ),
)
register(
    "a14_value_counts",
    lambda t: profile.value_counts(t["events"], "event_type"),
    'SELECT event_type, count(*) AS "count" FROM events GROUP BY 1',
)
DISTINCT_COLS = ["type", "date_added", "rating", "duration", "score", "countries", "genres"]
register(
    "a15_distinct_count",
    lambda t: profile.distinct_count(t.catalog, DISTINCT_COLS),
    over_views(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) "
            "AS BIGINT) AS n_distinct FROM catalog"
            for c in DISTINCT_COLS
        )
    ),
)
register(
    "a16_distinct_values",
    lambda t: profile.distinct_values(t["part"], "p_brand"),
    "SELECT DISTINCT p_brand FROM part",
)
register(
    "a17_pivot",
    lambda t: aggregates.pivot_sum(aggregates.count_by(by_country(t), ["country", "type"]), "country", "type", TYPES, "count"),
    over_views(
        f"WITH {COUNTRY_ROWS} SELECT country, count(*) FILTER (type = 'MOVIE') AS \"MOVIE\", "
        "count(*) FILTER (type = 'SHOW') AS \"SHOW\" FROM b GROUP BY 1 HAVING count(*) FILTER (type <> 'OTHER') > 0"
    ),
)
register(
    "a18_type_ratio",
    lambda t: rounded(aggregates.type_ratio(by_country(t), "country", TYPES), *TYPES),
    over_views(
        f"""WITH {COUNTRY_ROWS}, k AS (SELECT country FROM b GROUP BY 1 ORDER BY count(*) DESC, country LIMIT 10),
        g AS (SELECT country, count(*) AS tot, count(*) FILTER (type = 'MOVIE') AS mv,
        count(*) FILTER (type = 'SHOW') AS sh FROM b SEMI JOIN k USING (country) GROUP BY 1)
        SELECT country, round(mv / CAST(tot AS DOUBLE), 6) AS "MOVIE", round(sh / CAST(tot AS DOUBLE), 6) AS "SHOW"
        FROM g WHERE mv + sh > 0"""
    ),
)
register(
    "a19_movie_length",
    lambda t: aggregates.lengths(t.catalog),
    over_views(
        "SELECT TRY_CAST(regexp_extract(duration, '[0-9]+') AS DOUBLE) AS duration FROM catalog WHERE type = 'MOVIE'"
    ),
)
register(
    "a20_histogram",
    lambda t: rounded(distribution.histogram(t["events"], "value"), "bin_start", "bin_end", "density"),
    """WITH h AS (SELECT min(value) AS lo, (max(value) - min(value)) / 40 AS w, count(*) AS total FROM events),
    r AS (SELECT value, lo, w, CAST(least(floor((value - lo) / w), 39) AS INT) AS g FROM events, h),
    s AS (SELECT CASE WHEN value < lo + g * w THEN g - 1
    WHEN g < 39 AND value >= lo + (g + 1) * w THEN g + 1 ELSE g END AS bin, count(*) AS n FROM r GROUP BY 1),
    d AS (SELECT CAST(unnest(range(40)) AS INT) AS bin)
    SELECT bin, round(lo + bin * w, 6) AS bin_start, round(lo + (bin + 1) * w, 6) AS bin_end,
    coalesce(n, 0) AS "count", round(coalesce(n, 0) / (total * w), 6) AS density
    FROM d LEFT JOIN s USING (bin), h""",
)
register(
    "a21_moments",
    lambda t: rounded(distribution.moments(t["events"], "value"), "mean", "std"),
    "SELECT round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std FROM events",
)
register(
    "a22_normal_curve",
    lambda t: rounded(distribution.normal_curve(t["events"], "value"), "x", "density"),
    """WITH m AS (SELECT avg(value) AS mu, stddev_samp(value) AS sd, min(value) AS lo, max(value) AS hi FROM events),
    p AS (SELECT CAST(unnest(range(200)) AS INT) AS point),
    c AS (SELECT point, lo + point * (hi - lo) / 199 AS x, mu, sd FROM p, m)
    SELECT point, round(x, 6) AS x,
    round(exp(-(x - mu) * (x - mu) / (2 * sd * sd)) / (sd * sqrt(2 * pi())), 6) AS density FROM c""",
)

# -- windows, orders, top-k ----------------------------------------------------

register(
    "w01_partition_total",
    lambda t: joins.with_group_total(aggregates.count_by(by_country(t), ["country", "type"]), "country", "count").select(
        "country", "type", "total", F.round(F.col("count") / F.col("total"), 6).alias("ratio")
    ),
    over_views(
        f"WITH {COUNTRY_ROWS}, g AS (SELECT country, type, count(*) AS n FROM b GROUP BY 1, 2) "
        "SELECT country, type, CAST(sum(n) OVER (PARTITION BY country) AS BIGINT) AS total, "
        "round(n / CAST(sum(n) OVER (PARTITION BY country) AS DOUBLE), 6) AS ratio FROM g"
    ),
)
register(
    "w02_rank_in_group",
    lambda t: ranking.top_k_by(t["part"], "p_brand", "p_retailprice", 3, ["p_partkey"]).select(
        "p_brand", "p_partkey", "p_retailprice", "rank"
    ),
    "SELECT p_brand, p_partkey, p_retailprice, CAST(row_number() OVER (PARTITION BY p_brand "
    'ORDER BY p_retailprice DESC, p_partkey) AS INT) AS "rank" FROM part QUALIFY "rank" <= 3',
)
register(
    "t01_order",
    lambda t: ranking.order_by(t["orders"], [("o_totalprice", "desc"), ("o_orderkey", "asc")]).select(
        "o_orderkey", "o_totalprice"
    ),
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY 2 DESC, 1",
)
CATEGORY_SQL = (
    "SELECT trim(unnest(string_split(genres, ','))) AS category FROM catalog WHERE genres NOT IN ('', 'No Data')"
)
register(
    "t02_top_categories",
    lambda t: ranking.top_members(t.catalog, "genres", 5),
    over_views(f'SELECT category, count(*) AS "count" FROM ({CATEGORY_SQL}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5'),
)


def _people_sql(match: str) -> str:
    names = ", ".join(f"'{c}'" for c in SIX_COUNTRIES)
    return over_views(
        f"WITH w AS (SELECT unnest([{names}]) AS country), c AS (SELECT id, country FROM catalog JOIN w ON {match} "
        "WHERE duration <> ''), "
        'g AS (SELECT country, name, count(*) AS "count" FROM c JOIN credits USING (id) '
        "WHERE role = 'ACTOR' AND name NOT IN ('', 'No Data') GROUP BY 1, 2) "
        'SELECT country, name, "count", CAST(row_number() OVER (PARTITION BY country ORDER BY "count" DESC, name) '
        'AS INT) AS "rank" FROM g QUALIFY "rank" <= 25'
    )


register(
    "t03_top_people",
    lambda t: ranking.top_people(t.catalog, SIX_COUNTRIES, credits=t.credits),
    _people_sql("list_contains(string_split(countries, ', '), country)"),
)
register(
    "t03_top_people_contains",
    lambda t: ranking.top_people(t.catalog, SIX_COUNTRIES, credits=t.credits, match="contains"),
    _people_sql("contains(lower(countries), lower(country))"),
)
register(
    "t03_top_people_listed",
    lambda t: ranking.top_people(people.cast_text(people.attach_people(t.catalog, t.credits)), SIX_COUNTRIES),
    _people_sql("list_contains(string_split(countries, ', '), country)"),
)
register(
    "t04_n_largest",
    lambda t: ranking.n_largest(t["part"].select("p_partkey", "p_retailprice"), "p_retailprice", 20, ["p_partkey"]),
    "SELECT p_partkey, p_retailprice FROM part ORDER BY 2 DESC, 1 LIMIT 20",
)
MEANS_SQL = "SELECT rating, round(avg(score), 6) AS avg_score FROM catalog GROUP BY 1"


def _rating_means(t: Tables) -> DataFrame:
    return rounded(aggregates.means_by(t.catalog, "rating", ["score"]), "avg_score")


register(
    "t05_arg_best",
    lambda t: ranking.mark_best(_rating_means(t), "avg_score"),
    over_views(f"WITH g AS ({MEANS_SQL}) SELECT *, avg_score = (SELECT max(avg_score) FROM g) AS is_best FROM g"),
)
register(
    "t05_arg_best_name",
    lambda t: ranking.arg_best(_rating_means(t).filter("rating IS NOT NULL"), "rating", "avg_score"),
    over_views(f"SELECT * FROM ({MEANS_SQL}) WHERE rating IS NOT NULL ORDER BY avg_score DESC, rating LIMIT 1"),
)
register(
    "u01_collect_results",
    lambda t: ranking.stack(
        [
            rounded(aggregates.trend(t.catalog, "release_year", [name]), "percent").withColumn("part", F.lit(name))
            for name in TYPES
        ]
    ),
    over_views(f"SELECT *, type AS part FROM ({TREND_SQL.format(year='release_year', out='release_year').strip()})"),
)

# -- reports -------------------------------------------------------------------


def _raw_table(t: Tables) -> DataFrame:
    return t.catalog.select(
        "id",
        "type",
        F.when(F.col("id") % 5 != 0, F.col("countries")).alias("country"),
        F.when(F.col("id") % 3 != 0, F.col("genres")).alias("cast"),
        F.col("rating").alias("director"),
        "date_added",
        "release_year",
    )


def _one_table(t: Tables) -> DataFrame:
    out = reports.clean_single_table(_raw_table(t))
    return out.withColumn("date_added", F.date_format("date_added", "yyyy-MM-dd"))


RAW_TABLE_SQL = """SELECT id, type, CASE WHEN id % 5 <> 0 THEN countries END AS country,
CASE WHEN id % 3 <> 0 THEN genres END AS "cast", rating AS director, date_added, release_year FROM catalog"""
register(
    "r01_clean_single_table",
    _one_table,
    over_views(
        f"""WITH raw AS ({RAW_TABLE_SQL}),
        m AS (SELECT country AS common FROM raw WHERE country IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT DISTINCT id, type, coalesce(country, common) AS country, coalesce("cast", 'No Data') AS "cast",
        coalesce(director, 'No Data') AS director, strftime(strptime(date_added, '%B %d, %Y'), '%Y-%m-%d') AS date_added,
        release_year, CAST(year(strptime(date_added, '%B %d, %Y')) AS INT) AS year_added
        FROM raw, m WHERE date_added IS NOT NULL"""
    ),
)


def _raw_titles(t: Tables) -> DataFrame:
    quoted = F.concat(F.lit("['"), F.replace("genres", F.lit(", "), F.lit("', '")), F.lit("']"))
    return t.catalog.select(
        "id",
        F.when(F.col("id") % 23 != 0, F.col("title")).alias("title"),
        "type",
        "release_year",
        "rating",
        "score",
        F.when(F.col("genres") != "No Data", quoted).alias("genres"),
        "countries",
    )


def _two_tables(t: Tables) -> DataFrame:
    done = reports.clean_two_tables(
        _raw_titles(t),
        t.credits,
        mode_cols=["rating"],
        median_cols=["score"],
        text_cols=["genres"],
        list_cols=["genres", "countries"],
    )
    return people.cast_text(done.titles)


register(
    "r02_clean_two_tables",
    _two_tables,
    over_views(
        """WITH m AS (SELECT rating AS common FROM catalog WHERE rating IS NOT NULL
        GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), q AS (SELECT median(score) AS middle FROM catalog),
        d AS (SELECT DISTINCT id, coalesce(name, 'No Data') AS name, coalesce("character", 'No Data') AS "character",
        role FROM credits),
        p AS (SELECT id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
        FROM d WHERE role = 'ACTOR' GROUP BY 1)
        SELECT id, title, type, release_year, coalesce(rating, common) AS rating, coalesce(score, middle) AS score,
        genres, countries, split_part(genres, ',', 1) AS main_genre,
        CAST(floor(release_year / 10) * 10 AS INT) AS "decade", coalesce(n, 0) AS actor_count,
        CAST(0 AS BIGINT) AS part, coalesce(names, 'No Data') AS "cast"
        FROM catalog LEFT JOIN p USING (id), m, q WHERE id % 23 <> 0"""
    ),
)


def _cells(df: DataFrame, section: str, key, count="count", number=None, kind=None) -> DataFrame:
    """(section, type, key, count, value) of a report table."""
    none = F.lit(None)
    return df.select(
        F.lit(section).alias("section"), (none if kind is None else F.col(kind)).cast("string").alias("type"), key.cast("string").alias("key"),
        (none if count is None else F.col(count)).cast("long").alias("count"), F.round((none if number is None else F.col(number)).cast("double"), 6).alias("value"),
    )


def _catalogue_rows(tables: dict[str, DataFrame]) -> list[DataFrame]:
    split = {"released": "release_year", "added": "year_added", "score_split": "bucket", "rating_split": "rating"}
    ratio = tables["type_ratio"].unpivot("country", TYPES, "type", "ratio")
    length = tables["movie_length"].groupBy("duration").agg(F.count(F.lit(1)).alias("count"))
    return [
        _cells(tables["type_count"], "type_count", F.lit(None), kind="type"),
        *[_cells(tables[n], n, F.col(key), number="percent", kind="type") for n, key in split.items() if n in tables],
        _cells(tables["country_total"], "country_total", F.col("country")),
        _cells(tables["categories"], "categories", F.col("category")),
        _cells(ratio, "type_ratio", F.col("country"), None, "ratio", "type"),
        _cells(length, "movie_length", F.col("duration").cast("int")),
        _cells(tables["people"], "people", F.concat_ws(" ", "country", "rank", "name")),
    ]


def _catalogue_report(t: Tables) -> DataFrame:
    dated = year_of(parse_date(t.catalog, "date_added"), "date_added", "year_added")
    return ranking.stack(_catalogue_rows(reports.catalogue_report(dated, SIX_COUNTRIES, t.credits)))


def _section(name: str, key: str, source: str = "catalog", tail: str = "") -> str:
    return (
        f"SELECT '{name}' AS section, NULL AS type, CAST({key} AS VARCHAR) AS \"key\", count(*) AS \"count\", NULL::DOUBLE AS value "
        f"FROM {source} GROUP BY 3 HAVING \"key\" IS NOT NULL {tail}"
    )


def _split_section(name: str, key: str, source: str = "catalog") -> str:
    return (
        f"SELECT '{name}', type, CAST(k AS VARCHAR), n, round(100.0 * n / total, 6) FROM (SELECT type, {key} AS k, count(*) AS n, "
        f"sum(count(*)) OVER (PARTITION BY type) AS total FROM {source} WHERE {IN_TYPES} GROUP BY 1, 2) WHERE k IS NOT NULL"
    )


IN_TYPES = "type IN ('MOVIE', 'SHOW')"
CATALOGUE_SECTIONS = [
    "SELECT 'type_count' AS section, type, NULL AS \"key\", count(*) AS \"count\", NULL::DOUBLE AS value FROM catalog GROUP BY 2",
    _split_section("released", "release_year"),
    _split_section("score_split", BUCKET_SQL),
    _split_section("rating_split", "rating"),
    _section("country_total", "country", f"({COUNTRY_SQL})"),
    f"(SELECT * FROM ({_section('categories', 'category', f'({CATEGORY_SQL})')}) ORDER BY \"count\" DESC, \"key\" LIMIT 50)",
    f"""SELECT 'type_ratio', x.type, country, NULL, round((CASE x.type WHEN 'MOVIE' THEN m ELSE s END) / n, 6) FROM (
        SELECT country, count(*) AS n, count(*) FILTER (type = 'MOVIE') AS m, count(*) FILTER (type = 'SHOW') AS s
        FROM (SELECT type, {COUNTRY_SQL[7:]}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10) c, (VALUES ('MOVIE'), ('SHOW')) AS x(type) WHERE m + s > 0""",
    """SELECT 'movie_length', NULL, regexp_extract(duration, '[0-9]+'), count(*), NULL FROM catalog
        WHERE type = 'MOVIE' AND regexp_extract(duration, '[0-9]+') <> '' GROUP BY 3""",
    f"""SELECT 'people', NULL, country || ' ' || r || ' ' || name, n, NULL FROM (
        SELECT country, name, count(*) AS n, row_number() OVER (PARTITION BY country ORDER BY count(*) DESC, name) AS r
        FROM (SELECT id, country FROM catalog JOIN (SELECT unnest([{', '.join(f"'{c}'" for c in SIX_COUNTRIES)}]) AS country)
        ON list_contains(string_split(countries, ', '), country) WHERE duration <> '') JOIN credits USING (id)
        WHERE role = 'ACTOR' AND name NOT IN ('', 'No Data') GROUP BY 1, 2) WHERE r <= 25""",
]
register(
    "r03_catalogue_report",
    _catalogue_report,
    over_views(" UNION ALL ".join([*CATALOGUE_SECTIONS, _split_section("added", "year(try_strptime(date_added, '%B %d, %Y'))")])),
)


def _swept_report(t: Tables) -> DataFrame:
    swept = ["rating", "countries", "genres", "duration", "release_year", "title"]
    tables = reports.catalogue_report(t.catalog, SIX_COUNTRIES, t.credits, reports.Columns(year_added=None), features=swept)
    return _cells(tables["feature_accuracy"], "feature_accuracy", F.col("feature"), "n_distinct", "accuracy")


register("r03_catalogue_report_swept", _swept_report)


def _score_report(t: Tables) -> DataFrame:
    tables = reports.score_report(decade_of(t.catalog, "release_year"))
    parts = [
        tables[name].select(
            F.lit(name).alias("section"), F.col(name).cast("string").alias("key"), F.round("avg_score", 6).alias("avg_score"), "count"
        )
        for name in ("country", "decade", "genre", "type")
    ]
    return ranking.stack(parts)


def _scores(name: str, key: str, source: str, where: str, more_than: int) -> str:
    return (
        f"SELECT '{name}' AS section, CAST({key} AS VARCHAR) AS \"key\", round(avg(score), 6) AS avg_score, "
        f"count(*) AS \"count\" FROM {source} WHERE {where} GROUP BY 2 HAVING count(*) > {more_than}"
    )


register(
    "r04_score_report",
    _score_report,
    over_views(
        f"WITH {COUNTRY_ROWS}, e AS (SELECT score, trim(unnest(string_split(genres, ','))) AS genre FROM catalog) "
        + " UNION ALL ".join(
            [
                _scores("country", "country", "b", "true", 20),
                _scores("decade", "CAST(floor(release_year / 10) * 10 AS INT)", "catalog", "score IS NOT NULL", 10),
                _scores("genre", "genre", "e", "genre NOT IN ('', 'No Data') AND score IS NOT NULL", 20),
                _scores("type", "type", "catalog", "score IS NOT NULL", 0),
            ]
        )
    ),
)


def _chart_tables(t: Tables) -> DataFrame:
    tables = reports.chart_tables(
        reports.catalogue_report(t.catalog, SIX_COUNTRIES, t.credits, reports.Columns(year_added=None)),
        SCORE_AXIS,
        years=(1996, 2000),
    )
    keys = {"country_total": "country", "length_bars": "bin", "categories": "category"}
    ratio = tables["type_ratio"].unpivot("country", TYPES, "type", "ratio")
    parts = [
        _cells(tables["type_share"], "type_share", F.lit(None), number="share", kind="type"),
        _cells(tables["released"], "released", F.col("release_year"), number="percent", kind="type"),
        _cells(ratio, "type_ratio", F.col("country"), None, "ratio", "type"),
        _cells(tables["people"], "people", F.concat_ws(" ", "country", "rank", "name")),
        *[_cells(tables[name], name, F.col(key)) for name, key in keys.items()],
        *[
            _cells(tables[f"scores_{kind}"].withColumn("kind", F.lit(kind)), "scores", F.concat_ws(" ", "position", "bucket"), number="percent", kind="kind")
            for kind in TYPES
        ],
    ]
    scores = reports.score_charts(reports.score_report(decade_of(t.catalog, "release_year")))
    parts += [_cells(scores[f"{n}_score"], f"{n}_score", F.col(n), number="avg_score") for n in ("genre", "country", "decade")]
    parts += [_cells(scores["type_score"], f"type_score_{end}", F.lit(None), number=end, kind="type") for end in ("low", "high")]
    lines = [scores[f"{n}_score"].select(F.lit(n).alias("n"), "line") for n in ("genre", "country", "decade", "type")]
    parts.append(_cells(ranking.stack(lines).groupBy("n").agg(F.max("line").alias("line")), "line", F.col("n"), None, "line"))
    return ranking.stack(parts)


def _chart(name: str, key: str, source: str, tail: str = "") -> str:
    return (
        f"(SELECT '{name}' AS section, NULL AS type, CAST({key} AS VARCHAR) AS \"key\", count(*) AS \"count\", NULL::DOUBLE AS value "
        f"FROM {source} GROUP BY 3 {tail})"
    )


def _score_axis_sql() -> str:
    axis = ", ".join(f"({i}, '{label}')" for i, label in enumerate(SCORE_AXIS))
    return f"""SELECT 'scores', x.type, i || ' ' || label, s.n, round(100.0 * s.n / s.total, 6) FROM (VALUES {axis}) AS a(i, label)
        CROSS JOIN (VALUES ('MOVIE'), ('SHOW')) AS x(type) LEFT JOIN (SELECT type, {BUCKET_SQL} AS b, count(*) AS n,
        sum(count(*)) OVER (PARTITION BY type) AS total FROM catalog WHERE {IN_TYPES} GROUP BY 1, 2) s ON s.type = x.type AND s.b = label"""


def _best(name: str, key: str, source: str, where: str, more_than: int, tail: str = "") -> str:
    return (
        f"(SELECT '{name}_score', NULL, CAST({key} AS VARCHAR) AS k, count(*), round(avg(score), 6) "
        f"FROM {source} WHERE {where} GROUP BY 3 HAVING count(*) > {more_than} {tail})"
    )


TOP_SCORES = "ORDER BY avg(score) DESC, k LIMIT 15"


register(
    "r05_chart_tables",
    _chart_tables,
    over_views(
        f"""WITH {COUNTRY_ROWS}, e AS (SELECT score, trim(unnest(string_split(genres, ','))) AS genre FROM catalog),
        l AS (SELECT CAST(regexp_extract(duration, '[0-9]+') AS DOUBLE) AS v FROM catalog WHERE type = 'MOVIE'),
        h AS (SELECT min(v) AS lo, (max(v) - min(v)) / 40 AS w FROM l),
        r AS (SELECT v, lo, w, CAST(least(floor((v - lo) / w), 39) AS INT) AS g FROM l, h),
        s AS (SELECT CASE WHEN v < lo + g * w THEN g - 1 WHEN g < 39 AND v >= lo + (g + 1) * w THEN g + 1
        ELSE g END AS bin FROM r),
        ends AS (SELECT type, avg(score) AS m, stddev_samp(score) AS d, count(score) AS n FROM catalog WHERE score IS NOT NULL GROUP BY 1) """
        + " UNION ALL ".join(
            [
                _chart("length_bars", "bin", "s"),
                "SELECT 'type_share', type, NULL, count(*), round(count(*) / (SELECT count(*) FROM catalog), 6) FROM catalog GROUP BY 2",
                CATALOGUE_SECTIONS[1].replace("WHERE k IS NOT NULL", "WHERE k BETWEEN 1996 AND 2000"),
                CATALOGUE_SECTIONS[6],
                CATALOGUE_SECTIONS[8].replace("r <= 25", "r <= 10"),
                _chart("country_total", "country", f"({COUNTRY_SQL})", "ORDER BY 4 DESC, 3 LIMIT 15"),
                _chart("categories", "category", f"({CATEGORY_SQL})", "ORDER BY 4 DESC, 3 LIMIT 15"),
                _score_axis_sql(),
                _best("country", "country", "b", "country <> ''", 20, TOP_SCORES),
                _best("genre", "genre", "e", "genre NOT IN ('', 'No Data') AND score IS NOT NULL", 20, TOP_SCORES),
                _best("decade", "CAST(floor(release_year / 10) * 10 AS INT)", "catalog", "score IS NOT NULL", 10),
                "SELECT 'type_score_low', type, NULL, n, round(m - d, 6) FROM ends",
                "SELECT 'type_score_high', type, NULL, n, round(m + d, 6) FROM ends",
                "SELECT 'line', NULL, unnest(['genre', 'country', 'decade', 'type']), NULL, 6.0",
            ]
        )
    ),
)

# -- gaps before and after cleaning ----------------------------------------------


def _profile_rows(t: Tables, raw: DataFrame, clean) -> DataFrame:
    return reports.cleaned_with_profile(raw, clean, scratch_path(t.spark, "cleaned"))[1]


def _gaps_sql(stage: str, source: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, '{c}' AS \"column\", count(*) AS \"rows\", count(*) - count(\"{c}\") AS null_count, "
        f"round(100.0 * (count(*) - count(\"{c}\")) / nullif(count(*), 0), 2) AS null_rate FROM {source}"
        for c in cols
    )


ONE_TABLE = ["id", "type", "country", "cast", "director", "date_added", "release_year"]
register(
    "r01_profile",
    lambda t: _profile_rows(t, _raw_table(t), reports.clean_single_table),
    over_views(
        f"""WITH raw AS ({RAW_TABLE_SQL}), done AS (SELECT *, 0 AS year_added FROM (SELECT DISTINCT id, type, coalesce(country, '') AS country,
        coalesce("cast", '') AS "cast", coalesce(director, '') AS director, date_added, release_year FROM raw WHERE date_added IS NOT NULL))
        {_gaps_sql("before", "raw", ONE_TABLE)} UNION ALL {_gaps_sql("after", "done", [*ONE_TABLE, "year_added"])}"""
    ),
)
TWO_TABLES = ["id", "title", "type", "release_year", "rating", "score", "genres", "countries"]
register(
    "r02_profile",
    lambda t: _profile_rows(
        t,
        _raw_titles(t),
        lambda raw: reports.clean_titles(raw, ["rating"], ["score"], ["genres"], ["genres", "countries"]),
    ),
    over_views(
        f"""WITH raw AS (SELECT id, CASE WHEN id % 23 <> 0 THEN title END AS title, type, release_year, rating, score,
        CASE WHEN genres <> 'No Data' THEN genres END AS genres, countries FROM catalog),
        done AS (SELECT id, title, type, release_year, 0 AS rating, 0 AS score, 0 AS genres, countries, 0 AS main_genre, 0 AS "decade"
        FROM raw WHERE title IS NOT NULL)
        {_gaps_sql("before", "raw", TWO_TABLES)} UNION ALL {_gaps_sql("after", "done", [*TWO_TABLES, "main_genre", "decade"])}"""
    ),
)
