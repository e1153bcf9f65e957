"""Report compositions: chains of operators behind one call each."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playbill.functions import bucket_label, is_missing, split_trimmed
from playbill.functions.text import NO_DATA
from playbill.models.clusters import cluster, cluster_profile, k_sweep
from playbill.models.supervised import (
    coefficients,
    feature_accuracy,
    importances,
    score_table,
    train_classifiers,
    train_regressors,
)
from playbill.operators.aggregates import (
    avg_by,
    category_shares,
    facet_counts,
    lengths,
    ratio_of_counts,
    stats_by,
)
from playbill.operators.clean import (
    cast_columns,
    dedup,
    dedup_by,
    drop_nulls,
    drop_sentinels,
    fill_constant,
    fill_median,
    fill_mode,
)
from playbill.operators.derive import (
    decade_of,
    explode_list,
    first_member,
    parse_date,
    percent_label,
    rescale,
    strip_list_text,
    year_of,
)
from playbill.operators.distribution import histogram, normal_curve
from playbill.operators.filters import between, by_type, in_set, positive
from playbill.operators.joins import reindex
from playbill.operators.people import PART_ROWS, attach_people
from playbill.operators.ranking import mark_best, n_largest, top_people
from playbill.session import scratch_path
from playbill.sources import write_table


@dataclass(frozen=True)
class Columns:
    """Where a provider keeps what, and how it spells its types."""

    movie: str = "MOVIE"
    show: str = "SHOW"
    type: str = "type"
    country: str = "countries"
    genre: str = "genres"
    score: str = "score"
    length: str = "duration"
    rating: str | None = "rating"
    release_year: str = "release_year"
    year_added: str | None = "year_added"

    @property
    def types(self) -> list[str]:
        return [self.movie, self.show]


def clean_single_table(
    df: DataFrame,
    mode_cols: Sequence[str] = ("country",),
    constants: Mapping[str, str] | None = None,
    date_col: str = "date_added",
) -> DataFrame:
    """Clean a catalog that is one table.

    Fills the country by its mode and people by a constant, drops rows that still
    have a gap, drops repeats, then parses the date and takes its year.
    """
    constants = constants or {"cast": NO_DATA, "director": NO_DATA}
    filled = fill_constant(fill_mode(df, mode_cols), constants)
    whole = dedup(drop_nulls(filled))
    return year_of(parse_date(whole, date_col), date_col, "year_added")


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The table with its cells counted while it is written or read for something else."""
    seen = Observation(name)
    gaps = [F.count_if(is_missing(df, c)).alias(f"g{i}") for i, c in enumerate(df.columns)]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *gaps), seen


def profile_of(spark: SparkSession, seen: Observation, columns: Sequence[str], stage: str) -> DataFrame:
    """(stage, column, rows, null_count, null_rate) of an observed table; the rate in percent, two decimals."""
    found = seen.get
    n = found["rows"]
    rows = [(stage, c, n, found[f"g{i}"], round(100.0 * found[f"g{i}"] / n, 2) if n else None) for i, c in enumerate(columns)]
    return spark.createDataFrame(rows, "stage string, column string, rows long, null_count long, null_rate double")


def cleaned_with_profile(raw: DataFrame, clean: Callable[[DataFrame], DataFrame], path: str) -> tuple[DataFrame, DataFrame]:
    """Write the cleaned table to ``path``; the table and the gaps of every column before and after.

    Gaps after are counted by the write itself, and those before by the one pass
    that a cleaning with fills needs over its raw table anyway.
    """
    spark = raw.sparkSession
    before, seen_before = observed(raw, f"before {path}")
    before.write.format("noop").mode("overwrite").save()
    after, seen_after = observed(clean(raw), f"after {path}")
    write_table(after, path)
    done = spark.read.parquet(path)
    return done, profile_of(spark, seen_before, raw.columns, "before").union(profile_of(spark, seen_after, done.columns, "after"))


def clean_credits(credits: DataFrame, cols: Sequence[str] = ("name", "character")) -> DataFrame:
    """Fill people columns by a constant and drop repeats."""
    return dedup(fill_constant(credits, {c: NO_DATA for c in cols}))


def clean_titles(
    titles: DataFrame,
    mode_cols: Sequence[str] = ("age_certification",),
    median_cols: Sequence[str] = ("imdb_score", "tmdb_score", "tmdb_popularity", "imdb_votes"),
    text_cols: Sequence[str] = ("genres", "description"),
    list_cols: Sequence[str] = ("genres", "production_countries"),
    required: Sequence[str] = ("title", "type", "release_year"),
    order: Sequence[str] = (),
) -> DataFrame:
    """Clean the titles of a catalog that keeps people elsewhere.

    Mode, constant and median fills, required columns, one row per id (the first
    in ``order``), main genre, list text without marks, decade. Missing list text
    stays missing.
    """
    filled = fill_constant(fill_mode(titles, mode_cols), {c: NO_DATA for c in text_cols})
    filled = fill_median(filled, median_cols)
    single = dedup_by(drop_nulls(filled, required), ["id"], list(order))
    derived = first_member(single, "genres")
    for c in list_cols:
        derived = strip_list_text(derived, c)
    return decade_of(cast_columns(derived, {"release_year": "int"}), "release_year")


@dataclass(frozen=True)
class CleanCatalog:
    """Cleaned tables; titles have one row per part of their cast, mostly one."""

    titles: DataFrame
    credits: DataFrame


def clean_two_tables(
    titles: DataFrame, credits: DataFrame, part_rows: int = PART_ROWS, **options
) -> CleanCatalog:
    """Clean titles and credits, and attach the actor count and the cast to the titles."""
    people = clean_credits(credits)
    enriched = attach_people(clean_titles(titles, **options), people, part_rows=part_rows)
    return CleanCatalog(enriched, people)


def catalogue_report(
    titles: DataFrame,
    wanted: Sequence[str],
    credits: DataFrame | None = None,
    at: Columns = Columns(),
    features: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """All catalog questions over one cleaned table.

    Titles are read three times: once for the counts of all sections, which one
    pass writes to a small table (a row per section, type and key), once for the
    lengths and once for the people; the last two and all that follows are lazy. The
    single-column classification, built when ``features`` are named, fits models.
    """
    cells = F.col(at.genre)
    single = {"type_count": F.lit(""), "released": F.col(at.release_year), "score_split": bucket_label(F.col(at.score))}
    if at.rating:
        single["rating_split"] = F.col(at.rating)
    if at.year_added:
        single["added"] = F.col(at.year_added)
    lists = {"country": split_trimmed(F.col(at.country)), "category": F.when(~cells.isin("", NO_DATA), split_trimmed(cells))}
    path = scratch_path(titles.sparkSession, "facets")
    write_table(facet_counts(titles, single, lists, at.type), path)
    counts = titles.sparkSession.read.parquet(path)

    def facet(name: str, key: str, kind: str = "string") -> DataFrame:
        return counts.filter(F.col("facet") == name).select(at.type, F.col("key").cast(kind).alias(key), "count")

    def shares(name: str, key: str) -> DataFrame:
        own = facet(name, key, titles.schema[key].dataType.simpleString() if key in titles.columns else "string")
        return category_shares(by_type(own, at.type, at.types), at.types, key, at.type)

    countries = facet("country", "country").filter("country <> ''")
    categories = facet("category", "category").groupBy("category").agg(F.sum("count").alias("count"))
    report = {
        "type_count": facet("type_count", "key").select(at.type, "count"),
        "released": shares("released", at.release_year),
        "country_total": countries.groupBy("country").agg(F.sum("count").alias("count")),
        "type_ratio": ratio_of_counts(countries, "country", at.types, type_col=at.type),
        "movie_length": lengths(titles, at.movie, at.length, at.type),
        "score_split": shares("score_split", "bucket"),
        "categories": n_largest(categories, "count", 50, ["category"]).orderBy("count", F.desc("category")),
        "people": top_people(titles, wanted, credits=credits, countries=at.country, length=at.length),
    }
    if at.rating:
        report["rating_split"] = shares("rating_split", at.rating)
    if at.year_added:
        report["added"] = shares("added", at.year_added)
    if features:
        report["feature_accuracy"] = feature_accuracy(titles, features, at.type)
    return report


def score_report(titles: DataFrame, at: Columns = Columns()) -> dict[str, DataFrame]:
    """Average scores by country, decade and genre, and score statistics by type."""
    scored = titles.select(at.type, at.country, at.genre, at.score, "decade")
    countries = drop_sentinels(explode_list(scored, at.country, "country"), "country", [""])
    genres = drop_sentinels(explode_list(scored, at.genre, "genre"), "genre")
    return {
        "country": avg_by(countries, "country", at.score, 20),
        "decade": avg_by(scored, "decade", at.score, 10, drop_null_scores=True),
        "genre": avg_by(genres, "genre", at.score, 20, drop_null_scores=True),
        "type": stats_by(scored, at.type, at.score),
    }


def model_report(
    titles: DataFrame,
    cat: Sequence[str],
    num: Sequence[str],
    score: str,
    label: str = "type",
    ks: Sequence[int] = range(2, 20),
    k: int = 6,
    grid: Mapping[str, Sequence] | None = None,
) -> dict[str, DataFrame]:
    """Clusters, classifiers and regressors over one table with a score and features; each model is fitted once.

    ``num`` are the features besides the score; the score is a feature of the
    clusters and classifiers and the target of the regressors.
    """
    numbers = [score, *num]
    whole = fill_median(titles, numbers)
    clustered = cluster(whole, numbers, k, keep=("id", "title", label))
    fitted = train_classifiers(titles, cat, numbers, label, grid=grid, keep=["title"])
    scored = train_regressors(titles, cat, num, score)
    return {
        "k_sweep": k_sweep(whole, numbers, ks),
        "clusters": clustered,
        "cluster_profile": cluster_profile(clustered, numbers),
        "classifiers": fitted.table(),
        "grid": fitted.grid,
        "predictions": score_table(fitted.models["gbt"], fitted.test, ("id", "title", label)),
        "regressors": scored.table(),
        "coefficients": coefficients(scored.models["lr"], scored.train),
        "forest_importance": importances(scored.models["rf"], scored.train),
        "boosted_importance": importances(scored.models["gbt"], scored.train),
    }


def chart_tables(
    report: Mapping[str, DataFrame],
    scores: Sequence[str],
    top: int = 15,
    countries: Sequence[str] = (),
    years: tuple[int, int] = (1920, 2023),
    at: Columns = Columns(),
) -> dict[str, DataFrame]:
    """What the charts draw, from the tables of ``catalogue_report``.

    ``scores`` lists the score ranges in the order of the axis.
    """
    ratio = report["type_ratio"]
    if countries:
        ratio = in_set(ratio, "country", list(countries))
    for name in at.types:
        ratio = percent_label(ratio, name, out=f"{name}_label")
    length = positive(report["movie_length"], "duration")
    ranges = report["score_split"].withColumnRenamed(at.type, "__type")
    tables = {
        "type_share": percent_label(
            _with_share(report["type_count"]), "share", minimum=0, decimals=1
        ),
        "released": between(report["released"], at.release_year, *years),
        "country_total": n_largest(report["country_total"], "count", top, ["country"]).orderBy("count"),
        "type_ratio": ratio,
        "length_bars": histogram(length, "duration", 40),
        "length_curve": normal_curve(length, "duration", 200),
        "categories": n_largest(report["categories"], "count", top, ["category"]).orderBy("count"),
        "people": report["people"].filter("rank <= 10").orderBy("country", "count"),
    }
    for name in at.types:
        one = ranges.filter(F.col("__type") == name).select("bucket", "count", "percent")
        tables[f"scores_{name}"] = reindex(one, "bucket", scores).orderBy("position")
    if "feature_accuracy" in report:
        tables["feature_accuracy"] = mark_best(
            report["feature_accuracy"].select("feature", "accuracy"), "accuracy"
        ).orderBy("accuracy")
    return tables


# fixed value: the line that score charts draw as the overall average
SCORE_LINE = 6.0


def score_charts(report: Mapping[str, DataFrame], top: int = 15) -> dict[str, DataFrame]:
    """What the score charts draw, from ``score_report``.

    Bars of the best genres and countries from the lowest up, the line of
    decades, types with the ends of their error bars; the overall line beside each.
    """
    line = F.lit(SCORE_LINE).alias("line")
    bars = {k: n_largest(report[k], "avg_score", top, [k]).orderBy("avg_score", F.desc(k)).select(k, "avg_score", "count", line) for k in ("genre", "country")}
    kinds = report["type"]
    spread = [(F.col("avg_score") + sign * F.col("std_score")).alias(name) for sign, name in ((-1, "low"), (1, "high"))]
    return {
        "genre_score": bars["genre"],
        "country_score": bars["country"],
        "decade_score": report["decade"].orderBy("decade").select("decade", "avg_score", "count", line),
        "type_score": kinds.select(kinds.columns[0], "avg_score", "count", *spread, line),
    }


def model_charts(report: Mapping[str, DataFrame], top: int = 10) -> dict[str, DataFrame]:
    """What the model charts draw, from ``model_report``: comparisons, heaviest features, k, cluster sizes and means."""
    return {
        "classifiers": mark_best(report["classifiers"], "accuracy"),
        "regressors": mark_best(report["regressors"], "r2"),
        "forest_importance": n_largest(report["forest_importance"], "importance", top, ["feature"]).orderBy("importance", F.desc("feature")),
        "boosted_importance": n_largest(report["boosted_importance"], "importance", top, ["feature"]).orderBy("importance", F.desc("feature")),
        "k_sweep": report["k_sweep"].orderBy("k"),
        "clusters": cluster_chart(report["cluster_profile"]).orderBy("prediction"),
    }


def cluster_chart(profile: DataFrame, year: str = "avg_release_year", people: str = "avg_actor_count") -> DataFrame:
    """Cluster means with year and people brought onto the score axis."""
    scaled = rescale(profile, year, 1900, 10, out=f"{year}_scaled")
    return rescale(scaled, people, 0, 10, out=f"{people}_scaled")


def _with_share(counts: DataFrame) -> DataFrame:
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("share", F.col("count") / total)
