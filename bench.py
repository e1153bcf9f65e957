"""Headline timings: one JSON line.

Each query runs once to warm up and once timed; all its rows are computed and
thrown away by executors. Next to them stand the same questions asked step by
step, with one operator per step and one plan per type or country.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.operators import aggregates, joins, people, ranking
from playbill.operators.derive import explode_list
from playbill.plans import catalog_of_queries
from playbill.plans.analysis_queries import SIX_COUNTRIES
from playbill.plans.table_queries import TYPES
from playbill.plans.views import Tables
from playbill.session import tuned_session

CPUS = int(os.environ.get("BENCH_CPUS", "8"))
FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
HEADLINE = {
    "type_ratio": "a18_type_ratio",
    "top_people": "t03_top_people",
    "enrich": "j01_left_enrich",
    "year_trend": "a02_year_trend",
    "histogram": "a20_histogram",
    "fill_median": "c07_fill_median_wide",
    "dedup_key": "c12_dedup_key",
    "majority_sweep": "m08_majority_sweep",
    "clean_two_tables": "r02_clean_two_tables",
}
FITTED = {"silhouette_sweep": "m19_silhouette_sweep"}  # timed once: 18 fits


def drained(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def stepwise_type_ratio(t: Tables) -> None:
    rows = joins.keep_top_keys(explode_list(t.catalog, "countries", "country"), "country", 10)
    counts = joins.with_group_total(aggregates.count_by(rows, ["country", "type"]), "country", "count")
    shares = counts.withColumn("ratio", F.col("count") / F.col("total"))
    aggregates.pivot_sum(shares, "country", "type", TYPES, "ratio").toPandas()


def stepwise_top_people(t: Tables) -> None:
    for country in SIX_COUNTRIES:
        ranking.top_people(t.catalog, [country], credits=t.credits).toPandas()


def stepwise_year_trend(t: Tables) -> None:
    for kind in TYPES:
        aggregates.trend(t.catalog, "release_year", [kind]).toPandas()


def stepwise_enrich(t: Tables) -> None:
    counted = joins.attach(t.catalog.select("id", "title"), people.people_per_title(t.credits), "id", {"actor_count": 0})
    drained(counted.join(people.cast_text(people.cast_list(t.credits)), "id", "left"))


STEPWISE = {
    "type_ratio": stepwise_type_ratio,
    "top_people": stepwise_top_people,
    "year_trend": stepwise_year_trend,
    "enrich": stepwise_enrich,
}


def main() -> None:
    spark: SparkSession = tuned_session(
        "playbill-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": str(CPUS),
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog_of_queries()
    times: dict[str, float] = {}
    for name, key in HEADLINE.items():
        drained(queries[key](spark, FOLDER))
        times[name] = seconds(lambda: drained(queries[key](spark, FOLDER)))
    for name, key in FITTED.items():
        times[name] = seconds(lambda: drained(queries[key](spark, FOLDER)))
    stepwise = {}
    for name, run in STEPWISE.items():
        run(Tables(spark, FOLDER))
        stepwise[name] = seconds(lambda: run(Tables(spark, FOLDER)))
    sf = os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "stepwise": stepwise,
                "sf": sf,
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
