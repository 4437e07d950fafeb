"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query is built and run
from its source tables, stored stages included, after one warm-up round on the same data.
``dominated_crowd`` is the dedup with a third of all rows moved to one place; ``map_rebuilt`` and
``map_updated`` are the map table from all pairs, and its update by those of the last days.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from skyground.operators.proximity import confident, dominated_ids, proximity_dedup  # noqa: E402
from skyground.operators.ranking import best_per_report, map_view  # noqa: E402
from skyground.plans.incremental import rebuild_map, update_map  # noqa: E402
from skyground.plans.stages import stored  # noqa: E402
from workload import fixtures, queries  # noqa: E402

HEADLINE = (
    "silver_dedup", "candidates_scored", "map_view", "map_view_dense", "merge_pairs_first_wins",
    "feed_a_normalised", "feed_b_normalised", "feed_a_quality", "in_box_table", "request_list",
    "export_rows", "contract_checks",
)


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def crowded(df: DataFrame) -> DataFrame:
    """A third of the rows within 3 km and 12 h of one place."""
    hot = F.col("id") % 3 == 0

    def near(c: str, at: float):
        return F.when(hot, F.lit(at) + (F.col(c) - F.floor(c)) * 0.03).otherwise(F.col(c))

    return df.withColumns({
        "latitude": near("latitude", 48.0), "longitude": near("longitude", 37.0),
        "acq_datetime": F.when(hot, F.timestamp_seconds(
            F.lit(1_704_067_200) + F.unix_seconds("acq_datetime") % 43_200))
        .otherwise(F.col("acq_datetime")),
    })


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def timed_call(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(cpus)
    registered = queries.registered()

    for name in HEADLINE:
        timed(lambda: registered[name](spark, sf_dir))
    times = {name: timed(lambda: registered[name](spark, sf_dir)) for name in HEADLINE}

    points = stored(confident(fixtures.detections(spark, sf_dir)), "points")
    silver = stored(proximity_dedup(points), "silver")
    events = fixtures.reports(spark, sf_dir)
    crowd = stored(crowded(points), "crowd")
    pairs = stored(queries.correlate(silver, events), "pairs")
    day = stored(pairs.filter("fire_acq_datetime >= timestamp'2024-01-28'"), "day")
    map_schema = f"bench_{os.getpid()}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {map_schema}")
    steps = {}
    for _ in range(2):  # the first round warms up
        steps = {
            "dominated": timed(lambda: dominated_ids(points)),
            "pairs": timed(lambda: queries.correlate(silver, events)),
            "best": timed(lambda: best_per_report(pairs)),
            "dominated_crowd": timed(lambda: dominated_ids(crowd)),
            "map_rebuilt": timed_call(lambda: rebuild_map(spark, map_schema, map_view(
                stored(pairs.filter("fire_acq_datetime < timestamp'2024-01-28'"), "before")))),
            "map_updated": timed_call(lambda: update_map(spark, map_schema, day)),
        }
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": cpus,
        "steps": steps,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
