"""Benchmark: build the marts from the driver tables, then run the headline queries.

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3; every step, builds included, runs once to warm up, then the median of
the repeats; each run plans a fresh DataFrame, so no shuffle output is reused).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reelmart.operators import marts as M  # noqa: E402
from reelmart.operators import quality as Q  # noqa: E402
from reelmart.plans import analytics as A  # noqa: E402
from reelmart.plans import charts as C  # noqa: E402
from reelmart.plans.pipeline import (  # noqa: E402
    MART_NAMES, build_from_driver_tables, materialize, materialize_staging)
from reelmart.session import get_session, scratch_path  # noqa: E402

AS_OF_YEAR = 2024


def _timed(fn):
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def _measure(fn, repeats: int) -> float:
    """One warm-up run, then the median of ``repeats`` runs."""
    fn()
    return statistics.median(_timed(fn) for _ in range(repeats))


def _measure_keep(fn, repeats: int):
    """Like ``_measure``, also returning the last run's result."""
    result = {}

    def run():
        result["value"] = fn()
    return _measure(run, repeats), result["value"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = get_session(f"local[{cpus}]", app_name="reelmart-bench", shuffle_partitions=cpus * 2,
                        conf={"spark.driver.memory": "16g",
                              "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    spark.sparkContext.setLogLevel("ERROR")
    scratch = scratch_path(spark, "bench")  # under spark.checkpoint.dir when the cluster names one

    times: dict[str, float] = {}
    # the driver's tables are single files of one row group: deal the two large sources over all cores
    wh = build_from_driver_tables(spark, sf_dir, as_of_year=AS_OF_YEAR, spread_partitions=cpus)
    marts_dir = f"{scratch}/marts"

    # 1. store the marts and the two big staging views, as the pipeline runner does before the checks
    #    (independent writes are submitted side by side from driver threads)
    def build_marts():
        return materialize(spark, wh, marts_dir)

    def build_staging():
        return materialize_staging(spark, wh, f"{scratch}/staging", ["stg_title_principals", "stg_title_akas"])

    times["build_marts"], marts = _measure_keep(build_marts, repeats)
    times["build_big_staging"], staged = _measure_keep(build_staging, repeats)
    titles, people, fact, bridge = (marts[n] for n in MART_NAMES)
    principals, akas = staged["stg_title_principals"], staged["stg_title_akas"]

    relations = wh.relations()
    relations.update(marts)
    relations.update({"stg_title_principals": principals, "stg_title_akas": akas})
    measured = {**marts.measured, **staged.measured}  # row-level checks, taken in the writes above

    # 2. headline queries over the stored marts
    headline = {
        "q01_top_rated_movies": lambda: A.top_rated_movies(fact, titles),
        "q02_production_trends": lambda: A.production_trends(titles, fact),
        "q03_genre_popularity": lambda: A.genre_popularity(titles, fact),
        "q04_professions_by_generation": lambda: A.professions_by_generation(people),
        "q05_career_longevity": lambda: A.career_longevity(people),
        "q06_quality_quadrants": lambda: A.quality_quadrants(fact),
        "q07_runtime_evolution": lambda: A.runtime_evolution(titles, fact),
        "q08_adult_vs_general": lambda: A.adult_vs_general(fact),
        "q09_long_running_series": lambda: A.long_running_series(titles, fact),
        "q10_recent_vs_classic": lambda: A.recent_vs_classic(titles, fact),
        "q11_data_completeness": lambda: A.data_completeness(titles, people, fact),
        "q12_executive_metrics": lambda: A.executive_metrics(titles, people, fact),
        "d1_movies_by_decade": lambda: C.chart_movies_by_decade(titles, fact),
        "d2_genre_popularity": lambda: C.chart_genre_popularity(titles, fact),
        "d3_quality_points": lambda: C.chart_quality_points(titles, fact),
        "d4_runtime_groups": lambda: C.chart_runtime_groups(titles),
        "d5_people_roles": lambda: C.chart_people_roles(people),
        "d6_summary_stats": lambda: C.summary_stats(titles, people, fact),
        "bridge_by_department": lambda: bridge.groupBy("role_department", "media_type").count(),
        "principals_by_category": lambda: principals.groupBy("job_category").count(),
        "akas_by_region": lambda: akas.groupBy("region_code").count(),
        "quality_report": lambda: Q.quality_report(relations, as_of_year=AS_OF_YEAR, measured=measured),
    }
    for name, make in headline.items():
        times[name] = _measure(lambda: make().collect(), repeats)

    sf_match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(sf_match.group(1)) if sf_match else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
