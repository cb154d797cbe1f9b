"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one warm-up, then the median of three
runs, each writing every row to a sink that discards it. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from vitrine.operators import gold, silver  # noqa: E402
from vitrine.plans.catalog import QUERIES, ranking  # noqa: E402
from vitrine.plans.catalog.registry import AS_OF, cards  # noqa: E402
from vitrine.session import local_session  # noqa: E402

HEADLINE = [
    "q_brand_means", "q_silver", "q_gold", "q_validate_cards", "q_quality_report", "q_column_profile",
    "q_numeric_stats", "q_boxplot", "q_price_histogram", "q_opportunity", "q_hierarchy_rollup",
    "q_cap_per_source", "q_geo_enrich", "q_dealer_lookup", "q_label_encode", "q_demand_forecast",
    "q_stage_durations", "q_bm25_topk", "q_bm25_many", "q_postings_df", "q_dealer_names", "q_index_growth",
]
#: Beside the queries: the index alone, which q_bm25_many builds before it asks.
INDEX = "index_build"
FOLD = 4


def seconds(frame) -> float:
    begin = time.perf_counter()
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def median_seconds(build, runs: int) -> float:
    """A run includes building the query, and starts without frames kept by an earlier one."""
    def once() -> float:
        begin = time.perf_counter()
        frame = build()
        building = time.perf_counter() - begin
        spent = building + seconds(frame)
        frame.sparkSession.catalog.clearCache()
        return spent

    once()
    return statistics.median(once() for _ in range(runs))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cores, "16g")
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        timings[name] = round(median_seconds(lambda n=name: QUERIES[n](spark, folder), runs), 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    if "BENCH_QUERIES" not in os.environ:
        result[INDEX] = round(median_seconds(
            lambda: ranking.index_of(ranking.documents(spark, folder), "bench").frequencies(), runs), 3)
        # Linear growth: the same refinement over the rows repeated four times.
        folded = cards(spark, folder).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(FOLD))))
        rows = cards(spark, folder).count()
        growth = median_seconds(lambda: gold.build(silver.build(folded, AS_OF)), 1)
        result["rows_per_second"] = {
            n: round(rows / timings[n]) for n in ("q_silver", "q_gold") if n in timings
        }
        result["growth"] = {"fold": FOLD, "q_gold_folded": round(growth, 3)}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
