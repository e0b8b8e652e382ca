"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

from stationlens.operators.clean import clean_readings
from stationlens.plans import adapters as A
from stationlens.plans import registry
from stationlens.plans import stage_load
from stationlens.session import build_session

QUERIES = [
    "clean_readings", "missingness_by_sensor_variable", "missing_gaps", "invalid_values", "impute_all", "imputation_error_summary",
    "distribution_summary", "monthly_by_sensor", "hourly_cycle", "mann_kendall", "autocorrelation", "sensor_correlations",
    "cell_correlations", "stable_pairs", "chronological_split", "threshold_graph", "knn_graph", "connected_components", "clustering",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}

    def timed(name, make):
        t = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
        print(name, times[name], file=sys.stderr, flush=True)

    spark.range(1000).selectExpr("sum(id)").collect()  # the JVM is up before the first query
    timed("load_and_clean_daily", lambda: clean_readings(A.readings_daily(spark, sf_dir)))
    # The cleaned tables are stage output that later stages read; writing them is timed apart.
    timed("write_cleaned_daily", lambda: stage_load.daily(spark, sf_dir))
    timed("write_cleaned_hourly", lambda: stage_load.hourly(spark, sf_dir))
    for name in QUERIES:
        timed(name, lambda: registry.QUERIES[name](spark, sf_dir))
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
