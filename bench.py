"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, optional).
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from statlake.plans import all_queries
from statlake.session import build_session

HEADLINE = [
    "a01_basic_statistics", "a02_region_year_statistics", "a06_indicator_dispersion", "a21_exact_percentiles", "a22_column_profile",
    "j02_left_join_statistics", "j06_population_growth", "p01_map_mixed_domains", "x01_parse_time", "q08_dataset_gate", "q15_validation_report",
    "w01_repeated_rows", "w06_status_transitions", "i01_schema_from_data", "k09_search", "k24_tfidf_search", "k26_vector_search", "m12_dashboard",
    "s17_time_partitions", "e01_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.sql.files.maxPartitionBytes": str(4 << 20), "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    queries["a20_row_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()      # warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
