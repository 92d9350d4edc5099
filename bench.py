"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs to the end into Spark's ``noop`` sink, so all its rows are
computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import queries  # noqa: E402
from roadrisk.session import session  # noqa: E402

HEADLINE = (
    "scan_filter_rename", "clean_accidents", "weather_hist_staging", "weather_rt_staging", "weather_etl_features",
    "flow_staging", "json_parse_defaults", "incident_explode_coords", "array_zip_explode", "city_bbox_range_join",
    "traffic_mart", "accident_weather_join", "safety_mart", "weather_fact", "training_table", "future_features",
    "forecast_ols", "risk_assessment", "rolling_7d", "load_stats", "dq_unique", "dq_report",
    "stream_snapshot", "stream_trailing", "stream_dedupe",
)


def main(names: tuple[str, ...]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    # Warm-up, not counted: the first query of a session pays for starting up.
    queries.QUERIES["flow_staging"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main(tuple(sys.argv[1:]) or HEADLINE)
