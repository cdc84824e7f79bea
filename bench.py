"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from roadcast.plans.queries import QUERIES
from roadcast.session import build_session

HEADLINE = [
    "features_noroads_tp15",
    "features_roads_tp15",
    "features_incidents",
    "features_incident_types",
    "features_nearby_v2",
    "features_master_v3",
    "profile_readings",
    "incident_nearest_link",
    "link_nearest_station",
    "nearest_in_box",
    "gap_sessions",
    "fold_incidents",
    "nearby_incidents",
    "asof_rain",
    "change_features",
    "class_metrics",
    "threshold_sweep",
    "last_n",
    "match_routes",
    "route_alerts",
    "alert_cooldown",
    "current_places",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["profile_readings"](spark, sf_dir).collect()  # start the engine outside the timing
    seconds = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    line = {"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
