"""Time the headline queries and print one JSON line.

Every query runs once to warm the JVM and is then timed as the best of two runs into a sink that
computes all rows and columns and keeps none.
"""

from __future__ import annotations

import json
import os
import time

from touchline.checks.queries import QUERIES
from touchline.checks.session import local_session

HEADLINE = [
    "stg_players",
    "stg_fixtures",
    "stg_element_summary",
    "fct_player_gameweek",
    "fct_player_season_stats",
    "fct_player_form",
    "fct_fixture_schedule",
    "fct_captain_picks",
    "fct_differentials",
    "fct_transfer_trends",
    "fct_top_players",
    "rolling_form",
    "next_fixture_per_team",
    "explode_history",
    "drift_split",
    "drift_summary",
    "json_stringify",
    "missing_snapshots",
]
RUNS = 2


def timed(query, spark, sf_dir) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session()
    seconds = {}
    for name in HEADLINE:
        timed(QUERIES[name], spark, sf_dir)
        seconds[name] = round(min(timed(QUERIES[name], spark, sf_dir) for _ in range(RUNS)), 3)
    line = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": os.environ.get("BENCH_CPUS", "8"),
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
