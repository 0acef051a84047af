"""Time the headline queries; prints one JSON line.

Every query runs once to warm up the JVM, then three times; the median counts. A run builds the query
(with the checks it makes beforehand) and computes all of its rows and columns.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from check import session
from matchboard.catalog import QUERIES

# the eight measured reference queries first, then models, network, ranks, checks and changes
HEADLINE = (
    "top_kda win_rate avg_damage most_improved frequent_pairs prize_by_player top10_dense_rank last10_per_player "
    "team_network current_streak int_player_match_summary int_team_match_summary player_performance "
    "tournament_standings prize_earnings team_counters dense_rank_all leaderboard_global surrogate_ids "
    "dq_unique fk_violations quarantine_stats audit_diff changelog_compact rate_limit"
).split()


def run(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run(spark, name, folder)
        times[name] = round(statistics.median(run(spark, name, folder) for _ in range(3)), 4)
    total = round(sum(times.values()), 4)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    result = {"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": float(scale)}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
