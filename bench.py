"""Bench: headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS] (default 8). Each query is executed in full through
the ``noop`` sink (no rows shipped to the driver). Prints one JSON line.
Each headline query is first run once at sf0.001 (JVM start, JIT, code
generation); those warm runs are not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "j02_j04_match_features",      # flagship: form + h2h before every match
    "w01_w15_rolling_features",    # team rolling windows
    "w16_w20_h2h_features",        # cumulative head-to-head
    "p12_clean_matches",           # parse, validate, name map
    "l04_last_10",                 # last-n per team (WindowGroupLimit)
    "l06_h2h_all_time",            # all-time record per pair
    "j06_latest_form",             # latest snapshot per team
    "m13_fixture_features",        # fixture assembly
    "q13_range_checks",            # feature sanity checks
    "d04_mart_team_form",          # last-10/20 mart
    "w01_w15_rolling_bucketed",    # team windows over 64 ranges
    "w16_w20_h2h_bucketed",        # head-to-head over 64 ranges
    "m14_score_fixtures",          # train forest (300 trees) + score fixtures
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from matchlab.session import local_session
    spark = local_session(cpus, shuffle_partitions=int(cpus), app="matchlab-bench")
    from matchlab.plans.catalog import QUERIES

    warm = str(Path(sf_dir).parent / "sf0.001")
    if Path(warm).exists() and warm != sf_dir:
        for name in HEADLINE:
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
