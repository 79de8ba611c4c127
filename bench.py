"""Time headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, optional).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from terrasheaf.plans import load_all  # noqa: E402
from terrasheaf.plans.registry import QUERIES  # noqa: E402
from terrasheaf.session import local_session  # noqa: E402

HEADLINE = [
    "rank_v2",
    "build_pack",
    "diff_places",
    "physical_peers",
    "unpaired_edges",
    "terminal_census",
    "select_terminals",
    "two_hop_recovery",
    "edges_at_point",
    "correlate",
    "points_in_polygon",
    "window_edges",
    "tile_fingerprints",
    "diff_tiles",
    "diff_ways",
    "layer_coverage",
    "check_correlations",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    load_all()
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    # Warm the session and the Python workers, so the first query is not charged for them.
    QUERIES["place_key"](spark, sf_dir).limit(1).collect()
    timed = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timed[name] = round(time.perf_counter() - start, 3)
        print(name, timed[name], file=sys.stderr, flush=True)
    total = round(sum(timed.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": timed, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
