"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR  folder of the sample tables   (default /root/testdata/sf0.1)
    BENCH_CPUS    local executor threads        (default 8)

Every query is planned and run in full, its rows going to a sink that discards them.  Each
is run once to warm up and then once timed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from accolade.plans import catalog  # noqa: E402
from accolade.session import local_session  # noqa: E402

HEADLINE = (
    "entity_day_activity", "running_totals", "visit_streaks", "metric_events", "milestones", "baseline_anomaly",
    "comp_budget", "favorite_game", "favorite_outlet", "entity_360", "recommendations", "worklist",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    queries = catalog.queries()
    timed: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timed[name] = round(time.perf_counter() - start, 3)
    digits = "".join(c for c in Path(sf_dir).name if c.isdigit() or c == ".")
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": timed, "sf": float(digits) if digits else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
