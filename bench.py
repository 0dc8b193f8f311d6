"""Time the headline queries at one scale; prints one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Each query writes its whole result to the no-op sink. The time reported is the
second of two runs: the first pays for class loading and code generation. The boosted
fit that the model queries share, whole stages of rounds, is timed as ``boosted_fit``,
once; these queries then walk its node table.
"""

from __future__ import annotations

import json
import os
import time

from contract.queries import QUERIES, trained
from swishline.session import local_session

# per family: rows, look-ups, reports, evaluation, sources, model, streams
HEADLINE = [
    "build_event",
    "feature_rows",
    "skill_lookup_train",
    "player_skill",
    "zone_stats",
    "player_leaderboard",
    "shots_per_minute",
    "dashboard_snapshot",
    "distance_histogram",
    "latest_n",
    "sample_n",
    "eval_auc",
    "class_balance",
    "scan_plays",
    "append_telemetry",
    "train_logistic",
    "train_boosted",
    "retrain_job",
    "score_shots",
    "stream_enrich",
    "stream_enrich_model",
    "stream_running_totals",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, "bench")
    timings: dict[str, float] = {}
    began = time.perf_counter()
    trained(spark, sf_dir)
    timings["boosted_fit"] = round(time.perf_counter() - began, 3)
    for name in HEADLINE:
        for _ in range(2):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - began, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
