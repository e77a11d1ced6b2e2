"""Headline queries on one machine; prints one JSON line.

BENCH_SF_DIR  table folder (default /root/testdata/sf0.1)
BENCH_CPUS    cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

HEADLINE = [
    "message_points",
    "trigger_predicate",
    "tagged_points",
    "first_offline_alarms",
    "delayed_alarms",
    "repeat_reminders",
    "off_count_alarms",
    "disconnect_frequency",
    "rule_alarms",
    "push_messages",
    "control_from_rules",
    "control_from_alarms",
    "rule_mapping_after_changes",
    "points_as_of_changes",
    "late_rows_dropped",
    "command_machine_lists",
]


def main() -> None:
    from alarmloom.plans.catalog import QUERIES
    from alarmloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus))

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("delayed_alarms")  # starts the JVM's compilers and the Python workers
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
