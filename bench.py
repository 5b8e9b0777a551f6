"""Headline timings as one JSON line.

Runs at $BENCH_SF_DIR on local[$BENCH_CPUS]. The layers are derived from the test tables
and stored first ("prepare"), a store of two studies before the summaries
("stored_studies"); each query runs once, whole, into a sink that discards its rows. "overlay" is the reference workload: split, intersection and store of a study.
"""

import json
import os
import time

from checks.inputs import layers, overlay, parameters, stored
from checks.queries import QUERIES
from hazline.session import local_session

OVERLAY = [
    "split_cuts",
    "ear_pieces",
    "ear_multipart",
    "ear_fractional",
    "split_at_elements",
    "element_hazard_pairs",
    "intersection_table",
    "study_run",
]
SUMMARY = [
    "element_summary",
    "route_summary",
    "element_summary_layer",
    "route_summary_layer",
    "what_if_parameters",
    "load_report",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}

    def timed(name, action):
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)

    def run(name):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timed("prepare", lambda: (layers(spark, sf_dir), parameters(spark)))
    for name in OVERLAY:
        timed(name, lambda: run(name))
    timed("stored_overlay", lambda: overlay(spark, sf_dir))
    timed("stored_studies", lambda: stored(spark, sf_dir))
    for name in SUMMARY:
        timed(name, lambda: run(name))
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "hazard_overlay_and_risk_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
