"""Time the headline queries and print one JSON line.

The study's source domains are written once beforehand (they stand for delivered
files); every query then starts from those files and the driver tables.
Each query first runs on the smallest data next to the given folder, to compile its code.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import catalog
from catalog.views import STORED, Views
from clinspark.session import drop_stages, local_session

HEADLINE = [
    "etl_person",
    "etl_condition",
    "etl_drug",
    "etl_measurement",
    "etl_visit",
    "etl_observation_period",
    "link_visits",
    "map_deterministic",
    "apply_deterministic",
    "candidate_top15",
    "record_decisions",
    "review_batch",
    "rule_upsert",
    "concept_violations",
    "visits_outside_period",
    "acceptance_report",
    "rwe_population",
    "rwe_gender",
    "rwe_top_conditions",
    "rwe_lab_means",
    "rwe_rescue_rate",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, int(cores), "16g", tempfile.mkdtemp(prefix="bench-"))
    registry = catalog.load().QUERIES

    smallest = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    warm = smallest if os.path.isdir(smallest) else folder

    for source in {warm, folder}:
        views = Views(spark, source)
        for name in sorted(STORED):
            getattr(views, name)

    def run(name: str, source: str) -> float:
        begin = time.perf_counter()
        registry[name](spark, source).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - begin, 3)

    seconds = {}
    for name in names:
        run(name, warm)
        seconds[name] = run(name, folder)
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    result = {
        "metric": "headline queries, total seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    drop_stages(spark)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
