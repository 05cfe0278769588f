"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query is fully executed (all rows produced) through the ``noop``
sink, so nothing is collected to the driver; a query's time includes any
small planning jobs it runs (size checks, checkpoints).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT] + [p for p in [os.environ.get("PYTHONPATH")] if p])

from gleaner.plans.queries import QUERIES  # noqa: E402
from gleaner.session import get_session  # noqa: E402

HEADLINE = [
    "plan_transform", "select_work", "slice_pairs", "resolve_redirect", "plan_resource_fetch",
    "plan_artefact_fetch", "resource_index", "dataset_resource_map", "make_facts",
    "resolve_entities", "fact_provenance", "flatten_entities", "transform_issues",
    "transformed_facts", "check_expectations", "entity_organisation",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus * 2)))
    # warm-up: JVM start and first scan, not timed
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        fn = QUERIES[name][0]
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
