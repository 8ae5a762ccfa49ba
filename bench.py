"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed fully with the ``noop`` sink (every row produced, none
collected); one warm-up pass over the set, then the timed pass. Prints ONE
JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contentlake.functions.joins import release_kept  # noqa: E402
from contentlake.plans.catalog import QUERIES  # noqa: E402
from contentlake.session import build_session  # noqa: E402

HEADLINE = [
    "get_document", "get_children", "get_workflows", "get_acl", "get_blob", "inline_or_lookup",
    "doc_to_columns_all", "doc_to_columns_mapped", "path_schema_property", "path_array_predicate",
    "path_match_collapse", "query_sort", "query_page", "query_all_pages", "query_next_page",
    "create_document", "update_document", "trash_document", "attach_blob", "upload_chunked",
    "start_workflow", "cancel_workflow", "op_document", "op_result_kind", "route_counts",
    "stream_lookup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else (list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE)
    spark = build_session(f"local[{cpus}]", app="contentlake-bench",
                          shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2)),
                          extra={"spark.driver.memory": "16g",
                                 "spark.checkpoint.dir": os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="bench-ckpt-")})
    warm = os.environ.get("BENCH_WARMUP", "1") != "0"

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        elapsed = time.perf_counter() - t0
        release_kept()
        return elapsed

    if warm:
        for n in names:
            run(n)
    timings = {n: round(run(n), 3) for n in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
