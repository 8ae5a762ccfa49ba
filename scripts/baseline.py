"""Median timings (3 runs after one warm-up) and row counts of the headline

    python scripts/baseline.py [sf_dir]
"""

import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from contentlake.functions.joins import release_kept  # noqa: E402
from contentlake.plans.catalog import QUERIES  # noqa: E402
from contentlake.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
spark = build_session("local[8]", shuffle_partitions=16, extra={
    "spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="baseline-ckpt-")})
print("| query | rows out | median s | runs | config |")
print("|---|---|---|---|---|")
for name in HEADLINE:
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    release_kept()
    times = []
    for _ in range(3):
        t0 = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
        release_kept()   # as bench.py does: no run reuses another's frames
    rows = QUERIES[name](spark, sf).count()
    print(f"| `{name}` | {rows:,} | {statistics.median(times):.2f} | 3 | PySpark {spark.version}, "
          f"local[8], 16 shuffle partitions, AQE on |", flush=True)
spark.stop()
