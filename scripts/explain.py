"""Print the formatted physical plan of registered queries.

    python scripts/explain.py [sf_dir] name [name ...]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from contentlake.plans.catalog import QUERIES  # noqa: E402
from contentlake.session import build_session  # noqa: E402

args = sys.argv[1:]
sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
names = [a for a in args if not os.path.isdir(a)]
spark = build_session("local[8]", shuffle_partitions=16)
for n in names:
    print(f"===== {n}")
    QUERIES[n](spark, sf).explain("formatted")
spark.stop()
