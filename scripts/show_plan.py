"""Print the formatted physical plan of registered queries (after one run,
so the adaptive plan is final) and the run time.

usage: python scripts/show_plan.py sf_dir query [query ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from recflow.plans.queries import QUERIES  # noqa: E402
from recflow.session import build_session  # noqa: E402

spark = build_session("local[8]", 16)
sf_dir = sys.argv[1]
for name in sys.argv[2:]:
    df = QUERIES[name](spark, sf_dir)
    t0 = time.time()
    df.write.format("noop").mode("overwrite").save()
    print(f"== {name}: {time.time() - t0:.2f}s")
    df.explain("formatted")
