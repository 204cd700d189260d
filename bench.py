"""Times all reports; prints one JSON line.

Each report runs once to warm up (class loading, code generation) and is then
timed in a second full run into the no-op sink. Checkout texts, which the test
view makes from order lines, are written once before, so that the basket
reports are timed and not that view.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shopledger.plans import fixtures  # noqa: E402
from shopledger.plans.queries import QUERIES  # noqa: E402
from shopledger.session import local_session  # noqa: E402


def run(spark, name: str, folder: str) -> float:
    begun = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or sorted(QUERIES)
    spark = local_session("bench", cores, int(cores) if cores.isdigit() else 8)
    texts = f"{tempfile.mkdtemp(prefix='bench-')}/intents"
    fixtures.catalog(spark, folder).table("intents").write.parquet(texts)
    fixtures.BUILDERS["intents"] = lambda c: c.spark.read.parquet(texts)
    timings = {}
    for name in names:
        run(spark, name, folder)
        timings[name] = round(run(spark, name, folder), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cores,
                "spark": spark.version,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
