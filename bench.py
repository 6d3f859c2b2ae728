"""Time registered queries and print one JSON line.

BENCH_SF_DIR    folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS      local threads (default 8)
BENCH_QUERIES   comma-separated names, or "all" (default: the headline queries)

BENCH_RUNS      runs of each query (default 3); the median is reported

Queries are built and run in a warm session; the whole result is computed and handed to Spark's no-op sink.
"""

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from grantline import catalog  # noqa: E402

HEADLINE = [
    "principals_all",
    "governance_export",
    "governance_roundtrip",
    "role_paths",
    "dropped_resources",
    "location_access",
    "location_access_anchored",
    "uncovered_patterns",
    "new_location_proposals",
    "location_grants",
    "hcl_location_document",
    "bucket_folders",
    "volumes",
    "hcl_volume_document",
    "principal_object_privileges",
    "object_grants",
    "unmapped_privileges",
    "hcl_acl_document",
    "hcl_text_roundtrip",
    "library_classify",
    "allowlist_delta",
    "allowlist_payload",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    queries = catalog.queries()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        # Python call sites are not needed here and cost time for each column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="grantline-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for table in ("lineitem", "orders", "customer", "supplier", "part", "nation", "region"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total time of the queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
