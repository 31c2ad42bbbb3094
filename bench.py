"""Times the headline queries and prints one JSON line.

``queries`` run from the raw tables to the result in one plan. ``stored_*`` are the same
reports over gold tables that the staged run wrote before (``staged_run``), which is how a
deployed lake serves them. Each time is the median of the timed rounds after a warm-up.
"""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from stratamart.plans.reports import REPORTS  # noqa: E402
from stratamart.plans.run import Lake, publish_to_layer, run, stored_gold  # noqa: E402
from stratamart.registry.queries import QUERIES  # noqa: E402
from stratamart.sources import tpch  # noqa: E402
from stratamart.sources.layers import Layer, scratch_directory  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "2"))

FROM_RAW = [*REPORTS, "fact_order_items", "dq_silver_suite", "dq_gold_suite"]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("stratamart-bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="stratamart-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action, rounds: int) -> float:
    times = []
    for _ in range(rounds + 1):
        begin = time.perf_counter()
        action()
        times.append(time.perf_counter() - begin)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    spark = session()
    times = {}
    for name in FROM_RAW:
        times[name] = timed(lambda: consume(QUERIES[name](spark, SF_DIR)), ROUNDS)

    root = scratch_directory(spark)
    lake, published = Lake.under(root), Layer(f"{root}/published")

    def staged():
        run(spark, tpch.sources(spark, SF_DIR), lake, publish_to_layer(published))

    times["staged_run"] = timed(staged, 1)
    for name, report in REPORTS.items():
        times[f"stored_{name}"] = timed(lambda: consume(report(stored_gold(spark, lake))), ROUNDS)

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "rounds": ROUNDS,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
