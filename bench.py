"""Times the pipeline and its reports; prints one JSON line.

``ingest`` parses the feed's JSON lines into the bronze table, ``ingest_files`` reads them
from text files, with their line numbers; ``build`` classifies them and
writes every mart, ``rNN``/``cNN`` answer from the built marts, ``mNN`` compute the model
from its inputs. Each is run twice: ``cold`` has the first times, ``queries`` the second.
``checks`` has the seconds of the 41 checks that a build runs unless told not to.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventmart.sources import bronze  # noqa: E402
from eventmart_checks import catalogue, feed  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    name for name in catalogue.QUERIES if name[0] in "mrc" and name != "m04_dim_accounts"
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def read_files(spark: SparkSession, folder: str, root: str) -> None:
    """Event files through the line numbers and the gate into a bronze table."""
    bronze.ingest_events(
        spark, folder, f"{root}/files/lines", feed.INGESTED_AT, feed.FILES, f"{root}/files/offsets"
    )


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("eventmart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="eventmart-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for times in (cold, warm):
        root = feed.scratch_dir(spark, "bench")
        times["ingest"] = timed(lambda: feed.load(spark, SF_DIR, root))
        built = feed.Warehouse(spark, root)
        times["build"] = timed(lambda: built.build(check=False))
        checks = timed(lambda: built.checks().collect())
        folder = feed.write_files(spark, SF_DIR, "bench-files")
        times["ingest_files"] = timed(lambda: read_files(spark, folder, root))
    feed.warehouse(spark, SF_DIR)
    for name in HEADLINE:
        for times in (cold, warm):
            query = catalogue.QUERIES[name]
            times[name] = timed(
                lambda: query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "checks": checks,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
