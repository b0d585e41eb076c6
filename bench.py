"""Times the headline queries; prints one JSON line.  Each runs twice: the first run, which compiles its code and warms the JVM, is given as cold, the second is the value."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from tallyloom.queries import QUERIES

NAMES = ("sales_daily", "register_with_documents", "header_first_line", "fk_resolve", "packed_ref_resolve", "stable_ids", "upsert_keys", "delete_insert", "tail_pickup", "partition_fingerprint", "document_patch", "daily_recon", "hierarchy_flatten", "failure_streaks")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="spark-")).config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()  # the session's start is not a query's time
    cold, warm = {}, {}
    for name in NAMES:
        for took in (cold, warm):
            began = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took[name] = round(time.time() - began, 3)
    total = lambda took: round(sum(took.values()), 3)
    print(json.dumps({"metric": "seconds for all headline queries, second run of each", "value": total(warm), "unit": "sec", "queries": warm, "cold_value": total(cold), "cold_queries": cold, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
