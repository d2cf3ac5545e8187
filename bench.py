"""Times the headline queries; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from docloom.plans import catalog

HEADLINE = ("search_bm25_batch", "search_fusion", "audit_severity", "description_snippets", "card_qc_flags", "dense_topk", "job_latest_state")


def main() -> None:
    d, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    took = {}
    for name in HEADLINE:
        began = time.time()
        catalog.QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total wall time", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(d)}))
    spark.stop()


if __name__ == "__main__":
    main()
