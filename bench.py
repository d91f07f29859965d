"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line."""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from varloom import catalog

HEADLINE = ["interval_split", "background_join", "six_seqs", "region_overlap_join", "topk_cascade", "sample_embedding_mean", "impute_median", "roc_auc", "embed_six_vectors"]


def main() -> None:
    where, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(2 * int(cpus) if cpus.isdigit() else 16)).config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        run = lambda: catalog.QUERIES[name](spark, where).write.format("noop").mode("overwrite").save()  # noqa: B023, E731
        run()
        each = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "1"))):
            begin = time.perf_counter()
            run()
            each.append(time.perf_counter() - begin)
        took[name] = round(statistics.median(each), 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(where.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
