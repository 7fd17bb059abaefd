"""Times headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one line of JSON."""

import json
import os
import time

from pyspark.sql import SparkSession

from heliograph.plans import catalog

HEADLINE = ["gene_activity", "pf1_qc_filter", "ag2_pseudobulk_means", "ag4_context_means", "ag7_interval_merge", "ag14_normalize", "jn12_promoter_overlap", "jn15_annotate", "sm1_stratified_sample", "wn5_best_motif", "wn12_rank_sum_markers", "ml14_peak_gene_links"]


def yardstick() -> float:
    """Seconds of a fixed piece of plain computing, the median of five: what part of a change is the machine's."""
    def once() -> float:
        began = time.process_time()
        sum(i * i for i in range(2_000_000))
        return time.process_time() - began

    return round(sorted(once() for _ in range(5))[2], 4)


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["sc8_parquet_scan"](spark, d).write.format("noop").mode("overwrite").save()  # starts the JVM's machinery
    times = {}
    for name in HEADLINE:
        began = time.time()
        catalog.QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "yardstick_sec": yardstick(), "sf": os.path.basename(d.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
