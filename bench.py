"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Every
query is built and run to the end into a sink that keeps nothing. The read protocol (rows and MB per
second of a full scan) is reported next to the times.
"""

from __future__ import annotations

import json
import os
import sys
import time

from sparrowmill.plans import load_all
from sparrowmill.plans.registry import QUERIES
from sparrowmill.session import local_session
from sparrowmill.tables import table

HEADLINE = """
A11_plan_shards A12_dataset_manifest A15_verify_checksums B04_profile B09_reconcile B15_crosstab C05_where D01_metadata_lookup
D05_token_lookup D07_overlap_join D08_nearest E01_reduce_rows E08_smooth_l1 E10_cross_entropy E17_perplexity
E19_moments E27_throughput E29_linear_fit E31_kfold_error F01_lag_features F05_cumsum F06_cumprod F08_velocity F16_zipf
G02_shuffle G06_kfold G09_batches I06_softmax J03_build_vocab J04_encode_docs J06_bigrams J06_trigrams J08_bigram_prob
J09_windows_random K02_standardize_sample K05_get_dummies L04_assign L07_nms M08_policy_chain N02_tumbling O01_map_batches
""".split()


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    load_all()
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    run(table(spark, sf_dir, "lineitem"))  # load the classes every query needs before the clock runs
    run(QUERIES["J06_unigrams"](spark, sf_dir))

    start = time.perf_counter()
    docs = table(spark, sf_dir, "documents")
    run(docs)
    seconds = time.perf_counter() - start
    size = os.path.getsize(f"{sf_dir}/documents.parquet") if os.path.exists(f"{sf_dir}/documents.parquet") else 0
    read = {"rows_per_sec": round(docs.count() / seconds, 1), "mb_per_sec": round(size / 1048576 / seconds, 2)}

    times: dict[str, float] = {}
    chosen = sys.argv[1:] or HEADLINE
    for name in chosen:
        start = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf_dir.rstrip("/").rpartition("sf")[2], "read": read,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
