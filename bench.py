"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 1, the median counts).
Every query is run once to warm up; results are computed in full and discarded.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kamienica.contract import QUERIES  # noqa: E402
from kamienica.session import get_session  # noqa: E402

HEADLINE = [
    "clean_listings", "multi_hot", "vocabulary", "tokens_long", "fold_accents", "keyword_backfill", "links_extract",
    "adverts_wide", "pages_routed", "last_wins", "pairs_to_wide", "null_counts", "describe_all", "exact_quantiles",
    "ordinal_encode", "first_seen_encode", "ordinal_encode_wide", "one_hot", "outliers_iqr", "outliers_two_rounds",
    "corr_pairs", "standard_scale", "power_fit", "hash_split", "pca_variance", "knn_impute", "knn_impute_customers",
    "knn_impute_orders", "knn_regress", "build_features", "linear_regression", "model_XGB",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                        spark__ui__showConsoleProgress="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.time()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.time() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name:24} {seconds[name]:8.3f}  first {times[0]:.2f}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "sum of median query times", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
