"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the folder of the tables, ``BENCH_CPUS`` the number of local cores and
``BENCH_QUERIES`` an optional comma-separated choice.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HEADLINE = (
    "knn", "knn_batch", "nearest_label", "knn_approx", "mean_shift_round", "kmeans", "map_space", "pool",
    "build_vocab", "numericalize_docs", "lm_stream", "doc_term", "doc_term_trigrams", "log_count_ratio", "naive_bayes",
    "ngram_next_token", "perplexity", "proc_text", "tokenize", "tokenize_docstring", "fixup", "function_docstring_pairs",
    "code_corpus", "drop_duplicates", "grouped_split", "store_features", "days_since_last", "rolling_sum_trailing", "ewma",
    "add_datepart", "join_df", "join_top_entities", "crosstab_sum", "describe", "proc_df", "best_split", "spearman_matrix",
    "pr_curve", "corpus_bleu", "item_bias_ranking", "random_forest", "sortish_batches",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from fernwick.plans.catalog import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else [q for q in HEADLINE if q in QUERIES]
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    # The first Spark job and the first Python worker are not part of any query.
    QUERIES["apply_parallel"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
