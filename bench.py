"""Headline queries, timed one by one; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores.  Each result
is consumed in full by a sink that keeps nothing, so no time goes to the
driver, and each query is run once to warm up and once for its time.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from tarnwork.catalog import registered
from tarnwork.session import build_session

HEADLINE = (
    "wrk05_revenue_join", "agg02_group_by_dsl", "join01_logical_join", "join03_shuffled_hash", "join18_cogroup",
    "set04_except_keeping_duplicates", "srt01_order_by", "srt08_top_k", "srt28_sliding", "srt29_skewed_group_by",
    "srt29_skewed_numbering", "agg28_combine_by_key", "agg36_group_by_key", "hf093_ngrams", "hf098_percentile",
    "wrk01_word_count", "wrk06_link_counts", "src02_json_inferred", "str24_reduce_by_key_and_window",
    "str26_update_state_by_key", "str30_join", "str45_stateful_word_count", "gra14_aggregate_messages", "gra29_pagerank",
    "gra31_connected_components", "gra33_triangle_counts", "gra35_shortest_paths", "ml08_tf_idf", "ml12_kmeans",
    "ml14_als", "ml30_roc_curve", "ml38_gramian", "ml39_svd",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = tuple(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    spark = build_session("bench", cores=cpus)
    queries = registered()
    times: dict[str, float] = {}
    for name in HEADLINE:
        if only and not name.startswith(only):
            continue
        for attempt in ("warm", "timed"):
            start = time.perf_counter()
            queries[name](spark, directory).write.format("noop").mode("overwrite").save()
            spark.catalog.clearCache()
            if attempt == "timed":
                times[name] = round(time.perf_counter() - start, 3)
    sf = Path(directory).name.removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
