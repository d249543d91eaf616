"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query runs once to warm up and
then ``BENCH_RUNS`` times; the best time counts. Results are fully computed and thrown away.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from rondel.plans import queries_text
from rondel.plans.catalog import QUERIES
from rondel.session import local_session

LOOKUP = "index_lookup_stored"  # on an index that is written before the clock starts
HEADLINE = [
    "entity_period_stats", "category_month_stats", "outcome_enrich", "silver_clean", "contract_report",
    "partitioned_write", "compact_table", "tumbling_agg", "stream_parquet_sink", "corpus_build", "tokenize",
    "inverted_index_list", "inverted_index_set", "index_lookup", "index_top_terms", "graph_edges", "pagerank",
    "pagerank_both", "entity_features", "silhouette", "kmeans_sweep", "curate_narrative", "curate_text",
    "curation_quality",
    LOOKUP,
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    shared = tempfile.mkdtemp(prefix="rondel-bench-")
    spark = local_session("rondel-bench", cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          **{"spark.checkpoint.dir": f"file:{shared}"})
    seconds = {}
    prepared = {LOOKUP: queries_text.stored_index(spark, sf_dir)} if LOOKUP in names else {}
    for name in names:
        times = []
        run = (lambda: queries_text.lookup_words(spark, prepared[LOOKUP])) if name == LOOKUP else (
            lambda name=name: QUERIES[name](spark, sf_dir))
        for _ in range(runs + 1):
            started = time.perf_counter()
            run().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(min(times[1:] or times), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
