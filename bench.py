"""Headline-query benchmark.

Runs the headline catalogue queries over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}.

Each query is executed in full with the ``noop`` sink (every row produced,
nothing collected to the driver). Before timing, three queries run once on the
smallest test tables (untimed) so that JVM class loading, JIT warm-up and the
Python worker start are not charged to the first measured query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top_links_all", "links_view", "links_nested", "edge_import", "import_report",
    "unit_view", "text_search_all", "distinct_counts", "chapter_gaps", "verse_gaps",
    "insert_ignore", "upsert_last", "dense_ids", "parse_line", "render_linked",
    "render_book_index", "vec_topk_batch", "vec_topk_batch_blas", "vec_filtered", "answer",
    "themes", "vec_ann_allcells", "vec_topk", "text_query_search", "hash_encode",
    "kmeans_sizes", "ann_recall", "document_sink", "stream_ingest", "index_roundtrip",
    "lsh_recall", "index_updates", "parse_chunked", "import_batches", "text_search_indexed",
    "sql_top_links", "ledger_ids",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from corpuslink.plans.registry import load_all
    from corpuslink.session import get_spark

    spark = get_spark(f"local[{cpus}]", app="corpuslink-bench",
                      shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": "16g"})
    catalogue = load_all()
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ("top_links_all", "vec_topk_batch", "vec_topk_batch_blas"):
        catalogue[name][0](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times, errors = {}, {}
    for name in names:
        fn = catalogue[name][0]
        t0 = time.perf_counter()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # keep the JSON line; report the failure
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
