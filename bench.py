"""Time the headline queries: ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.

Prints one JSON line. Every query runs to its last row into Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quillmill.plans.catalog import REGISTRY  # noqa: E402
from quillmill.session import local_session  # noqa: E402

HEADLINE = [
    "find_similar_papers", "search_many", "nearest_chunks", "merge_hits", "resolver_chain", "content_dedup", "unique_urls",
    "rank_titles", "top_titles_per_query", "chunks_4000", "section_slices", "prompt_table", "html_text", "assembled_turns",
    "extractive_summaries", "document_keywords", "embed_sections", "upsert_papers", "upsert_summaries", "insert_edges",
    "cascade_delete", "fk_violations", "work_tree", "all_out_neighbours", "ingest_state", "stage_dashboard",
    "stream_unique_urls", "stream_status",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    run = lambda name: REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    # one round over the same queries first: start-up of JVM and Python workers is no part of a query
    for name in HEADLINE:
        run(name)
    spent = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(name)
        spent[name] = round(time.perf_counter() - start, 3)
    titles = spark.read.parquet(f"{folder}/documents.parquet").count()
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(spent.values()), 3),
        "unit": "sec",
        "queries": spent,
        "sf": Path(folder).name.removeprefix("sf"),
        "titles_ranked_per_sec": round(titles / spent["rank_titles"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
