"""Times the headline queries and prints one line of JSON.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the number of local cores. A query is
built and its whole result computed, without being kept; the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import re
import time

from twinloom.plans.queries import QUERIES
from twinloom.session import build_session

HEADLINE = [
    "q_search", "q_follow", "q_last_stored", "q_graph_pattern", "q_pattern_count", "q_publish",
    "q_document_status", "q_describe_lookup", "q_twin_upsert", "q_twin_parse", "q_jsonld_quads",
    "q_chunk_join", "q_follow_snapshot_live", "q_follow_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
        # Small results of a shuffle still keep all cores busy.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").collect()

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {name: round(min(run(name), run(name)), 3) for name in HEADLINE}
    scale = re.search(r"sf([0-9.]+)/?$", sf_dir)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": float(scale.group(1)) if scale else sf_dir,
    }))


if __name__ == "__main__":
    main()
