"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of tables (default /root/testdata/sf0.1), BENCH_CPUS the local threads,
BENCH_QUERIES an optional comma-separated choice ("all" for every query).
"""

from __future__ import annotations

import json
import os
import time

from graphloom.catalog import QUERIES
from graphloom.session import build_session

HEADLINES = [
    "scan_nodes", "prop_eq_filter", "contains_filter", "fragment_compose", "hop_any", "hop_typed", "path_accessors",
    "path_assemble", "pair_lookup", "id_to_prop", "attach_metric", "collect_group", "result_set", "result_map", "top_k",
    "traverse", "parse_value", "prop_get_as", "decode_int", "decode_bigint", "decode_bigdecimal", "decode_uuid",
    "decode_localtime", "decode_list", "decode_pairs_map", "decode_product_named", "decode_union_by_field",
    "error_report", "udf_combine", "create_rels", "detach_delete", "atomic_publish", "roundtrip_types", "encode_mixed",
    "stream_decode", "stream_guarantee", "project_graph", "article_rank_top", "triangle_count", "local_clustering",
    "adamic_adar", "jaccard", "shortest_path",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    chosen = os.environ.get("BENCH_QUERIES")
    names = HEADLINES if not chosen else list(QUERIES) if chosen == "all" else chosen.split(",")
    spark = build_session("bench", f"local[{cpus}]", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{folder}/nation.parquet").count()  # start-up is not part of any query

    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
