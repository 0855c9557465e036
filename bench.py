"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line. Each query runs once to warm up, then counts with its full result."""

from __future__ import annotations

import json
import os
import time

from graphloom.plans import catalog
from graphloom.session import local_session

HEADLINE = ("order_graph_edges", "vertex_projection", "sensitive_mask", "remote_local_reconcile", "link_history_current", "changed_targets", "potential_match_wildcard", "sql_inner_three_way", "team_productivity", "expiration_report", "not_seen_report", "payroll_report", "theta_match_cardinality", "dedupe_last_wins", "moving_average", "edge_counts", "event_fold_status", "log_line_parse", "state_machine_latest")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries: dict[str, float] = {}
    for name in HEADLINE:
        took = []
        for _ in range(3):
            began = time.time()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took.append(time.time() - began)
        queries[name] = round(sorted(took)[1], 3)
    print(json.dumps({"metric": "headline queries, median of three", "value": round(sum(queries.values()), 3), "unit": "sec", "queries": queries, "sf": os.path.basename(folder)}))
    spark.stop()


if __name__ == "__main__":
    main()
