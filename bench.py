"""Wall time of the headline queries on stored logs; prints one JSON line.

Setup (deriving and storing the log table) is timed apart, as ``setup``. Each query runs once to warm up and then
three times; the median counts.
"""

import json
import os
import statistics
import sys
import time

from emberlog.operators import aggregates as G
from emberlog.operators import alerts as A
from emberlog.operators import features as Fe
from emberlog.operators import parsing as P
from emberlog.operators import search as S
from emberlog.operators.models.ecod import fit_ecod
from emberlog.operators.models.forest import fit_decision, fit_forest
from emberlog.operators.models.hbos import fit_hbos
from emberlog.plans.queries import FEATURE_INPUT
from emberlog.plans.queries_parsing import raw_messages
from emberlog.plans.training import prepare
from emberlog.schema import MODEL_FEATURES
from emberlog.session import build_session, stage
from emberlog.sources.fixture import log_table


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", cpus, partitions=int(cpus))
    start = time.perf_counter()
    logs = log_table(spark, sf_dir)
    narrow = logs.select(*FEATURE_INPUT)
    as_of = S.latest_instant(logs)
    messages = stage(raw_messages(spark, sf_dir).repartition(int(cpus)), "messages")
    data = prepare(narrow)
    train = stage(data.train.select("us", "seq", *MODEL_FEATURES), "train")
    forest = fit_decision(fit_forest(train), train)
    setup = time.perf_counter() - start

    def sink(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    queries = {
        "search": lambda: S.search_logs(logs, level="ERROR", min_response_ms=100).rows.collect(),
        "recent_stats": lambda: G.recent_stats(logs).collect(),
        "service_levels": lambda: G.service_levels(logs).collect(),
        "timeline": lambda: G.timeline(logs, 1, as_of).collect(),
        "latency_profile": lambda: G.latency_profile(logs).collect(),
        "service_report": lambda: G.service_report(logs, 1, as_of).collect(),
        "anomaly_stats": lambda: G.anomaly_stats(logs, as_of).collect(),
        "parse": lambda: P.pipeline_counters(P.parse_logs(messages)).collect(),
        "batch_features": lambda: sink(Fe.batch_features(narrow)),
        "serving_features": lambda: sink(Fe.serving_features(narrow)),
        "alerts": lambda: A.alerts(logs).collect(),
        "forest_fit": lambda: fit_forest(train),
        "forest_score": lambda: sink(forest.decide(data.scaled)),
        "hbos_fit": lambda: fit_hbos(train),
        "ecod_fit": lambda: fit_ecod(train),
    }
    took = {}
    for name, call in queries.items():
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            call()
            times.append(time.perf_counter() - start)
        took[name] = round(statistics.median(times[1:]), 3)
        print(f"{name:18} {took[name]:8.3f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "setup": round(setup, 3), "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "rows": logs.count(),
    }))


if __name__ == "__main__":
    main()
