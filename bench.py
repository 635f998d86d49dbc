"""Headline-query timings.  Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3)
Each query is fully executed with the ``noop`` sink (no collect to the driver); the
median of BENCH_RUNS warm runs is reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bourse.plans import catalog  # noqa: E402
from bourse.session import local_session  # noqa: E402
from bourse import schemas  # noqa: E402
from bourse.sources.tables import M1_SLIDE, M1_WINDOW  # noqa: E402
from bourse.streaming import registered  # noqa: E402
from bourse.streaming.jobs import run_matcher  # noqa: E402

HEADLINE = [
    "q_match_trades",
    "q_match_whale",  # one very large buy per instrument: should cost about what q_match_trades does
    "q_remaining",
    "q_sma_top",
    "q_profit_top",
    "q_validate_accept",
    "q_validate_reject",
    "q_order_book",
    "q_live_orders",
    "q_decode_orders",
    "q_sma_lineitem",
    "q_profit_lineitem_top",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus))
    # warm-up: JVM, parquet footers, codegen caches, the matcher's operators
    for name in ("q_live_orders", "q_match_trades"):
        catalog.BATCH_QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    out = {}
    for name in HEADLINE:
        fn = catalog.BATCH_QUERIES[name]
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            times.append(dt)
        out[name] = round(statistics.median(times), 3)
    # streaming matcher: orders landed as time-ordered files (not timed), then one
    # availableNow run of the stream (timed): release closed books, match, write
    orders = catalog.m1_orders(spark, sf_dir)
    n_orders = orders.count()
    base = registered.land_in_time_order(spark, orders, "order_time", "bench-orders")
    registered._end_of_stream(spark, base, orders)
    t0 = time.perf_counter()
    q = run_matcher(
        registered._stream(spark, base, schemas.ORDER),
        out_dir=f"{base}/out",
        checkpoint=f"{base}/checkpoint",
        window=M1_WINDOW,
        slide=M1_SLIDE,
        trigger={"availableNow": True},
    )
    q.awaitTermination()
    stream_s = time.perf_counter() - t0
    n_trades = spark.read.parquet(f"{base}/out/trades").count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(out.values()), 3),
                "unit": "sec",
                "queries": out,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "stream": {
                    "query": "run_matcher (availableNow over landed M1 orders)",
                    "sec": round(stream_s, 3),
                    "orders": n_orders,
                    "trades": n_trades,
                    "orders_per_sec": round(n_orders / stream_s, 1),
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
