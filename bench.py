"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full (written to the no-op sink, so every row is
produced); the wall time per query is reported.  A query over the time limit ($BENCH_QUERY_LIMIT
seconds) is cancelled.  Prints one JSON line, also when it is ended early.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from graphweave.plans.catalog import QUERIES  # noqa: E402
from graphweave.session import build_session  # noqa: E402

# All registered queries of the linking library, in the order of its job.
HEADLINE = list(QUERIES)


# A query that takes longer is cancelled and listed among the errors.
LIMIT = float(os.environ.get("BENCH_QUERY_LIMIT", "180"))


def report(times: dict, errors: dict, sf_dir: str) -> None:
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf}
    if errors:
        out["errors"] = errors
    print(json.dumps(out), flush=True)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    times: dict[str, float] = {}
    errors: dict[str, str] = {}

    def stop(*_) -> None:
        # ended from outside: what has been measured is still reported
        errors["bench"] = "ended before the last query"
        report(times, errors, sf_dir)
        os._exit(1)

    for sig in (signal.SIGINT, signal.SIGTERM):
        signal.signal(sig, stop)
    for name in (only or HEADLINE):
        fn = QUERIES[name]
        t0 = time.time()
        over = threading.Event()

        def cancel(over=over) -> None:
            # again and again: a query may run many jobs
            while not over.is_set():
                spark.sparkContext.cancelAllJobs()
                over.wait(1)

        timer = threading.Timer(LIMIT, cancel)
        timer.daemon = True
        timer.start()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as ex:  # noqa: BLE001
            late = time.time() - t0 >= LIMIT
            errors[name] = f"cancelled after {LIMIT:.0f} s" if late else str(ex)[:200]
        finally:
            timer.cancel()
            over.set()
        print(f"# {name}: {times.get(name, 'ERROR')}", file=sys.stderr, flush=True)
    report(times, errors, sf_dir)


if __name__ == "__main__":
    main()
