"""Benchmark the headline jobs.

Runs on local[$BENCH_CPUS] against $BENCH_SF_DIR (default /root/testdata/sf0.1)
and prints one JSON line. Each query is executed in full through the no-op
sink (no collect to the driver). ``ledger_build`` is the one-time cost of the
checked small dimensions and the account table; every query is then timed
three times and its median reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from condoledger.registry import QUERIES  # noqa: E402
from condoledger.session import local_session  # noqa: E402
from condoledger.sources.ledger import ledger  # noqa: E402

HEADLINE = ["r3_weekly_cash_flow", "r1_financial_status", "j2_recompute_accounts", "l7_payments_ok",
            "l7_payments_rejects", "r7_delinquent_owners", "r9_monthly_status", "r10_statement",
            "k3_amount_flexible", "r8_days_between_payments"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus))
    t0 = time.time()
    lg = ledger(spark, sf_dir).materialize()   # store the ledger state once
    times = {"ledger_build": round(time.time() - t0, 3)}
    for name in HEADLINE:
        if name not in QUERIES:
            continue
        runs = []
        for _ in range(3):
            t = time.time()
            run(QUERIES[name](spark, sf_dir))
            runs.append(time.time() - t)
        times[name] = round(statistics.median(runs), 3)
    # L7 end to end (read the landed CSV, parse, reconcile, merge), no cached load
    from condoledger.plans import ingest as I
    raw = I.payments_from_landed_csv(lg)
    n_raw = raw.count()
    runs = []
    for _ in range(3):
        t = time.time()
        run(I.load_payments(lg, raw).ok)
        runs.append(time.time() - t)
    times["l7_load_and_reconcile"] = round(statistics.median(runs), 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus,
                      "l7_rows_per_sec": round(n_raw / times["l7_load_and_reconcile"])}))


if __name__ == "__main__":
    main()
