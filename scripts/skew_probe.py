"""Skew probe: the working set and roll-ups when one contact holds a third of
all tickets (plus the walk-in sales without a contact).

Builds the driver role sources, then reassigns every third ticket to one hot
contact, runs the working set, ticket and payment roll-ups, and prints the
final-plan evidence: AQE skew-join splits (thresholds lowered so that
sf0.1-sized partitions count as large) and the per-stage max/median task
times from Spark's event log in a scratch folder.
Usage: skew_probe.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from turnstile.plans import accounts as A  # noqa: E402
from turnstile.plans import products as P  # noqa: E402
from turnstile.plans.working_set import build_working_set  # noqa: E402
from turnstile.registry import HI, LO  # noqa: E402
from turnstile.sources.roles import driver_sources  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    events = tempfile.mkdtemp(prefix="skew-events-", dir="/tmp")
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256k")
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
             .config("spark.eventLog.dir", events)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "16g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    src = dict(driver_sources(spark, sf_dir))
    hot = F.col("ticode") % 3 == 0
    src["tickets"] = src["tickets"].withColumn(
        "timailinglist", F.when(hot, F.lit(1).cast("bigint")).otherwise(F.col("timailinglist")))
    # the hot contact is a named client, so it reaches the named account branch
    src["clients"] = src["clients"].withColumn(
        "cltfirstname", F.when(F.col("cltcode") == 1, F.lit("Hot")).otherwise(F.col("cltfirstname")))
    ws = build_working_set(src, LO, HI, keep_internal=True)
    share = ws.agg((F.sum(F.when(F.col("timailinglist") == 1, 1).otherwise(0)) / F.count("*"))
                   .alias("s")).first()["s"]
    results = {}
    accounts = A.accounts(src, LO, HI)
    for name, df in {"working_set": ws, "tickets": P.tickets(ws),
                     "payments": P.payments(ws, src), "accounts": accounts,
                     "orders": A.orders(src, LO, HI, accounts)}.items():
        t0 = time.perf_counter()
        rows = df.collect()
        results[name] = {"rows": len(rows), "sec": round(time.perf_counter() - t0, 2)}
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        results[name]["skew_join_splits"] = out.getvalue().count("isSkewJoin=true") + \
            out.getvalue().count("skewJoin=true")
    spark.stop()
    stages = {}
    for f in glob.glob(os.path.join(events, "*", "*")) + glob.glob(os.path.join(events, "*.*")):
        for line in open(f, errors="replace"):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if e.get("Event") == "SparkListenerTaskEnd":
                info = e["Task Info"]
                stages.setdefault(e["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
    worst = sorted(((max(v), statistics.median(v), len(v), k) for k, v in stages.items()
                    if len(v) >= 4), reverse=True)[:5]
    print(json.dumps({"hot_contact_share": round(share, 3), "results": results,
                      "slowest_stages_ms": [{"stage": s, "max": m, "median": md, "tasks": n}
                                            for m, md, n, s in worst]}, indent=1))


if __name__ == "__main__":
    main()
