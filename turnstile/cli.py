"""Command-line jobs: ``python -m turnstile <job> ...`` (or ``spark-submit``).

    dump      --source DIR --out DIR --from TS --to TS [--variant full|day]
              --email-suffix S --profile-id P
    accounts  --source DIR --out DIR --from TS --to TS
    sync      --source DIR --state DIR [--now TS] [--transport module:function]
              [--lookback-minutes N]

Sources are ``<source>/<table>.parquet`` folders with the ticketing schemas.
Products are written to ``<out>/<product>`` (Parquet, overwrite).  The session
comes from the environment (cluster settings, ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from turnstile.operators.identity import ClassMinima
from turnstile.operators.scope import ticket_scope
from turnstile.plans import accounts as A
from turnstile.plans.dump import dump
from turnstile.plans.products import UserProfile
from turnstile.plans.sync import sync
from turnstile.session import ensure_checkpoint_dir, scratch_frames
from turnstile.sources.schemas import SOURCE_SCHEMAS
from turnstile.sources.sinks import write_folder
from turnstile.sources.tables import load_parquet


def _transport(spec: str | None):
    if not spec:
        return None
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="turnstile")
    sub = p.add_subparsers(dest="job", required=True)
    d = sub.add_parser("dump")
    a = sub.add_parser("accounts")
    s = sub.add_parser("sync")
    for q in (d, a, s):
        q.add_argument("--source", required=True)
    for q in (d, a):
        q.add_argument("--out", required=True)
        q.add_argument("--from", dest="lo", required=True)
        q.add_argument("--to", dest="hi", required=True)
    d.add_argument("--variant", choices=["full", "day"], default="full")
    d.add_argument("--email-suffix", required=True)
    d.add_argument("--profile-id", required=True)
    s.add_argument("--state", required=True)
    s.add_argument("--now")
    s.add_argument("--transport")
    s.add_argument("--lookback-minutes", type=int)
    s.add_argument("--delta", action="store_true", help="leave out rows that an accepted run sent")
    s.add_argument("--stable-ids", action="store_true", help="canonical ids over all runs, kept with the state")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"turnstile-{args.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    src = load_parquet(spark, args.source, SOURCE_SCHEMAS)
    if args.job == "dump":
        with scratch_frames(spark):
            products = dump(src, args.lo, args.hi,
                            UserProfile(email_suffix=args.email_suffix, profile_id=args.profile_id),
                            variant=args.variant)
            # independent products of one written working set: submit the
            # writes together so their jobs share the cluster
            with ThreadPoolExecutor(max_workers=4) as pool:
                for f in [pool.submit(write_folder, df, f"{args.out.rstrip('/')}/{name}")
                          for name, df in products.items()]:
                    f.result()
        print(json.dumps({"job": "dump", "products": sorted(products)}))
    elif args.job == "accounts":
        accounts = A.accounts(src, args.lo, args.hi)
        write_folder(accounts, f"{args.out.rstrip('/')}/accounts")
        accounts = spark.read.parquet(f"{args.out.rstrip('/')}/accounts")   # orders read it
        write_folder(A.orders(src, args.lo, args.hi, accounts), f"{args.out.rstrip('/')}/orders")
        write_folder(A.contacts_enriched(src, ticket_scope(src, args.lo, args.hi)),
                     f"{args.out.rstrip('/')}/contacts")
        print(json.dumps({"job": "accounts", "products": ["accounts", "contacts", "orders"]}))
    else:
        now = dt.datetime.fromisoformat(args.now) if args.now else dt.datetime.now()
        lookback = dt.timedelta(minutes=args.lookback_minutes) if args.lookback_minutes else None
        minima = ClassMinima(spark, f"{args.state.rstrip('/')}/minima") if args.stable_ids else None
        report = sync(spark, src, args.state, now, _transport(args.transport), lookback=lookback, delta=args.delta, minima=minima)
        print(json.dumps({"job": "sync", "from": str(report.lo), "to": str(report.hi),
                          "counts": report.counts, "failed_batches": report.failed_batches,
                          "state": report.state_path}))
    return 0
