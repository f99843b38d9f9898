"""Command line: ``python -m changefold run --base-path PATH [options]``.

Builds a session, creates missing bronze/silver tables, and runs the raw,
silver and gold queries (continuously, or once over what is there with
``--available-now``).
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import fields

from changefold.session import build_session
from changefold.streaming import jobs
from changefold.streaming.config import StreamConfig


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="changefold")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="run the raw, silver and gold queries")
    run.add_argument("--base-path", required=True)
    run.add_argument("--kafka-bootstrap-servers")
    run.add_argument("--message-path", help="Parquet message files when there is no broker")
    run.add_argument("--tables", default="orders,customers,products,order_items")
    # Options that are not given leave the environment's value (CHANGEFOLD_<NAME>), or else the default.
    run.add_argument("--available-now", action=argparse.BooleanOptionalAction, help="process what is there, then stop")
    run.add_argument("--raw-fanout", action=argparse.BooleanOptionalAction, help="one raw query for all topics")
    run.add_argument("--dedup-horizon", help='drop redelivered messages for so long, as "1 day"')
    run.add_argument("--compact-every", type=int, help="fold the silver log into a new base every so many batches")
    run.add_argument("--purge-deleted-after-days", type=int, help="compactions drop rows soft-deleted so long ago")
    run.add_argument("--maintain-kpis", action=argparse.BooleanOptionalAction, help="keep the KPI counts with gold")
    run.add_argument("--jdbc-url", help="database of the serving table")
    run.add_argument("--jdbc-table")
    run.add_argument("--metrics-path")
    run.add_argument("--master", help="default: spark-submit's, or else local")
    args = ap.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    spark = build_session(master=args.master)
    names = {f.name for f in fields(StreamConfig)}
    cfg = StreamConfig.from_env(**{k: v for k, v in vars(args).items() if k in names})
    tables = tuple(t for t in args.tables.split(",") if t)
    jobs.bootstrap_all(spark, cfg, tables)
    jobs.run_all(spark, cfg, tables, metrics_path=args.metrics_path)


if __name__ == "__main__":
    main()
