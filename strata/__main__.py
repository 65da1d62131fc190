"""Command line (works with ``spark-submit`` as well)::

    python -m strata run --base s3://lake/football --leagues P --teams P \\
        --fixtures P --standings P [--run-ts 2024-01-01T06:00:00] [--line-delimited]
        [--keep-versions 3] [--calendar 2010-01-01 2026-12-31]
    python -m strata show --base s3://lake/football --layer gold --table agg_team_season
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from strata.plans.pipeline import DEFAULT_CALENDAR, run_pipeline
from strata.plans.store import LayerStore
from strata.session import build_session
from strata.sources.bronze import BRONZE_TABLES


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="land envelopes, merge silver, build gold")
    run.add_argument("--base", required=True)
    for e in BRONZE_TABLES:
        run.add_argument(f"--{e}", help=f"envelope file(s) for {e}")
    run.add_argument("--run-ts", help="ISO timestamp of the run (default: now, UTC)")
    run.add_argument("--line-delimited", action="store_true")
    run.add_argument("--keep-versions", type=int)
    run.add_argument("--incremental-silver", action="store_true",
                     help="merge only newly landed bronze rows into silver")
    run.add_argument("--calendar", nargs=2, default=list(DEFAULT_CALENDAR))
    show = sub.add_parser("show", help="print a published table")
    show.add_argument("--base", required=True)
    show.add_argument("--layer", choices=["bronze", "silver", "gold"], required=True)
    show.add_argument("--table", required=True)
    show.add_argument("--rows", type=int, default=20)
    args = ap.parse_args(argv)

    spark = build_session(app="strata")
    if args.cmd == "run":
        envelopes = {e: getattr(args, e) for e in BRONZE_TABLES if getattr(args, e)}
        run_ts = dt.datetime.fromisoformat(args.run_ts) if args.run_ts else None
        res = run_pipeline(spark, envelopes, args.base, run_ts, tuple(args.calendar),
                           args.line_delimited, args.keep_versions, args.incremental_silver)
        print(json.dumps(res))
    else:
        LayerStore(spark, args.base).read(args.layer, args.table).show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
