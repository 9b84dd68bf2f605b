"""Command line: the three entries of the reference, over raw extracts.

    python -m reelspark build     --raw DIR --base DIR [--format csv|parquet] [--namespace dev]
                                  [--full-refresh] [--freshness] [--max-rejects SHARE]
    python -m reelspark snapshot  --raw DIR --base DIR --run-ts 2024-05-01T00:00:00
    python -m reelspark freshness --raw DIR

``--raw`` holds one folder (or file) per source: raw_movies, raw_ratings,
raw_tags, raw_genome_scores, raw_genome_tags, in the reference's raw column
names and types (epoch seconds for the timestamps). ``--seed`` overrides the
packaged genre taxonomy with a CSV on shared storage. A CSV row that does not
fit its schema fails the run, unless ``--max-rejects`` allows a share of them:
then the extracts are landed under ``BASE/landed`` first, with the rejects
beside them. Exit code 1 when a check, the freshness gate or that share fails.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from .session import build_session
from .sources import raw as rawsrc
from .sources import seeds
from .sources.freshness import Freshness, StaleSourceError, freshness_gate, source_freshness

# Sources whose freshness is checked; the genome tables are disabled, as in the reference.
FRESHNESS_DISABLED = ("raw_genome_scores", "raw_genome_tags")


def _freshness(args) -> dict[str, Freshness]:
    base = args.raw.rstrip("/")
    return {n: (Freshness(f"{base}/{n}", None, None, args.format) if n in FRESHNESS_DISABLED
                else Freshness(f"{base}/{n}", fmt=args.format)) for n in rawsrc.RAW_SCHEMAS}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="reelspark")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("build", "snapshot", "freshness"):
        s = sub.add_parser(name)
        s.add_argument("--raw", required=True)
        s.add_argument("--format", default="csv", choices=("csv", "parquet"))
        if name != "freshness":
            s.add_argument("--base", required=True)
            s.add_argument("--namespace", default="dev")
            s.add_argument("--seed", default=None)
    sub.choices["build"].add_argument("--full-refresh", action="store_true")
    sub.choices["build"].add_argument("--freshness", action="store_true")
    sub.choices["build"].add_argument("--max-rejects", type=float, default=None)
    sub.choices["snapshot"].add_argument("--run-ts", required=True)
    args = p.parse_args(argv)

    spark = build_session()
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if args.cmd == "freshness":
        report = source_freshness(spark, _freshness(args), now)
        for r in report.collect():
            print(json.dumps(r.asDict(), default=str))
        try:
            freshness_gate(report)
        except StaleSourceError as e:
            print(f"stale: {e}", file=sys.stderr)
            return 1
        return 0

    from .operators.checks import CheckFailed
    from .plans.pipeline import Pipeline
    rejected = {}
    if getattr(args, "max_rejects", None) is not None and args.format == "csv":
        at = f"{args.base.rstrip('/')}/landed/{now:%Y%m%dT%H%M%S%f}"
        try:
            landed = {n: rawsrc.land(spark, f"{args.raw.rstrip('/')}/{n}", s, f"{at}/{n}", args.max_rejects) for n, s in rawsrc.RAW_SCHEMAS.items()}
        except rawsrc.TooManyRejects as e:
            print(f"nothing built: {e}", file=sys.stderr)
            return 1
        srcs, rejected = {n: x.rows for n, x in landed.items()}, {n: x.n_rejected for n, x in landed.items() if x.n_rejected}
    else:
        srcs = {n: rawsrc.read_raw(spark, args.raw, n, fmt=args.format) for n in rawsrc.RAW_SCHEMAS}
    groups = (seeds.read_seed_csv(spark, args.seed) if args.seed else seeds.load_seed(spark))
    pipe = Pipeline(spark, args.base, args.namespace, srcs, groups,
                    freshness=_freshness(args) if getattr(args, "freshness", False) else None)
    if args.cmd == "snapshot":
        try:
            version = pipe.snapshot_movies(dt.datetime.fromisoformat(args.run_ts))
        except CheckFailed as e:
            print(f"snapshot not published: {e}", file=sys.stderr)
            return 1
        print(json.dumps({"snap_movies": version}))
        return 0
    try:
        res = pipe.run(full_refresh=args.full_refresh, now=now)
    except StaleSourceError as e:
        print(f"stale source, nothing built: {e}", file=sys.stderr)
        return 1
    print(json.dumps({"published": res.published, "failed": res.failed, "skipped": res.skipped,
                      "warnings": res.warnings, "rejected": rejected}, default=str))
    return 0 if res.ok else 1


if __name__ == "__main__":
    sys.exit(main())
