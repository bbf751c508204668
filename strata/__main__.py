"""Command line: run the pipeline stages as Spark jobs.

    python -m strata medallion --source <dir> --root <path>
    python -m strata silver --bronze <path> --root <path> [--errors ignore --decoded-only none]
    python -m strata gold --root <path> [--set user_metrics|activity|all]

``--root`` is the lakehouse location (any Hadoop path); by default a fresh
folder under ``spark.checkpoint.dir``. Prints the verification table.
"""

from __future__ import annotations

import argparse

from strata.plans import pipeline
from strata.session import get_session, scratch_path
from strata.sources.lakehouse import Lakehouse


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("medallion", help="land the test tables, build silver and gold")
    m.add_argument("--source", required=True)
    s = sub.add_parser("silver", help="bronze layout → silver tables")
    s.add_argument("--bronze", required=True)
    s.add_argument("--errors", default="strict", choices=["strict", "ignore"])
    s.add_argument("--decoded-only", default="valid", choices=["valid", "reference", "none"])
    g = sub.add_parser("gold", help="silver tables → gold tables")
    g.add_argument("--set", default="all", choices=["user_metrics", "activity", "all"])
    for p in (m, s, g):
        p.add_argument("--root", default=None)
        p.add_argument("--master", default=None)
        p.add_argument("--load-ts", default=None)
        p.add_argument("--as-of", default=None)
        p.add_argument("--run-ts", default=None)
    a = ap.parse_args(argv)

    spark = get_session(a.master)
    root = a.root or scratch_path(spark, "run")
    if a.cmd == "medallion":
        out = pipeline.run_medallion(spark, a.source, root, a.load_ts, a.as_of, a.run_ts)
    elif a.cmd == "silver":
        out, report = pipeline.run_silver(spark, a.bronze, Lakehouse(spark, root), a.load_ts,
                                          a.as_of, errors=a.errors, decoded_only=a.decoded_only)
        for name, ok, note in report.stages:
            print(f"{'ok ' if ok else 'ERR'} {name} {note}")
    else:
        lake = Lakehouse(spark, root)
        names = {"user_metrics": pipeline.GOLD_USER_METRICS,
                 "activity": pipeline.GOLD_ACTIVITY,
                 "all": pipeline.GOLD_USER_METRICS + pipeline.GOLD_ACTIVITY}[a.set]
        out = pipeline._run_gold(lake, names, a.run_ts)
    out.show(truncate=False)
    print(f"lakehouse root: {root}")


if __name__ == "__main__":
    main()
