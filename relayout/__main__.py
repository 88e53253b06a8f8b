"""Run the relayout job from the command line (``python -m relayout``, or ``run_relayout.py`` under
spark-submit).

    python -m relayout --source raw.visits --target by_page.visits \\
        --where visit_day=2024-02-03 --where-int visit_hour=3 [--expr visit_day="current_date() - 1"]

``--where`` values are text; ``--where-int`` values are whole numbers; ``--expr`` values are SQL
expressions. The session comes from the cluster's configuration (``getOrCreate``).
"""

from __future__ import annotations

import argparse
import sys

from .functions.predicates import Expr
from .operators.job import relayout
from .plans.distribution import NONE, REBALANCE, SALTED, SIZED


def _pairs(items: list[str], convert) -> dict:
    out = {}
    for item in items:
        name, sep, value = item.partition("=")
        if not sep or not name:
            raise SystemExit(f"expected column=value, got {item!r}")
        out[name] = convert(value)
    return out


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="relayout", description="Copy matching rows into a differently partitioned table.")
    p.add_argument("--source", required=True, help="source catalog table, e.g. db.table")
    p.add_argument("--target", required=True, help="target catalog table (partitioned)")
    p.add_argument("--where", action="append", default=[], metavar="COL=TEXT")
    p.add_argument("--where-int", action="append", default=[], metavar="COL=N")
    p.add_argument("--expr", action="append", default=[], metavar="COL=SQL")
    p.add_argument("--strict", action="store_true", help="target columns must match by name, type and comment")
    p.add_argument("--distribution", choices=[SIZED, REBALANCE, SALTED, NONE], default=SIZED)
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    predicates = {**_pairs(args.where, str), **_pairs(args.where_int, int), **_pairs(args.expr, Expr)}
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("relayout").getOrCreate()
    relayout(spark, args.source, args.target, predicates, strict=args.strict, distribution=args.distribution,
             reread=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
