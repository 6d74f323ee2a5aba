"""Command line: build the model graph, or export a report as CSV.

    python -m rankforge build --raw /landing --out /warehouse/marts --as-of 2026-12-07
    python -m rankforge export --marts /warehouse/marts --report top15 --week 2026-12-06 --csv /out/top15
    python -m rankforge export --marts /warehouse/marts --sql "select ..." --csv /out/q
    python -m rankforge land --raw /landing --table pageviews --source /drop/2026-12-06 --batch-id 2026-12-06
    python -m rankforge view --marts /warehouse/marts --name top_books --sql "select ..."

``build`` reads the four raw landing tables, commits the table models as a new version of the
warehouse under ``--out``, registers every model as a temp view and prints the check summary
(with ``--fail-on-check`` a version with failing checks is not committed).
``export`` attaches the current version and writes a report or
any SQL over its tables, view models and stored views to CSV. ``land`` appends a batch that
may be repeated; ``view`` stores a view.
"""

from __future__ import annotations

import argparse
import sys

from rankforge.operators import reports
from rankforge.plans.graph import ModelGraph, build
from rankforge.session import get_session
from rankforge.sources.io import as_view, export_csv, land_append, read_all_raw
from rankforge.sources.schemas import RAW_TABLES
from rankforge.sources.warehouse import Warehouse

REPORTS = {
    "top15": lambda sc, week: reports.top_k_for(sc, 15, week),
    "movers_up": reports.movers_up,
    "movers_down": reports.movers_down,
    "new_entries": reports.new_entries,
    "kpi": reports.weekly_kpi,
}


def _build(args) -> int:
    spark = get_session(args.master)
    options = {"as_of": args.as_of, "strip_decimal": args.strip_decimal, "collapse_ws": args.collapse_ws,
               "null_authors_as_text": args.null_authors_as_text, "dedup_latest": args.dedup_latest, "wide_sums": args.wide_sums}
    graph = ModelGraph(read_all_raw(spark, args.raw, args.format), **options)
    models, summary = build(graph, out_root=args.out, threads=args.threads, commit_failed=not args.fail_on_check,
                            source={"raw": args.raw, "format": args.format, "options": options})
    for name, df in models.items():
        as_view(df, name)
    results = sorted(summary.collect(), key=lambda r: r["check_name"])  # one row per declared check
    for r in results:
        print(f"{r['status']}  {r['failures']:>10}  {r['check_name']}")
    failed = sum(r["status"] == "FAIL" for r in results)
    return 1 if (failed and args.fail_on_check) else 0


def _export(args) -> int:
    spark = get_session(args.master)
    Warehouse(spark, args.marts).attach()
    if args.sql:
        df = spark.sql(args.sql)
    else:
        df = REPORTS[args.report](spark.table("weekly_scorecard"), args.week)
    export_csv(df, args.csv, single_file=args.single_file)
    return 0


def _land(args) -> int:
    spark = get_session(args.master)
    rows = spark.read.schema(RAW_TABLES[args.table]).format(args.format).load(args.source)
    done = land_append(rows, args.raw, args.table, batch_id=args.batch_id)
    print("landed" if done else "landed before")
    return 0


def _view(args) -> int:
    Warehouse(get_session(args.master), args.marts).create_view(args.name, args.sql)
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="rankforge")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--raw", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--as-of", required=True)
    b.add_argument("--format", default="parquet")
    b.add_argument("--threads", type=int, default=4)
    b.add_argument("--strip-decimal", action="store_true")
    b.add_argument("--collapse-ws", action="store_true")
    b.add_argument("--null-authors-as-text", action="store_true")
    b.add_argument("--dedup-latest", action="store_true")
    b.add_argument("--wide-sums", action="store_true")
    b.add_argument("--fail-on-check", action="store_true")
    n = sub.add_parser("land")
    n.add_argument("--raw", required=True)
    n.add_argument("--table", required=True, choices=sorted(RAW_TABLES))
    n.add_argument("--source", required=True)
    n.add_argument("--batch-id")
    n.add_argument("--format", default="parquet")
    v = sub.add_parser("view")
    v.add_argument("--marts", required=True)
    v.add_argument("--name", required=True)
    v.add_argument("--sql", required=True)
    e = sub.add_parser("export")
    e.add_argument("--marts", required=True)
    e.add_argument("--csv", required=True)
    e.add_argument("--report", choices=sorted(REPORTS))
    e.add_argument("--week")
    e.add_argument("--sql")
    e.add_argument("--single-file", action="store_true")
    args = p.parse_args(argv)
    return {"build": _build, "export": _export, "land": _land, "view": _view}[args.cmd](args)


if __name__ == "__main__":
    sys.exit(main())
