"""Command line.

    python -m martwright pipeline --extracts DIR --out DIR
        full run over the ``;`` extracts: ingest, validate, publish, build,
        write the ten question results, enforce the gates, write the run log

    python -m martwright tables --sf-dir DIR --out DIR
        the same build over the parquet driver tables; writes the question
        results and the gate report (reported, not enforced: the stand-in
        data has known violations)
"""

from __future__ import annotations

import argparse
import json

from martwright.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="martwright")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("pipeline", help="run over the source extracts")
    p.add_argument("--extracts", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--run-id", default=None, help="of a broken run, to go on behind its last proven table")
    t = sub.add_parser("tables", help="run over the parquet driver tables")
    t.add_argument("--sf-dir", required=True)
    t.add_argument("--out", required=True)
    for s in (p, t):
        s.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    args = parser.parse_args(argv)
    spark = build_session(master=args.master) if args.master else build_session()
    try:
        print(json.dumps(run(spark, args), default=str))
    finally:
        spark.stop()


def run(spark, args) -> dict:
    if args.command == "pipeline":
        from martwright.plans.pipeline import run_pipeline

        result = run_pipeline(spark, args.extracts, args.out, run_id=getattr(args, "run_id", None))
        return {"run_dir": result["run_dir"], "counts": result["counts"]}
    else:
        from martwright.plans.pipeline import question_frames, write_result
        from martwright.plans.reports import dq_report, row_counts
        from martwright.plans.warehouse import warehouse_for

        wh = warehouse_for(spark, args.sf_dir)
        out = args.out.rstrip("/")
        for name, df in question_frames(wh).items():
            write_result(df, f"{out}/results/{name}.csv")
        write_result(row_counts(wh), f"{out}/results/row_counts.csv")
        write_result(dq_report(wh), f"{out}/results/quality_gates.csv")
        return {"results": f"{out}/results"}


if __name__ == "__main__":
    main()
