"""Command line for spark-submit: ``python -m ledgerline <command> ...``.

    run       validate, deduplicate and upsert one input (CSV or Parquet) into the target table
    report    write the report tables (header, KPIs, distribution, sample) of recorded runs
    reset     drop the target table
    generate  write a synthetic operations file (copies and errors included) as CSV
"""

from __future__ import annotations

import argparse
import json
import sys

from ledgerline.session import get_spark


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerline")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="run the reconciliation job on one input")
    r.add_argument("input")
    r.add_argument("--target", required=True, help="target table: a catalog name or a folder")
    r.add_argument("--runs", required=True, help="run-record folder")
    r.add_argument("--output", help="folder for the deduplicated CSV copy (default: beside the target)")
    r.add_argument("--format", choices=["csv", "parquet"], help="input format (default: by extension)")
    r.add_argument("--as-of", help="timestamp for the future-date rule and the load stamp (default: now)")
    r.add_argument("--checksum", type=float, help="expected control total of the amounts")
    r.add_argument("--pipeline-id")
    r.add_argument("--parts", type=int, default=16, help="buckets of a new target; a load rewrites those in which it updates rows")
    g = sub.add_parser("generate", help="write a synthetic operations CSV")
    g.add_argument("output")
    g.add_argument("--rows", type=int, default=10_000)
    g.add_argument("--duplicate-rate", type=float, default=0.05)
    g.add_argument("--error-rate", type=float, default=0.02)
    g.add_argument("--as-of", required=True)
    g.add_argument("--seed", type=int, default=42)
    rep = sub.add_parser("report", help="write report tables of recorded runs")
    rep.add_argument("--runs", required=True)
    rep.add_argument("--target", required=True)
    rep.add_argument("--output", required=True)
    rep.add_argument("--pipeline-id", help="one run (default: all)")
    rs = sub.add_parser("reset", help="drop the target table")
    rs.add_argument("--target", required=True)
    return p


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or get_spark(app=f"ledgerline-{args.command}")
    if args.command == "run":
        from ledgerline.plans.pipeline import ReconciliationJob
        job = ReconciliationJob(spark, args.target, args.runs, as_of=args.as_of, input_format=args.format,
                                target_parts=args.parts)
        res = job.run(args.input, output_dir=args.output, pipeline_id=args.pipeline_id,
                      expected_checksum=args.checksum)
        out = {k: v for k, v in res.record.items() if k != "validation_errors"}
    elif args.command == "generate":
        from ledgerline.sources.csv import write_csv
        from ledgerline.sources.generator import generate_operational_file
        df = generate_operational_file(spark, args.rows, args.as_of, args.duplicate_rate, args.error_rate, args.seed)
        write_csv(df.drop("gen_id", "source_id", "is_copy", "error_kind"), args.output)
        out = {"written": args.output}
    elif args.command == "report":
        from ledgerline.plans import runs as R
        from ledgerline.plans.pipeline import build_report, write_report
        from ledgerline.plans.target import TargetTable
        runs = R.run_history(spark, args.runs)
        if args.pipeline_id:
            runs = R.run_by_id(runs, args.pipeline_id)
        target = TargetTable(spark, args.target).current()
        if target is None:
            raise SystemExit("target table does not exist")
        write_report(build_report(runs, target, ["numero_operacion"]), args.output)
        out = {"written": args.output}
    else:
        from ledgerline.plans.target import TargetTable
        TargetTable(spark, args.target).drop()
        out = {"dropped": args.target}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
