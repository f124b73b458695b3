"""Command line: the pipeline stages as subcommands (run under ``spark-submit`` or plain ``python``).

    python -m reqlens ingest    RAW_CSV                 row / column count + column contract
    python -m reqlens inspect   RAW_CSV OUT_DIR         quality profile (raw staged once as Parquet)
    python -m reqlens split     RAW_CSV OUT_DIR         good records and quarantined ones, with reasons
    python -m reqlens clean     RAW_CSV OUT_DIR         gated cleaned layer, published
    python -m reqlens transform OUT_DIR                 gated transformed layer + four summaries, published together
    python -m reqlens analyze   OUT_DIR [--only NAME]   the analyses, titled, over the transformed layer
    python -m reqlens sql       OUT_DIR [SCRIPT]        statements of a SQL file over the transformed layer (view `requests`)
    python -m reqlens pipeline  RAW_CSV OUT_DIR         clean + transform + summaries + analyses

The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings given to ``spark-submit`` apply unchanged.  ``OUT_DIR`` must be on
storage every executor can reach.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from reqlens.operators.quality import schema_profile
from reqlens.plans.analyses import ANALYSES
from reqlens.plans.pipeline import profile_stage, publish_cleaned, publish_transformed, run_pipeline
from reqlens.plans.sql_script import ANALYSES_SQL, run_script
from reqlens.session import configure
from reqlens.roles import Roles
from reqlens.sources.files import csv_report, ingest_report, read_raw_csv
from reqlens.sources.quarantine import quarantine_summary, quarantined_records, split_raw_csv
from reqlens.sources.release import current_release

TITLES = {
    "top_complaints_by_borough": "Most frequent complaint types in each borough, with their share",
    "high_volume_complaints": "Complaint types above the average volume, by mean resolution time",
    "agency_workload_speed": "Agencies ranked by workload and by resolution speed",
    "borough_coverage": "Resolution coverage and mean resolution time per borough",
    "peak_hours": "Requests per hour of day",
    "weekday_pattern": "Average requests per day of week, weekday vs weekend",
    "daily_spikes": "Each day against the average day",
    "peak_hour_by_complaint": "Busiest hours of the most frequent complaint types",
    "complaint_resolution_by_borough": "Resolution time of the top complaint types across boroughs",
}


def _show(title: str, df, rows: int) -> None:
    print(f"\n## {title}\n")
    df.show(rows, truncate=False)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="reqlens", description=__doc__.split("\n\n")[0])
    p.add_argument("--rows", type=int, default=100, help="rows shown per result (default 100)")
    p.add_argument(
        "--role", action="append", default=[], metavar="ROLE=COLUMN", help="column that plays a role, e.g. category=issue_type"
    )
    p.add_argument("--multiline", action="store_true", help="CSV fields may contain line breaks")
    p.add_argument("--infer", action="store_true", help="infer the types of text columns (one more pass over the input)")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("ingest").add_argument("raw")
    for name in ("inspect", "split", "clean", "pipeline"):
        sp = sub.add_parser(name)
        sp.add_argument("raw")
        sp.add_argument("out")
    sub.add_parser("transform").add_argument("out")
    an = sub.add_parser("analyze")
    an.add_argument("out")
    sql = sub.add_parser("sql")
    sql.add_argument("out")
    sql.add_argument("script", nargs="?", help="SQL file over the view `requests` (default: the analyses)")
    an.add_argument("--only", action="append", choices=sorted(ANALYSES), help="run only these analyses")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = configure(spark or SparkSession.builder.appName("reqlens").getOrCreate())
    out = getattr(args, "out", "").rstrip("/")
    roles = Roles(**dict(x.split("=", 1) for x in args.role))
    if args.command in ("ingest", "inspect", "clean", "pipeline"):
        raw = read_raw_csv(spark, args.raw, roles=roles, multiline=args.multiline, infer=args.infer)

    if args.command == "ingest":
        _show("Ingest report (column contract passed)", ingest_report(raw), args.rows)
        _show("Records and numbers that did not parse", csv_report(spark, args.raw, multiline=args.multiline), args.rows)
    elif args.command == "inspect":
        _show("Schema", schema_profile(raw), len(raw.columns))
        for name, df in profile_stage(spark, raw, f"{out}/profile", roles).items():
            _show(name.replace("_", " ").capitalize(), df, args.rows)
    elif args.command == "clean":
        release, metrics = publish_cleaned(spark, raw, out, roles)
        print(f"Cleaned data validated and published as release {release.number} of {out}: {metrics}")
    elif args.command == "transform":
        release, metrics = publish_transformed(spark, out, roles)
        print(f"Transformed data validated and published as release {release.number} of {out}: {metrics}")
        print(f"Summaries: {[t for t in release.tables if t.endswith('summary')]}")
    elif args.command == "split":
        print(f"Records split under {out}: {split_raw_csv(spark, args.raw, out, multiline=args.multiline, roles=roles)}")
        _show("Quarantined records by file and reason", quarantine_summary(quarantined_records(spark, out)), args.rows)
    elif args.command in ("analyze", "pipeline", "sql"):
        if args.command == "pipeline":
            res = run_pipeline(spark, raw, out, roles=roles, with_analyses=False)
            print(f"Pipeline published as release {res.release.number} of {out}: {res.cleaning_metrics} {res.transform_metrics}")
        release = current_release(spark, out)
        if release is None:
            raise FileNotFoundError(f"no release under {out}")
        transformed = release.read(spark, "transformed")
        if args.command == "sql":
            text = spark.sparkContext.wholeTextFiles(args.script).values().first() if args.script else ANALYSES_SQL.read_text()
            for i, (title, df) in enumerate(run_script(spark, text, {"requests": transformed}), start=1):
                _show(f"Query {i}: {title}", df, args.rows)
            return 0
        names = getattr(args, "only", None) or list(ANALYSES)
        for i, name in enumerate(names, start=1):
            _show(f"Analysis {i}: {TITLES[name]}", ANALYSES[name](transformed, roles=roles), args.rows)
    return 0


if __name__ == "__main__":
    sys.exit(main())
