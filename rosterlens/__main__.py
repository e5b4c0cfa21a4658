"""Command line: the reference's ETL run and its questions, on Spark.

    python -m rosterlens refresh --source profiles.csv --landing landed/ --database characters
    python -m rosterlens report class_popularity --database characters [--rows 20]
    python -m rosterlens report class_popularity --tables /path/of/database-location
    python -m rosterlens check --database characters

Under spark-submit the cluster master is kept; plain python runs local[*].
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from rosterlens.plans import explore, reports
from rosterlens.plans.model import Relations
from rosterlens.plans.etl import LOAD_COLUMNS, Settings, refresh
from rosterlens.sources.sinks import load_folders

REPORTS = {
    "class_popularity": lambda r: reports.class_popularity(r, ordered=True),
    "race_popularity": lambda r: reports.race_popularity(r, ordered=True),
    "multiclass_count": reports.multiclass_count,
    "level_20_count": reports.level_20_count,
    "maxed_stats": lambda r: reports.maxed_stats(r, ordered=True),
    "dump_stats": lambda r: reports.dump_stats(r, ordered=True),
    "class_notes_summary": lambda r: reports.class_notes_summary(r, ordered=True),
    "top_subclass_per_class": lambda r: reports.top_subclass_per_class(r, ordered=True),
    "multiclass_rate_by_class": reports.multiclass_rate_by_class,
    "dashboard_kpis": reports.dashboard_kpis,
    "kpi_cards": reports.kpi_cards,
    "top_classes": explore.top_classes,
    "top_races": explore.top_races,
    "top_subclasses": explore.top_subclasses,
    "notes_filtered": explore.notes_filtered,
    "multiclass_filtered": explore.multiclass_filtered,
    "explorer": explore.explorer_union,
    "correlation_matrix": explore.correlation_matrix,
}


def _tables(spark, database: str, tables_dir: str | None) -> Relations:
    """Loaded tables from the catalog, or from their folders (a session
    without a persistent metastore forgets its databases when it ends)."""
    if tables_dir:
        return Relations(*load_folders(spark, tables_dir, list(LOAD_COLUMNS)))
    return Relations(*(spark.table(f"`{database}`.`{n}`") for n in LOAD_COLUMNS))


def _properties(given: list[str]) -> dict[str, str]:
    pairs = (p.partition("=")[::2] for p in given)
    return {k: os.environ[v[1:]] if v.startswith("@") else v for k, v in pairs}


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="rosterlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh", help="schema -> land -> clean -> keyed tables -> views")
    r.add_argument("--source", required=True)
    r.add_argument("--landing")
    r.add_argument("--stream-checkpoint", help="with --landing: land only new files of the --source folder")
    r.add_argument("--database", default="characters")
    r.add_argument("--database-location")
    r.add_argument("--jdbc-url", help="load the three tables behind this URL instead of the catalog")
    r.add_argument("--jdbc-partitions", type=int, help="connections of a JDBC load")
    r.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE",
                   help="driver property; @VARIABLE as the value takes it from the environment")
    r.add_argument("--sample-rows", type=int)
    r.add_argument("--timestamp-format")
    r.add_argument("--buckets", default="auto", help='bucket count on char_id, "auto" (default) or 0 for none')
    r.add_argument("--no-validate", action="store_true", help="skip the check of keys and references before the switch")
    q = sub.add_parser("report", help="one reporting question over the loaded tables")
    q.add_argument("name", choices=sorted(REPORTS))
    q.add_argument("--database", default="characters")
    q.add_argument("--rows", type=int, help="show only so many rows (default: all)")
    q.add_argument("--out", help="write the whole result here as CSV instead of showing it")
    c = sub.add_parser("check", help="integrity checks over the loaded tables")
    c.add_argument("--database", default="characters")
    for p in (q, c):
        p.add_argument("--tables", help="folder holding the table folders (e.g. --database-location)")
    for p in (r, q, c):
        p.add_argument("--master", default=None, help="default: spark-submit's, else local[*]")
        p.add_argument("--partitions", type=int, default=200)
    args = ap.parse_args(argv)

    from rosterlens.session import build_session

    spark = build_session(args.master, args.partitions)
    if args.cmd == "refresh":
        counts = refresh(spark, Settings(
            source=args.source, landing=args.landing, stream_checkpoint=args.stream_checkpoint,
            database=args.database,
            database_location=args.database_location, sample_rows=args.sample_rows,
            timestamp_format=args.timestamp_format,
            jdbc_url=args.jdbc_url, jdbc_partitions=args.jdbc_partitions, jdbc_properties=_properties(args.jdbc_property),
            buckets=args.buckets if args.buckets == "auto" else (int(args.buckets) or None),
            validate=not args.no_validate))
        print(json.dumps(counts))
    elif args.cmd == "report":
        result = REPORTS[args.name](_tables(spark, args.database, args.tables))
        if args.out:
            result.write.mode("overwrite").option("header", True).csv(args.out)
        else:
            result.show(args.rows if args.rows is not None else max(1, result.count()), truncate=False)
    else:
        from rosterlens.operators.integrity import check_relations

        t = _tables(spark, args.database, args.tables)
        found = check_relations(t.character, t.classes, t.feats)
        found.show(max(1, found.count()), truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
