"""One ``spark-submit`` entry point per stage.

    spark-submit --py-files tallyscape.zip tallyscape/jobs.py <stage> <options>

    ingest    --input wide.csv --output clean --entity name --reject Total
    transform --input clean --output filled --entity name
    widen     --input long --output wide --entity name --category kind --measure cases
    cluster   --input filled --output clustered --entity name --k 4 --export folder --warehouse folder
              --jdbc-url URL --jdbc-properties file --jdbc-prefix p_ --jdbc-mode overwrite
    report    --input warehouse --output reports --category kind

``ingest`` counts the lines that do not fit the schema and writes them to --rejects, or stops if there are
any and no place is named.  --sheet reads a published sheet.
"""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyscape.operators.cluster import PARTITIONS
from tallyscape.plans import stages
from tallyscape.sinks.files import write_csv, write_parquet
from tallyscape.sources.files import read_declared_csv, read_inferred_csv, read_parquet
from tallyscape.sources.publication import read_publication_csv


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallyscape.jobs")
    stage = parser.add_subparsers(dest="stage", required=True)
    ingest, transform, widen, cluster, report = (
        stage.add_parser(n) for n in ("ingest", "transform", "widen", "cluster", "report")
    )
    for p in (ingest, transform, widen, cluster, report):
        p.add_argument("--input", required=True)
        p.add_argument("--output", required=True)
    for p in (ingest, transform, widen, cluster):
        p.add_argument("--entity", required=True)
    ingest.add_argument("--reject", nargs="*", default=[])
    ingest.add_argument("--schema", help="DDL of the file; without it types are inferred")
    ingest.add_argument("--join-letters", action="store_true")
    ingest.add_argument("--sheet", action="store_true", help="a published sheet with a header over two lines")
    ingest.add_argument("--drop-zero-rows", action="store_true")
    ingest.add_argument("--rejects", help="folder for the lines that do not fit")
    transform.add_argument("--missing", choices=["zero", "drop"], default="zero")
    transform.add_argument("--scale", action="store_true")
    widen.add_argument("--category", required=True)
    widen.add_argument("--measure", required=True)
    cluster.add_argument("--k", default="4", help="a number or auto")
    cluster.add_argument("--raw", action="store_true", help="do not standardise")
    cluster.add_argument("--export", help="folder for the CSV and JSON outputs")
    cluster.add_argument("--warehouse", help="folder for the star-schema tables")
    cluster.add_argument("--period", type=int, help="period of the facts")
    cluster.add_argument("--partitions", type=int, default=PARTITIONS, help="layout of the training rows")
    cluster.add_argument("--jdbc-url", help="database for the star-schema tables")
    cluster.add_argument("--jdbc-properties", help="file of key=value lines: driver, user, password")
    cluster.add_argument("--jdbc-prefix", default="")
    cluster.add_argument("--jdbc-mode", default="overwrite")
    report.add_argument("--category", required=True)
    report.add_argument("--cluster-id", type=int, default=0)
    return parser.parse_args(argv)


def _read(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame | None]:
    """The rows of the file, and those that do not fit where that can be told."""
    if args.sheet:
        body, _, rejects = read_publication_csv(spark, args.input, entity=args.entity)
        return body, rejects
    if not args.schema:
        return read_inferred_csv(spark, args.input), None
    schema = T.StructType.fromDDL(args.schema)
    raw = read_declared_csv(spark, args.input, schema, rejects="_line")
    # Only columns that are read are parsed, so all of them go with the line.
    return raw.filter(F.col("_line").isNull()).drop("_line"), raw.filter(F.col("_line").isNotNull())


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"tallyscape-{args.stage}").getOrCreate()
    if args.stage == "ingest":
        raw, rejects = _read(spark, args)
        if rejects is not None:
            counts = rejects.select(F.count(F.lit(1)), *[F.count(F.col(f"`{c}`")) for c in rejects.columns])
            found = counts.first()[0]
            print(f"{found} lines do not fit")
            if args.rejects:
                rejects.write.mode("overwrite").json(args.rejects)
            elif found:
                raise SystemExit("name a folder with --rejects to go on without them")
        out = stages.ingest(
            raw, args.entity, reject=args.reject, drop_zero_rows=args.drop_zero_rows, join_letters=args.join_letters
        )
    elif args.stage == "transform":
        out = stages.transform(
            read_parquet(spark, args.input), args.entity, missing=args.missing, scale=args.scale
        )
    elif args.stage == "widen":
        out = stages.widen(read_parquet(spark, args.input), args.entity, args.category, args.measure)
    elif args.stage == "report":
        star = {t: read_parquet(spark, f"{args.input}/{t}") for t in ("entity", "category", "fact", "assignment")}
        for name, table in stages.star_reports(star, args.category, args.cluster_id).items():
            write_csv(table, f"{args.output}/{name}")
        return
    else:
        k = args.k if args.k == "auto" else int(args.k)
        run = stages.cluster(
            read_parquet(spark, args.input), args.entity, k=k, scale=not args.raw, partitions=args.partitions
        )
        out = run.assigned
        star = stages.warehouse_tables(run, period=args.period) if args.export or args.warehouse or args.jdbc_url else {}
        if args.export:
            stages.export(run, args.export, star=star)
        if args.warehouse:
            for name, table in star.items():
                write_parquet(table, f"{args.warehouse}/{name}")
        if args.jdbc_url:
            properties = {}
            if args.jdbc_properties:
                lines = Path(args.jdbc_properties).read_text().splitlines()
                properties = dict(line.split("=", 1) for line in lines if "=" in line)
            stages.load_database(star, args.jdbc_url, properties, prefix=args.jdbc_prefix, mode=args.jdbc_mode)
    write_parquet(out, args.output)


if __name__ == "__main__":
    main()
