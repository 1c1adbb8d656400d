"""Command line: one run over landed JSON lines.

    python -m winnow.cli LANDED --output DIR [--phase 1|2|all] [--target N] [--now TIME] [--run N] [--fresh] [--workbook FILE]

``LANDED`` holds a folder of JSON lines for each stream (startups, products, papers, jobs,
news) with the columns of ``engine.LANDED``; a stream without a folder is empty, and a
folder that cannot be read leaves the others as they are. The exit code is 1 if the run
fell short of its target.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import engine
from .sources import readers as R


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="winnow")
    p.add_argument("landed")
    p.add_argument("--output", default="exports")
    p.add_argument("--phase", choices=["1", "2", "all"], default="all")
    p.add_argument("--target", type=int, default=1000)
    p.add_argument("--now", help="clock of the gates, ISO; the time of the call if absent")
    p.add_argument("--run", type=int, help="number of the run in the history; seconds since 1970 if absent")
    p.add_argument("--run-id")
    p.add_argument("--fresh", action="store_true", help="forget seen keys, counts and logs")
    p.add_argument("--workbook", help="write the tables as one .xlsx file as well")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    began = time.time()
    spark = spark or SparkSession.builder.appName("winnow").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    landed = {}
    for name, ddl in engine.LANDED.items():
        rows, failed = R.read_sources(spark, [R.Source(name, lambda s, n=name, d=ddl: s.read.schema(d).option("mode", "DROPMALFORMED").json(f"{args.landed}/{n}"))], ddl)
        landed[name] = rows.select(*spark.createDataFrame([], ddl).columns)
        for source, why in failed.items():
            print(f"{source}: not read ({why})", file=sys.stderr)
    seeds = R.seed_companies(spark).select(F.col("name").alias("canonical"))
    none = spark.createDataFrame([], "alias string, canonical string"), spark.createDataFrame([], "domain string, canonical string")
    now = args.now or dt.datetime.now(dt.UTC).isoformat()
    number = int(began) if args.run is None else args.run
    report = engine.run(
        spark, landed, seeds, *none, F.lit(now).cast("timestamp"), args.output, args.run_id or f"run-{number}", args.target,
        seconds=time.time() - began, phase=args.phase, run=number, fresh=args.fresh, workbook=args.workbook,
    ).first()
    print(f"{report.run_id}: {report.status} {dict(report.collected)}")
    return 0 if report.status == "completed" else 1


if __name__ == "__main__":
    sys.exit(main())
