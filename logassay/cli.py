"""Command line: ``python -m logassay <command> --registry audit.yaml``.

Each command prints its tables and a verdict table, and ends with 0 when every
rule passed and 1 when one failed. ``--out`` writes the tables as Parquet too.
"""

from __future__ import annotations

import argparse
import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logassay.operators import verdict
from logassay.plans import reports
from logassay.plans.reports import Report
from logassay.plans.suites import Audit
from logassay.roles import Roles
from logassay.session import build_session
from logassay.sources import storage, tables
from logassay.sources.registry import Registry, declared_outputs
from logassay.sources.scratch import materialize, release, written
from logassay.sources.tables import ParquetLayout


def _roles(registry: Registry) -> Roles:
    return Roles(**registry.document.get("roles", {}))


def _layout(registry: Registry) -> ParquetLayout:
    options = registry.ingest_options
    return ParquetLayout(
        options.get("compression", "zstd"),
        options.get("row_group_rows"),
        options.get("file_rows"),
        tuple(options.get("partition_by", ())),
    )


def _audits(spark: SparkSession, registry: Registry, names: Sequence[str]) -> dict[str, Audit]:
    return {n: Audit(registry.table(spark, n), _roles(registry)) for n in names}


def ingest(spark: SparkSession, registry: Registry, args: argparse.Namespace) -> Report:
    report = Report()
    for name in args.dataset or registry.names:
        spec = registry.dataset(name)
        written = tables.ingest(
            spark, spec.csv, spec.parquet, _roles(registry), _layout(registry), args.mode
        )
        print(f"{name}: {spec.csv} -> {spec.parquet}")
        written.printSchema()
    report.judged.append(declared_outputs(spark, registry))
    return report


def contract(spark: SparkSession, registry: Registry, args: argparse.Namespace) -> Report:
    report = Report({}, [declared_outputs(spark, registry)])
    roles = _roles(registry)
    for name, audit in _audits(spark, registry, args.dataset or registry.names).items():
        one = reports.contract_report(name, audit, roles.columns)
        if args.formats:
            csv = tables.read_csv(spark, registry.dataset(name).csv, tables.raw_schema(roles))
            one.tables[f"{name}: formats"] = storage.compare_formats(csv, audit.frame)
        _extend(report, one)
    return report


def profile(spark: SparkSession, registry: Registry, args: argparse.Namespace) -> Report:
    report = Report()
    roles = _roles(registry)
    names = args.dataset or registry.names
    audits = _audits(spark, registry, names)
    for name, audit in audits.items():
        observed = registry.dataset(name).options.get("observed", "natural")
        _extend(report, reports.profile_report(name, audit, observed))
    sources = {}
    for key in args.features:
        side = spark.read.option("header", True).csv(registry.side_file(key))
        sources[key] = (side.withColumn(roles.item, F.col(roles.item).try_cast("bigint")), roles.item)
    if sources:
        _extend(report, reports.feature_report(audits[names[-1]].grain, roles.item, sources))
    return report


def anomaly(spark: SparkSession, registry: Registry, args: argparse.Namespace) -> Report:
    report = Report()
    for name, audit in _audits(spark, registry, args.dataset or registry.names).items():
        _extend(report, reports.anomaly_report(name, audit))
    return report


def diff(spark: SparkSession, registry: Registry, args: argparse.Namespace) -> Report:
    audits = _audits(spark, registry, (args.left, args.right))
    return reports.diff_report(
        args.left, audits[args.left], args.right, audits[args.right], args.segments
    )


def peaks(spark: SparkSession, registry: Registry, args: argparse.Namespace) -> Report:
    (name,) = args.dataset or registry.names[:1]
    control = (args.control, registry.table(spark, args.control)) if args.control else None
    expected = {k: int(v) for k, v in (e.split("=") for e in args.expect)}
    audit = Audit(registry.table(spark, name), _roles(registry))
    return reports.peak_report(name, audit, args.partial, args.whole, expected, control)


def text(spark: SparkSession, registry: Registry, args: argparse.Namespace) -> Report:
    report = Report()
    for key in args.features or sorted(registry.document.get("side_files", {})):
        # Line by line: the text reader keeps bytes as they are and splits large files.
        _extend(report, reports.text_report(key, spark.read.text(registry.side_file(key))))
    return report


COMMANDS: dict[str, Callable[[SparkSession, Registry, argparse.Namespace], Report]] = {
    f.__name__: f for f in (ingest, contract, profile, anomaly, diff, peaks, text)
}


NEEDED = {"diff": ("left", "right"), "peaks": ("partial", "whole")}


def _extend(report: Report, more: Report) -> None:
    report.tables.update(more.tables)
    report.judged.extend(more.judged)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="logassay", description=__doc__)
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("--registry", required=True)
    p.add_argument("--dataset", action="append", help="repeatable; all datasets when left out")
    p.add_argument("--features", action="append", default=[], help="side file key; repeatable")
    p.add_argument("--left")
    p.add_argument("--right")
    p.add_argument("--control")
    p.add_argument("--segments", type=int, default=3)
    p.add_argument("--partial", type=int, help="day suspected of a partial double write")
    p.add_argument("--whole", type=int, help="day suspected of being written twice")
    p.add_argument("--expect", action="append", default=[], help="published total, as name=value")
    p.add_argument("--formats", action="store_true", help="also time a full read of CSV and Parquet")
    p.add_argument("--mode", default="errorifexists", choices=("errorifexists", "overwrite"))
    p.add_argument("--out", help="folder for the tables as Parquet")
    p.add_argument("--show", type=int, help="rows printed per table; all when left out")
    return p


def _publish(name: str, table: DataFrame, args: argparse.Namespace) -> None:
    if args.out:
        folder = re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")
        table.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{args.command}_{folder}")
    print(f"\n{name}")
    table.show(args.show if args.show is not None else table.count(), truncate=False)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    lacking = [f"--{x}" for x in NEEDED.get(args.command, ()) if getattr(args, x) is None]
    if lacking:
        parser.error(f"{args.command} needs {' and '.join(lacking)}")
    registry = Registry.load(args.registry)
    spark = spark or build_session()
    before = written(spark)
    try:
        report = COMMANDS[args.command](spark, registry, args)
        for name, table in report.tables.items():
            _publish(name, table, args)
        if not report.judged:
            return 0
        judged = materialize(report.verdicts, "verdicts")
        _publish("verdicts", judged, args)
        verdict.summarize(judged).show()
        return verdict.exit_code(judged)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        print(f"FAIL: {e.getMessage()}")
        return 1
    finally:
        release(spark, before)
