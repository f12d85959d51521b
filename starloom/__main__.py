"""Command line: extract the source, rebuild and check the star, load staged batches, write the reports.

    python -m starloom extract SOURCE LANDING [--format parquet|csv|jdbc] [--option KEY=VALUE ...] [--partitions N]
    python -m starloom rebuild LANDING WAREHOUSE
    python -m starloom capture WAREHOUSE TOTALS_JSON
    python -m starloom verify WAREHOUSE TOTALS_JSON
    python -m starloom report WAREHOUSE OUTPUT

    python -m starloom start TABLES LOADED          # version 0 of an incrementally loaded warehouse
    python -m starloom load STAGING LOADED CUTOFF   # one load for each staged table
    python -m starloom log LOADED

Under spark-submit the session and its settings come from the cluster.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from starloom.plans import loads, quality, reports, warehouse
from starloom.session import DEFAULTS
from starloom.sources import landing, versions
from starloom.sources.schemas import CONTROL_TOTALS, OPERATIONAL


def extract(spark: SparkSession, source: str, landing_folder: str, format: str, option: Sequence[str], partitions: int) -> bool:
    """Land the eleven operational tables, each with its declared columns and types."""
    options = dict(pair.split("=", 1) for pair in option)
    for name in OPERATIONAL:
        table = landing.extract_source(spark, name, source, format, options, partitions)
        print(name, landing.land(table, f"{landing_folder}/src_{name}.parquet"))
    return True


def rebuild(spark: SparkSession, landing_folder: str, warehouse_folder: str) -> bool:
    built = warehouse.rebuild(landing.read_operational(spark, landing_folder), warehouse_folder)
    warehouse.read_totals(spark, warehouse_folder).show(truncate=False, vertical=True)
    quality.unresolved_keys(built["fact"]).show()
    return True


def capture(spark: SparkSession, warehouse_folder: str, totals: str) -> bool:
    """Write the control totals of a warehouse, the answer key for later checks. They are computed from its tables anew."""
    tables = warehouse.read_star(spark, warehouse_folder)
    fact = tables.pop("fact")
    landing.write_totals(quality.control_totals(fact, tables), totals)
    return True


def verify(spark: SparkSession, warehouse_folder: str, totals: str) -> bool:
    """Compare the totals taken while the warehouse was written with the answer key; no table is read."""
    taken = warehouse.read_totals(spark, warehouse_folder)
    reconciled = quality.reconcile(taken, landing.read_totals(spark, totals, CONTROL_TOTALS))
    reconciled.show(truncate=False)
    return quality.verdict(reconciled).first()["passed"]


def report(spark: SparkSession, warehouse_folder: str, output: str) -> bool:
    tables = warehouse.read_star(spark, warehouse_folder)
    fact = tables["fact"]
    charts = {
        "by_category": reports.revenue_by_category(fact, tables["customer"]),
        "by_month": reports.revenue_by_month(fact),
        "top_items": reports.top_items(fact, tables["stockitem"]),
    }
    pages = {name: reports.bar_labels(reports.with_bar_share(chart)) for name, chart in charts.items()}
    for name, page in {"kpis": reports.kpi_labels(reports.sales_kpis(fact)), **pages}.items():
        page.write.mode("overwrite").json(f"{output}/{name}")
    return True


def start(spark: SparkSession, tables: str, loaded: str) -> bool:
    """Begin a loaded warehouse with the dimensions in the folder ``tables``."""
    first = {spec.table: spark.read.parquet(f"{tables}/{spec.table}.parquet") for spec in (*loads.LOADED, *loads.LOOKED_UP)}
    print(loads.start(spark, first, loaded))
    return True


def load(spark: SparkSession, staging: str, loaded: str, cutoff: str) -> bool:
    """Load the staged tables that the folder ``staging`` holds, up to the source's ``cutoff``."""
    names = [*(spec.table for spec in loads.LOADED), warehouse.SALE]
    staged = {name: spark.read.parquet(f"{staging}/{name}.parquet") for name in names if versions.exists(spark, f"{staging}/{name}.parquet")}
    if not staged:
        raise FileNotFoundError(f"{staging} holds none of {', '.join(names)}")
    print(loads.load_staged(spark, loaded, staged, datetime.fromisoformat(cutoff), datetime.now(timezone.utc).replace(tzinfo=None)))
    return True


def log(spark: SparkSession, loaded: str) -> bool:
    loads.load_log(spark, loaded).show(1000, truncate=False)
    return True


COMMANDS = (
    (extract, ("source", "landing")), (rebuild, ("landing", "warehouse")), (capture, ("warehouse", "totals")), (verify, ("warehouse", "totals")),
    (report, ("warehouse", "output")), (start, ("tables", "loaded")), (load, ("staging", "loaded", "cutoff")), (log, ("loaded",)),
)


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="starloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(required=True)
    for command, names in COMMANDS:
        sub = commands.add_parser(command.__name__)
        for name in names:
            sub.add_argument(name)
        if command is extract:
            sub.add_argument("--format", choices=("parquet", "csv", "jdbc"), default="parquet")
            sub.add_argument("--option", action="append", default=[])
            sub.add_argument("--partitions", type=int, default=1)
            names = (*names, "format", "option", "partitions")
        sub.set_defaults(run=command, names=names)
    chosen = parser.parse_args(arguments)
    builder = SparkSession.builder.appName("starloom")
    for name, value in DEFAULTS.items():
        builder = builder.config(name, value)
    passed = chosen.run(builder.getOrCreate(), *[getattr(chosen, name) for name in chosen.names])
    return 0 if passed else 1


if __name__ == "__main__":
    sys.exit(main())
