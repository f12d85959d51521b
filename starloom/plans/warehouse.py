"""Whole-warehouse steps: the full rebuild and the incremental loads.

A warehouse is a mapping of table names to DataFrames. A load takes the old mapping and a staged
batch and returns the new one; nothing is changed in place. A written warehouse becomes visible when its
version is declared complete, after all its tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.operators import control
from starloom.operators.history import LINEAGE_KEY, HistorySpec, apply_history
from starloom.operators.lookup import BY_LOTS, Role, VersionedDimension, require_unique, resolve_and_deal
from starloom.plans import months, quality, summaries
from starloom.plans.dimensions import dim_customer, dim_stockitem, dim_supplier
from starloom.plans.facts import fact_sale
from starloom.session import settings
from starloom.sources import landing, versions
from starloom.sources.landing import read_parquet, write_parquet
from starloom.sources.schemas import CONTROL_TOTALS

Warehouse = Mapping[str, DataFrame]

LINEAGE, CUTOFFS, SALE = "Lineage", "ETL Cutoff", "Sale"
TOTALS = "totals.json"


def rebuild(tables: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Build a new version: the three dimensions, then the fact from the written dimensions.

    A business key that occurs twice would multiply fact lines, so the load stops there. Readers go on with the version
    before until the new one is complete. The control totals are taken while the tables are written, in the writing
    tasks, and kept with the version, so that checking it reads no table again.
    """
    spark = tables["customers"].sparkSession
    version = versions.unused(spark, folder)
    paths = {name: f"{version}/dim_{name}" for name in ("customer", "stockitem", "supplier")} | {"fact": f"{version}/fact_sale"}
    built, totals = {}, {}
    for name, build, key in (
        ("customer", dim_customer, "WWI_Customer_ID"),
        ("stockitem", dim_stockitem, "WWI_Stock_Item_ID"),
        ("supplier", dim_supplier, "WWI_Supplier_ID"),
    ):
        seen = Observation()
        write_parquet(build(tables).observe(seen, F.count("*").alias(f"dim_{name}_rows")), paths[name])
        totals |= seen.get
        built[name] = read_parquet(spark, paths[name])
        require_unique(built[name], key)
    seen = Observation()
    write_parquet(fact_sale(tables, built).observe(seen, *quality.fact_measures()), paths["fact"])
    totals |= seen.get
    values = ", ".join(f'"{name}": {"null" if totals[name] is None else totals[name]}' for name in CONTROL_TOTALS.names)
    versions.write_text(spark, f"{version}/{TOTALS}", f"{{{values}}}")
    versions.publish(spark, version, paths)
    return {**built, "fact": read_parquet(spark, paths["fact"])}


def read_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The control totals taken when the newest complete rebuild was written: one row. Of one without them they are computed."""
    version = versions.newest(spark, folder)
    if versions.exists(spark, f"{version}/{TOTALS}"):
        return landing.read_totals(spark, f"{version}/{TOTALS}", CONTROL_TOTALS)
    tables = read_star(spark, folder)
    fact = tables.pop("fact")
    return quality.control_totals(fact, tables)


def read_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The dimensions and the fact of the newest complete rebuild."""
    return {name: read_parquet(spark, path) for name, path in versions.tables_of(spark, versions.newest(spark, folder)).items()}


def open_load(warehouse: Warehouse, table: str, started: datetime | str, cutoff: datetime | str) -> dict[str, DataFrame]:
    return {**warehouse, LINEAGE: control.open_load(warehouse[LINEAGE], table, started, cutoff)}


def _finished(warehouse: Warehouse, table: str, key: int, completed: datetime | str) -> dict[str, DataFrame]:
    lineage = control.close_load(warehouse[LINEAGE], key, completed)
    return {**warehouse, LINEAGE: lineage, CUTOFFS: control.advance_cutoff(warehouse[CUTOFFS], lineage, table, key)}


def load_dimension(warehouse: Warehouse, staging: DataFrame, spec: HistorySpec, completed: datetime | str) -> dict[str, DataFrame]:
    """Apply a staged batch to one dimension and close its load; refused without an open load."""
    key = control.require_open_load(warehouse[LINEAGE], spec.table)
    loaded = apply_history(warehouse[spec.table], staging, spec, key)
    return {**_finished(warehouse, spec.table, key, completed), spec.table: loaded}


def load_sales_by_month(
    warehouse: Warehouse,
    folder: str,
    staging: DataFrame,
    roles: Sequence[Role],
    dimensions: Mapping[str, VersionedDimension],
    completed: datetime | str,
    at: str = "Last_Modified_When",
    columns: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Resolve the staged lines' keys, restate their invoices in the fact stored by month in ``folder`` and close the load.

    Only the months with dropped or added lines are written, together with their sums, and of the lines only ``columns``, by default all. The staged
    lines have a ``months.MONTH``. The dimensions are arguments so that they are those of after their own load. The new lines
    are visible to readers of the returned lineage.
    """
    spark = staging.sparkSession
    key = control.require_open_load(warehouse[LINEAGE], SALE)
    rows, resolved = resolve_and_deal(staging, at, roles, dimensions, months.MONTH)
    resolved = resolved.withColumn(LINEAGE_KEY, F.lit(key).cast("bigint"))
    if columns is not None:
        resolved = resolved.select(*columns, months.MONTH)
    visible = months.read_months(spark, folder, warehouse[LINEAGE], resolved.schema)
    with settings(spark, **BY_LOTS):
        months.store_months(*months.restate_months(visible, rows, resolved), key, folder, dealt=True)
    summaries.store(spark, folder, key)
    return _finished(warehouse, SALE, key, completed)


def write_warehouse(warehouse: Warehouse, folder: str, mode: str = "errorifexists", unchanged: Mapping[str, str] | None = None) -> None:
    """Write the tables to a new folder and declare it complete.

    ``unchanged`` names tables whose files of an earlier version still hold, and where those are: they aren't copied.
    """
    kept = dict(unchanged or {})
    written = {name: f"{folder}/{name}" for name in warehouse if name not in kept}
    for name, path in written.items():
        warehouse[name].write.mode(mode).parquet(path)
    versions.publish(warehouse[LINEAGE].sparkSession, folder, kept | written)


def read_warehouse(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """The lineage and the named tables of a complete version."""
    paths = versions.tables_of(spark, folder)
    return {name: read_parquet(spark, paths[name]) for name in dict.fromkeys([LINEAGE, *names])}
