"""Incremental loads of a stored warehouse: staged tables in, a new complete version out.

A version holds the dimensions, the lineage of loads and their cutoffs; the sales lie beside the versions, stored by month. The lineage of a
version decides which months count, so a load that broke off is never seen and is simply run again.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.history import CUSTOMER, STOCK_ITEM, SUPPLIER, HistorySpec
from starloom.operators.lookup import Role, VersionedDimension
from starloom.plans import months, summaries, warehouse
from starloom.plans.facts import LOADED_COLUMNS
from starloom.plans.warehouse import CUTOFFS, LINEAGE, SALE
from starloom.session import SHUFFLES_REMOVED, settings
from starloom.sources import versions
from starloom.sources.landing import read_parquet
from starloom.sources.schemas import CUTOFFS as CUTOFF_SCHEMA
from starloom.sources.schemas import LINEAGE as LINEAGE_SCHEMA
from starloom.sources.schemas import LOADED_SALE

CITY = HistorySpec("City", "WWI_City_ID", "City_Key")
EMPLOYEE = HistorySpec("Employee", "WWI_Employee_ID", "Employee_Key")
#: Dimensions that are loaded, and those that the sales only look keys up in.
LOADED = (CUSTOMER, STOCK_ITEM, SUPPLIER)
LOOKED_UP = (CITY, EMPLOYEE)

ROLES = (
    Role("WWI_City_ID", CITY.table, "City_Key"),
    Role("WWI_Customer_ID", CUSTOMER.table, "Customer_Key"),
    Role("WWI_Bill_To_Customer_ID", CUSTOMER.table, "Bill_To_Customer_Key"),
    Role("WWI_Stock_Item_ID", STOCK_ITEM.table, "Stock_Item_Key"),
    Role("WWI_Salesperson_ID", EMPLOYEE.table, "Salesperson_Key"),
)


def sale_folder(folder: str) -> str:
    return f"{folder}/sale"


def start(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> str:
    """Version 0: the given dimensions, no loads, and a cutoff that is still unknown for every loaded table."""
    missing = [spec.table for spec in (*LOADED, *LOOKED_UP) if spec.table not in tables]
    if missing:
        raise ValueError(f"tables are missing: {', '.join(missing)}")
    cutoffs = spark.createDataFrame([(name, None) for name in (*(spec.table for spec in LOADED), SALE)], CUTOFF_SCHEMA)
    target = versions.version_folder(folder, 0)
    first = {spec.table: tables[spec.table] for spec in (*LOADED, *LOOKED_UP)}
    with settings(spark, **SHUFFLES_REMOVED):
        warehouse.write_warehouse({**first, LINEAGE: spark.createDataFrame([], LINEAGE_SCHEMA), CUTOFFS: cutoffs}, target)
    return target


def load_staged(
    spark: SparkSession,
    folder: str,
    staged: Mapping[str, DataFrame],
    cutoff: datetime | str,
    now: datetime | str,
    base: str | None = None,
    target: str | None = None,
) -> str:
    """Load all staged tables on top of the newest version, dimensions before sales, and return the new version's folder.

    Every table is a load of its own in the lineage, opened with ``cutoff`` and closed. Sales look their keys up in the
    dimensions as they are after their loads. Tables without a batch are pointed to, not copied. Each step is written, and what it
    shuffled is removed before the next.
    """
    with settings(spark, **SHUFFLES_REMOVED):
        return _load_staged(spark, folder, staged, cutoff, now, base, target)


def _load_staged(
    spark: SparkSession, folder: str, staged: Mapping[str, DataFrame], cutoff: datetime | str, now: datetime | str, base: str | None, target: str | None
) -> str:
    known = {*(spec.table for spec in LOADED), SALE}
    if unknown := sorted({*staged} - known):
        raise ValueError(f"no load for {', '.join(unknown)}")
    base = base or versions.newest(spark, folder)
    target = target or versions.unused(spark, folder)
    stored = versions.tables_of(spark, base)
    paths = dict(stored)
    state = {name: read_parquet(spark, path) for name, path in stored.items()}
    for spec in LOADED:
        if spec.table in staged:
            opened = warehouse.open_load(state, spec.table, now, cutoff)
            state = warehouse.load_dimension(opened, staged[spec.table], spec, now)
            paths[spec.table] = f"{target}/{spec.table}"
            state[spec.table].write.mode("overwrite").parquet(paths[spec.table])
            state[spec.table] = read_parquet(spark, paths[spec.table])
    if SALE in staged:
        dimensions = {spec.table: VersionedDimension(state[spec.table], spec.business_key, spec.surrogate) for spec in (*LOADED, *LOOKED_UP)}
        opened = warehouse.open_load(state, SALE, now, cutoff)
        lines = months.with_month(staged[SALE])
        state = warehouse.load_sales_by_month(opened, sale_folder(folder), lines, ROLES, dimensions, now, columns=LOADED_COLUMNS)
    changed = {LINEAGE: state[LINEAGE], CUTOFFS: state[CUTOFFS]}
    warehouse.write_warehouse(changed, target, mode="overwrite", unchanged={name: path for name, path in paths.items() if name not in changed})
    return target


def read_sales(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    """The sales that a version, by default the newest, shows."""
    lineage = warehouse.read_warehouse(spark, version or versions.newest(spark, folder), [])[LINEAGE]
    return months.read_months(spark, sale_folder(folder), lineage, LOADED_SALE).drop(months.MONTH)


def read_summaries(spark: SparkSession, folder: str, version: str | None = None) -> summaries.Summaries:
    lineage = warehouse.read_warehouse(spark, version or versions.newest(spark, folder), [])[LINEAGE]
    return summaries.read(spark, sale_folder(folder), lineage)


def load_log(spark: SparkSession, folder: str) -> DataFrame:
    """Every load of the newest version with its table's cutoff as it stands."""
    state = warehouse.read_warehouse(spark, versions.newest(spark, folder), [CUTOFFS])
    return state[LINEAGE].join(state[CUTOFFS], "Table_Name", "left").orderBy(F.col("Lineage_Key"))
