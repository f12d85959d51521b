"""Checks of a built warehouse against control totals and against itself."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.constants import TOLERANCE, TOTAL
from starloom.sources.schemas import CONTROL_TOTALS

# Measures that must agree, and row counts that are only reported.
EXACT_METRICS = (
    "fact_sale_rows",
    "fact_sale_total_incl",
    "fact_sale_total_excl",
    "fact_sale_quantity",
    "fact_sale_profit",
)
SHAPE_METRICS = ("dim_customer_rows", "dim_stockitem_rows", "dim_supplier_rows")


def fact_measures() -> list[Column]:
    """Row count and the sums of all measures."""
    return [
        F.count("*").alias("fact_sale_rows"),
        F.sum("Total_Including_Tax").cast(TOTAL).alias("fact_sale_total_incl"),
        F.sum("Total_Excluding_Tax").cast(TOTAL).alias("fact_sale_total_excl"),
        F.sum("Quantity").cast("bigint").alias("fact_sale_quantity"),
        F.sum("Profit").cast(TOTAL).alias("fact_sale_profit"),
    ]


def fact_totals(fact: DataFrame) -> DataFrame:
    """Row count and the sums of all measures in one pass."""
    return fact.agg(*fact_measures())


def control_totals(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """All eight totals as one row."""
    sizes = {f"dim_{name}_rows": df.agg(F.count("*").alias("n")).scalar() for name, df in dims.items()}
    return fact_totals(fact).select("*", *[size.alias(name) for name, size in sizes.items()]).select(*CONTROL_TOTALS.names)


def as_metrics(totals: DataFrame, value: str) -> DataFrame:
    """One (metric, value) row per total, all as decimals."""
    present = [c for c in CONTROL_TOTALS.names if c in totals.columns]
    return totals.select(*[F.col(c).cast(TOTAL).alias(c) for c in present]).unpivot([], present, "metric", value)


def reconcile(actual: DataFrame, expected: DataFrame, tolerance: str = TOLERANCE) -> DataFrame:
    """Status of every metric: PASS or FAIL for measures, INFO for row counts of dimensions.

    A missing value on either side of a measure fails.
    """
    pairs = as_metrics(expected, "expected").join(as_metrics(actual, "actual"), "metric", "full")
    close = F.abs(F.col("actual") - F.col("expected")) <= F.lit(tolerance).cast("decimal(18,6)")
    exact = F.col("metric").isin(*EXACT_METRICS)
    status = F.when(~exact, "INFO").when(F.coalesce(close, F.lit(False)), "PASS").otherwise("FAIL")
    return pairs.select("metric", "actual", "expected", exact.alias("exact"), status.alias("status"))


def verdict(reconciled: DataFrame) -> DataFrame:
    """One row: whether no exact measure failed, and how many did."""
    failed = F.count_if(F.col("status") == "FAIL")
    return reconciled.agg(
        (failed == 0).alias("passed"), failed.alias("failed"), F.count_if(F.col("exact")).alias("checked")
    )


def unresolved_keys(fact: DataFrame) -> DataFrame:
    """Lines whose customer or stock item is unknown."""
    return fact.where(F.col("Customer_Key").isNull() | F.col("Stock_Item_Key").isNull()).agg(
        F.count("*").alias("unresolved")
    )


def grain_check(fact: DataFrame, lines: DataFrame) -> DataFrame:
    """Fact rows against invoice lines; the difference is the lines without an invoice."""
    counted = lines.agg(F.count("*").alias("line_rows")).scalar()
    return fact.agg(F.count("*").alias("fact_rows")).select(
        "fact_rows", counted.alias("line_rows"), (F.col("fact_rows") == counted).alias("same_grain")
    )
