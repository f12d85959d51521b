"""Sums per month that loads keep up, so that reports need not read the lines.

A load that rewrites a month also writes the month's sums per customer and per item, and its customers as exact bitmaps. They are stored and
chosen like the month's lines, so readers always see sums of the lines that they see. Sums of different months add up;
bitmaps of different months are united before they are counted, so that a customer counts once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.constants import TOTAL
from starloom.functions import month_label, whole_units
from starloom.functions.expressions import ticket
from starloom.plans import months, reports
from starloom.plans.months import MONTH, STORED_BY
from starloom.plans.reports import REVENUE

CUSTOMER, ITEM = "Customer_Key", "Stock_Item_Key"
PER_CUSTOMER, PER_ITEM, BUYERS = "per_customer", "per_item", "buyers"
SCHEMAS = {
    PER_CUSTOMER: f"{CUSTOMER} bigint, {REVENUE} {TOTAL.simpleString()}, lines bigint, amounts bigint",
    PER_ITEM: f"{ITEM} bigint, {REVENUE} {TOTAL.simpleString()}",
    BUYERS: "bucket bigint, customers binary",
}


@dataclass(frozen=True)
class Summaries:
    """The visible sums per month and customer, per month and item, and the customers per month."""

    per_customer: DataFrame
    per_item: DataFrame
    buyers: DataFrame


def summarise(lines: DataFrame) -> Summaries:
    revenue = F.sum(REVENUE).cast(TOTAL).alias(REVENUE)
    key = F.col(CUSTOMER)
    placed = lines.where(key.isNotNull()).select(MONTH, F.bitmap_bucket_number(key).alias("bucket"), F.bitmap_bit_position(key).alias("bit"))
    return Summaries(
        lines.groupBy(MONTH, CUSTOMER).agg(revenue, F.count("*").alias("lines"), F.count(REVENUE).alias("amounts")),
        lines.groupBy(MONTH, ITEM).agg(revenue),
        placed.groupBy(MONTH, "bucket").agg(F.bitmap_construct_agg("bit").alias("customers")),
    )


def store(spark: SparkSession, folder: str, load: int) -> None:
    """Sum up the months that a load has written, from its own files. A retry replaces them."""
    lines = months.read_load(spark, folder, load, f"{CUSTOMER} bigint, {ITEM} bigint, {REVENUE} decimal(18,2)")
    if lines is None:
        return
    found = summarise(lines)
    for name in SCHEMAS:
        stamped = getattr(found, name).withColumn(STORED_BY, F.lit(load).cast("bigint"))
        writer = stamped.hint("rebalance", MONTH).write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(STORED_BY, MONTH).parquet(f"{folder}/{name}")


def read(spark: SparkSession, folder: str, lineage: DataFrame) -> Summaries:
    """Of every month the sums by the newest successful load that touched it."""
    parsed = {name: spark.createDataFrame([], schema).schema for name, schema in SCHEMAS.items()}
    return Summaries(**{name: months.read_months(spark, folder, lineage, schema, name) for name, schema in parsed.items()})


def sales_kpis(sums: Summaries) -> DataFrame:
    """As ``reports.sales_kpis``."""
    united = sums.buyers.groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("customers")).alias("n"))
    customers = united.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("customers")).scalar()
    total = F.sum(REVENUE)
    return sums.per_customer.agg(
        whole_units(total).alias("revenue"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
        customers.alias("customers"),
        ticket(total, F.sum("amounts")).alias("ticket"),
    )


def revenue_by_category(sums: Summaries, dim_customer: DataFrame) -> DataFrame:
    return reports.revenue_by_category(sums.per_customer, dim_customer)


def top_items(sums: Summaries, dim_stockitem: DataFrame) -> DataFrame:
    return reports.top_items(sums.per_item, dim_stockitem)


def revenue_by_month(sums: Summaries) -> DataFrame:
    """As ``reports.revenue_by_month``; month 0 holds the lines without a date."""
    first_day = F.when(F.col(MONTH) > 0, F.make_date(F.floor(F.col(MONTH) / 100).cast("int"), F.col(MONTH) % 100, F.lit(1)))
    monthly = sums.per_customer.groupBy(MONTH).agg(F.sum(REVENUE).alias("_revenue"))
    return monthly.select(month_label(first_day).alias("month"), whole_units(F.col("_revenue")).alias("revenue")).orderBy(F.asc_nulls_last("month"))
