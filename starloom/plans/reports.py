"""Sales reports over the fact and its dimensions.

Revenue is summed per surrogate key first, inside the scan tasks, so that only one row per key and
task travels to the dimension join, however many lines a popular key has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.constants import (
    KPI_CUSTOMERS,
    KPI_LINES,
    KPI_REVENUE,
    KPI_TICKET,
    TOTAL,
    TOP_ITEMS,
    UNCATEGORISED,
)
from starloom.functions import bar_share, grouped_digits, money_label, month_label, whole_units
from starloom.functions.expressions import ticket

REVENUE = "Total_Including_Tax"


def _revenue_per_key(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(F.sum(REVENUE).alias("_revenue"))


def sales_kpis(fact: DataFrame) -> DataFrame:
    """Revenue, number of lines, distinct customers and mean of the amounts that are known."""
    per_customer = fact.groupBy("Customer_Key").agg(
        F.sum(REVENUE).alias("_revenue"), F.count("*").alias("_lines"), F.count(REVENUE).alias("_amounts")
    )
    total, lines = F.sum("_revenue"), F.sum("_lines")
    return per_customer.agg(
        whole_units(total).alias("revenue"),
        F.coalesce(lines, F.lit(0)).alias("lines"),
        F.count("Customer_Key").alias("customers"),
        ticket(total, F.sum("_amounts")).alias("ticket"),
    )


def category_revenue(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Unrounded revenue per customer category; lines without a customer drop out."""
    labelled = dim_customer.select("Customer_Key", F.coalesce("Category", F.lit(UNCATEGORISED)).alias("category"))
    return (
        _revenue_per_key(fact, "Customer_Key").join(labelled, "Customer_Key").groupBy("category").agg(F.sum("_revenue").alias("amount"))
    )


def revenue_by_category(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return (
        category_revenue(fact, dim_customer)
        .select("category", whole_units(F.col("amount")).alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc_nulls_last("category"))
    )


def revenue_by_month(fact: DataFrame) -> DataFrame:
    """Revenue per calendar month; months are grouped as dates and formatted afterwards."""
    monthly = fact.groupBy(F.trunc("Invoice_Date", "month").alias("_month")).agg(F.sum(REVENUE).alias("_revenue"))
    return monthly.select(month_label(F.col("_month")).alias("month"), whole_units(F.col("_revenue")).alias("revenue")).orderBy(
        F.asc_nulls_last("month")
    )


def top_items(fact: DataFrame, dim_stockitem: DataFrame, rows: int = TOP_ITEMS) -> DataFrame:
    """The best-selling item names; items that share a name count together."""
    names = dim_stockitem.select("Stock_Item_Key", F.col("Stock_Item").alias("item"))
    sold = _revenue_per_key(fact, "Stock_Item_Key").join(names, "Stock_Item_Key").groupBy("item").agg(F.sum("_revenue").alias("_total"))
    return (
        sold.select("item", whole_units(F.col("_total")).alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc_nulls_last("item"))
        .limit(rows)
    )


def with_bar_share(report: DataFrame, value: str = "revenue") -> DataFrame:
    """Add each bar's width in percent. The report holds one row per bar of a chart, not per fact line."""
    whole_chart = Window.partitionBy()
    return report.withColumn("share", bar_share(F.col(value), F.max(value).over(whole_chart)))


def kpi_labels(kpis: DataFrame) -> DataFrame:
    """The four headline figures as printed, one row each."""
    cards = F.array(
        F.struct(F.lit(KPI_REVENUE).alias("label"), money_label(F.col("revenue")).alias("value")),
        F.struct(F.lit(KPI_LINES).alias("label"), grouped_digits(F.col("lines")).alias("value")),
        F.struct(F.lit(KPI_CUSTOMERS).alias("label"), grouped_digits(F.col("customers")).alias("value")),
        F.struct(F.lit(KPI_TICKET).alias("label"), money_label(F.col("ticket"), 2).alias("value")),
    )
    return kpis.select(F.inline(cards))


def bar_labels(report: DataFrame, value: str = "revenue") -> DataFrame:
    """Add the printed amount of each bar."""
    return report.withColumn("label", money_label(F.col(value)))


def category_share_check(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Whether the categories add up to the total, and what lies outside any customer."""
    categories = category_revenue(fact, dim_customer).agg(F.sum("amount").alias("amount")).scalar()
    total = fact.agg(F.sum(REVENUE).cast(TOTAL).alias("total"))
    return total.select(
        "total",
        categories.cast(TOTAL).alias("categories"),
        (F.col("total") - categories).cast(TOTAL).alias("outside"),
        (F.col("total") == categories).alias("agrees"),
    )
