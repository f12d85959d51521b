"""Reconciliation, report arithmetic and labels on small hand-computed inputs."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.functions import bar_share, date_key, month_label
from starloom.plans import quality, reports
from starloom.sources.schemas import CONTROL_TOTALS

FACT = "Customer_Key bigint, Stock_Item_Key bigint, Invoice_Date date, Total_Including_Tax decimal(18,2)"


def totals(spark, **changed):
    usual = dict.fromkeys(CONTROL_TOTALS.names, 5)
    row = {**usual, "fact_sale_total_incl": Decimal("10.00"), "fact_sale_total_excl": Decimal("8.00"), "fact_sale_profit": Decimal("1.00"), **changed}
    return spark.createDataFrame([tuple(row[c] for c in CONTROL_TOTALS.names)], CONTROL_TOTALS)


def statuses(spark, **changed):
    reconciled = quality.reconcile(totals(spark, **changed), totals(spark))
    return {r["metric"]: r["status"] for r in reconciled.collect()}, quality.verdict(reconciled).first()


@pytest.mark.parametrize(
    "changed, metric, status, passed",
    [
        ({"fact_sale_total_incl": Decimal("10.01")}, "fact_sale_total_incl", "PASS", True),
        ({"fact_sale_total_incl": Decimal("10.02")}, "fact_sale_total_incl", "FAIL", False),
        ({"fact_sale_profit": None}, "fact_sale_profit", "FAIL", False),
        ({"fact_sale_rows": 6}, "fact_sale_rows", "FAIL", False),
        ({"dim_customer_rows": 9}, "dim_customer_rows", "INFO", True),
    ],
)
def test_reconcile(spark, changed, metric, status, passed):
    by_metric, verdict = statuses(spark, **changed)
    assert by_metric[metric] == status
    assert (verdict["passed"], verdict["checked"]) == (passed, 5)
    assert verdict["failed"] == (0 if passed else 1)


def test_an_empty_fact_fails(spark):
    empty = spark.createDataFrame([], FACT + ", Total_Excluding_Tax decimal(18,2), Quantity int, Profit decimal(18,2)")
    nothing = {name: spark.range(0) for name in ("customer", "stockitem", "supplier")}
    reconciled = quality.reconcile(quality.control_totals(empty, nothing), totals(spark))
    assert {r["status"] for r in reconciled.where("exact").collect()} == {"FAIL"}


@pytest.mark.parametrize(
    "values, shares", [([200, 25, 1, 0], [100, 12, 2, 2]), ([0, 0], [2, 2]), ([-4, -8], [100, 200]), ([1000, 125, 135], [100, 12, 14])]
)
def test_bar_share(spark, values, shares):
    report = spark.createDataFrame(list(enumerate(values)), "n int, revenue bigint")
    assert [r["share"] for r in reports.with_bar_share(report).orderBy("n").collect()] == shares


def test_bar_share_of_an_empty_report(spark):
    assert reports.with_bar_share(spark.createDataFrame([], "k string, revenue bigint")).collect() == []
    assert spark.range(1).select(bar_share(F.lit(5), F.lit(0)).alias("s")).first()["s"] == 500


def sales(spark):
    rows = [(1, 1, date(2020, 1, 5), "10.25"), (1, 2, date(2020, 1, 9), "0.25"), (2, 2, date(2020, 2, 1), "7.00"), (None, 3, None, "3.00")]
    return spark.createDataFrame([(c, i, d, Decimal(v)) for c, i, d, v in rows], FACT)


def test_kpis_and_labels(spark):
    kpis = reports.sales_kpis(sales(spark))
    assert kpis.collect() == [(21, 4, 2, Decimal("5.13"))]
    assert {r["label"]: r["value"] for r in reports.kpi_labels(kpis).collect()} == {
        "Ingresos (con IGV)": "S/ 21",
        "Líneas de venta": "4",
        "Clientes": "2",
        "Ticket promedio": "S/ 5.13",
    }


def test_labels_group_thousands(spark):
    kpis = spark.createDataFrame([(198043439, 228265, 663, Decimal("867.60"))], "revenue bigint, lines bigint, customers bigint, ticket decimal(18,2)")
    assert [r["value"] for r in reports.kpi_labels(kpis).collect()] == ["S/ 198,043,439", "228,265", "663", "S/ 867.60"]


def test_categories_label_the_missing_one_and_drop_unknown_customers(spark):
    dim = spark.createDataFrame([(1, None), (2, "Shop"), (3, "Idle")], "Customer_Key bigint, Category string")
    assert reports.revenue_by_category(sales(spark), dim).collect() == [("(sin categoría)", 11), ("Shop", 7)]
    check = reports.category_share_check(sales(spark), dim).first()
    assert (check["outside"], check["agrees"]) == (Decimal("3.00"), False)


def test_a_missing_month_sorts_last(spark):
    assert reports.revenue_by_month(sales(spark)).collect() == [("2020-01", 11), ("2020-02", 7), (None, 3)]


def test_items_of_one_name_count_together_and_ties_sort_by_name(spark):
    dim = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "Stock_Item_Key bigint, Stock_Item string")
    assert reports.top_items(sales(spark), dim, rows=1).collect() == [("x", 13)]
    assert reports.top_items(sales(spark), dim).collect() == [("x", 13), ("y", 7)]


def test_top_items_keeps_only_the_best_rows_per_task(spark):
    dim = spark.createDataFrame([(1, "x")], "Stock_Item_Key bigint, Stock_Item string")
    assert "TakeOrdered" in reports.top_items(sales(spark), dim)._jdf.queryExecution().executedPlan().toString()


def test_date_expressions(spark):
    days = spark.createDataFrame([(date(1995, 1, 1),), (date(2020, 12, 31),), (None,)], "d date")
    assert days.select(date_key(F.col("d")), month_label(F.col("d"))).collect() == [(19950101, "1995-01"), (20201231, "2020-12"), (None, None)]


def test_totals_above_what_a_line_can_hold(spark):
    line = Decimal("9999999999999999.99")
    fact = spark.createDataFrame([(1, 1, line, line, 1, line)] * 3, "Customer_Key bigint, Stock_Item_Key bigint, Total_Including_Tax decimal(18,2), Total_Excluding_Tax decimal(18,2), Quantity int, Profit decimal(18,2)")
    dims = {"customer": spark.range(1), "stockitem": spark.range(1), "supplier": spark.range(1)}
    found = quality.control_totals(fact, dims)
    assert found.first()["fact_sale_total_incl"] == 3 * line
    assert quality.verdict(quality.reconcile(found, found)).first()["passed"]


def test_ticket_leaves_out_unknown_amounts(spark):
    fact = spark.createDataFrame([(1, Decimal("10.00")), (2, None)], "Customer_Key bigint, Total_Including_Tax decimal(18,2)")
    row = reports.sales_kpis(fact).first()
    assert (row["lines"], row["ticket"]) == (2, Decimal("10.00"))
