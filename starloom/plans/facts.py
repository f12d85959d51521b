"""The sales fact: one row per invoice line, with surrogate keys and exact measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import date_key
from starloom.operators.lookup import look_up

FACT_COLUMNS = (
    "Sale_Key",
    "Customer_Key",
    "Bill_To_Customer_Key",
    "Stock_Item_Key",
    "Invoice_Date",
    "Invoice_Date_Key",
    "WWI_Salesperson_ID",
    "WWI_Invoice_ID",
    "Description",
    "Package",
    "Quantity",
    "Unit_Price",
    "Tax_Rate",
    "Total_Excluding_Tax",
    "Tax_Amount",
    "Profit",
    "Total_Including_Tax",
)


# The fact as the incremental load keeps it: keys of all five roles, dates, measures and the load's number.
LOADED_COLUMNS = (
    "City_Key",
    "Customer_Key",
    "Bill_To_Customer_Key",
    "Stock_Item_Key",
    "Invoice_Date_Key",
    "Delivery_Date_Key",
    "Salesperson_Key",
    "WWI_Invoice_ID",
    "Description",
    "Package",
    "Quantity",
    "Unit_Price",
    "Tax_Rate",
    "Total_Excluding_Tax",
    "Tax_Amount",
    "Profit",
    "Total_Including_Tax",
    "Total_Dry_Items",
    "Total_Chiller_Items",
    "Lineage_Key",
)


def fact_measures(lines: DataFrame) -> DataFrame:
    """Total excluding tax, tax, profit and total including tax of every line."""
    return lines.select(
        *lines.columns,
        (F.col("ExtendedPrice") - F.col("TaxAmount")).cast("decimal(18,2)").alias("Total_Excluding_Tax"),
        F.col("TaxAmount").alias("Tax_Amount"),
        F.col("LineProfit").alias("Profit"),
        F.col("ExtendedPrice").alias("Total_Including_Tax"),
    )


def resolve_customer_keys(
    invoices: DataFrame, dim_customer: DataFrame, outputs: Sequence[str] = ("Customer_Key", "Bill_To_Customer_Key")
) -> DataFrame:
    """Customer and bill-to keys of every invoice; an unknown customer leaves NULL."""
    roles = {"Customer_Key": "CustomerID", "Bill_To_Customer_Key": "BillToCustomerID"}
    for output in outputs:
        invoices = look_up(invoices, roles[output], dim_customer, "WWI_Customer_ID", {"Customer_Key": output})
    return invoices


def fact_sale(
    tables: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], columns: Sequence[str] = FACT_COLUMNS
) -> DataFrame:
    """Build the fact, or the given columns of it.

    Customer keys are resolved per invoice, before lines multiply the rows, so the wide line rows
    shuffle once for their invoice and the dimension joins on them stay map-side where the table is
    small. A lookup whose key or label is not asked for is not joined at all. Lines without an
    invoice drop out.
    """
    wanted = set(columns)
    customer_roles = [c for c in ("Customer_Key", "Bill_To_Customer_Key") if c in wanted]
    headers = tables["invoices"]
    if customer_roles:
        headers = resolve_customer_keys(headers, dims["customer"], customer_roles)
    headers = headers.select(
        "InvoiceID",
        *customer_roles,
        F.col("InvoiceDate").alias("Invoice_Date"),
        date_key(F.col("InvoiceDate")).alias("Invoice_Date_Key"),
        F.col("SalespersonPersonID").alias("WWI_Salesperson_ID"),
    )
    lines = fact_measures(tables["invoicelines"])
    if "Stock_Item_Key" in wanted:
        lines = look_up(lines, "StockItemID", dims["stockitem"], "WWI_Stock_Item_ID", {"Stock_Item_Key": "Stock_Item_Key"})
    if "Package" in wanted:
        lines = look_up(lines, "PackageTypeID", tables["packagetypes"], "PackageTypeID", {"PackageTypeName": "Package"})
    named = {
        "Sale_Key": "InvoiceLineID",
        "WWI_Invoice_ID": "InvoiceID",
        "Unit_Price": "UnitPrice",
        "Tax_Rate": "TaxRate",
    }
    return lines.join(headers, "InvoiceID").select(*[F.col(named.get(c, c)).alias(c) for c in columns])
