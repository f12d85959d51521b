"""Current-state customer, stock-item and supplier dimensions from the operational tables.

The surrogate key follows the business key. Rows are numbered before any label is looked up, so the
sort carries source columns only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.constants import end_of_time_date
from starloom.operators.lookup import look_up
from starloom.operators.ordered import dense_keys

Tables = Mapping[str, DataFrame]


def customer_attributes(customers: DataFrame, tables: Tables) -> DataFrame:
    """Add category, buying group, contact and bill-to names; the last comes from customers itself."""
    df = look_up(
        customers, "CustomerCategoryID", tables["customercategories"], "CustomerCategoryID", {"CustomerCategoryName": "Category"}
    )
    df = look_up(df, "BuyingGroupID", tables["buyinggroups"], "BuyingGroupID", {"BuyingGroupName": "Buying_Group"})
    df = look_up(df, "PrimaryContactPersonID", tables["people"], "PersonID", {"FullName": "Primary_Contact"})
    return bill_to_name(df, tables["customers"])


def bill_to_name(df: DataFrame, customers: DataFrame) -> DataFrame:
    return look_up(df, "BillToCustomerID", customers, "CustomerID", {"CustomerName": "Bill_To_Customer"})


def dim_customer(tables: Tables) -> DataFrame:
    keyed = dense_keys(tables["customers"], ["CustomerID"], "Customer_Key")
    return customer_attributes(keyed, tables).select(
        "Customer_Key",
        F.col("CustomerID").alias("WWI_Customer_ID"),
        F.col("CustomerName").alias("Customer"),
        "Bill_To_Customer",
        "Category",
        "Buying_Group",
        "Primary_Contact",
        F.col("DeliveryPostalCode").alias("Postal_Code"),
        F.col("AccountOpenedDate").cast("date").alias("Valid_From"),
        end_of_time_date().alias("Valid_To"),
    )


def stockitem_attributes(stockitems: DataFrame, tables: Tables) -> DataFrame:
    """Add colour and the selling and buying package; both packages read one table alike."""
    df = look_up(stockitems, "ColorID", tables["colors"], "ColorID", {"ColorName": "Color"})
    for column, role in (("UnitPackageID", "Selling_Package"), ("OuterPackageID", "Buying_Package")):
        df = look_up(df, column, tables["packagetypes"], "PackageTypeID", {"PackageTypeName": role})
    return df


def dim_stockitem(tables: Tables) -> DataFrame:
    keyed = dense_keys(tables["stockitems"], ["StockItemID"], "Stock_Item_Key")
    return stockitem_attributes(keyed, tables).select(
        "Stock_Item_Key",
        F.col("StockItemID").alias("WWI_Stock_Item_ID"),
        F.col("StockItemName").alias("Stock_Item"),
        "Color",
        "Selling_Package",
        "Buying_Package",
        "Brand",
        "Size",
        F.col("LeadTimeDays").alias("Lead_Time_Days"),
        F.col("QuantityPerOuter").alias("Quantity_Per_Outer"),
        F.col("IsChillerStock").alias("Is_Chiller_Stock"),
        F.col("TaxRate").alias("Tax_Rate"),
        F.col("UnitPrice").alias("Unit_Price"),
        F.col("RecommendedRetailPrice").alias("Recommended_Retail_Price"),
        F.col("TypicalWeightPerUnit").alias("Typical_Weight_Per_Unit"),
    )


def supplier_attributes(suppliers: DataFrame, tables: Tables) -> DataFrame:
    df = look_up(
        suppliers, "SupplierCategoryID", tables["suppliercategories"], "SupplierCategoryID", {"SupplierCategoryName": "Category"}
    )
    return look_up(df, "PrimaryContactPersonID", tables["people"], "PersonID", {"FullName": "Primary_Contact"})


def dim_supplier(tables: Tables) -> DataFrame:
    keyed = dense_keys(tables["suppliers"], ["SupplierID"], "Supplier_Key")
    return supplier_attributes(keyed, tables).select(
        "Supplier_Key",
        F.col("SupplierID").alias("WWI_Supplier_ID"),
        F.col("SupplierName").alias("Supplier"),
        "Category",
        "Primary_Contact",
        F.col("SupplierReference").alias("Supplier_Reference"),
        F.col("PaymentDays").alias("Payment_Days"),
        F.col("DeliveryPostalCode").alias("Postal_Code"),
    )


def dim_preview(dimension: DataFrame, key: str, rows: int) -> DataFrame:
    """The first rows of a dimension by key."""
    return dimension.orderBy(key).limit(rows)
