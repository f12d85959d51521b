"""Schemas of the eleven operational tables, the control tables and the control totals."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from starloom.constants import MONEY, RATE, TOTAL

_TYPES = {
    "bigint": LongType(),
    "int": IntegerType(),
    "string": StringType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp_ntz": TimestampNTZType(),
    "money": MONEY,
    "total": TOTAL,
    "rate": RATE,
}


def _schema(columns: str) -> StructType:
    """Types by name, so that a schema can be declared before any session exists."""
    pairs = [column.split() for column in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# Money is decimal and postal codes are text: neither survives type inference from text files.
OPERATIONAL = {
    "customers": _schema(
        "CustomerID bigint, CustomerName string, BillToCustomerID bigint, CustomerCategoryID bigint,"
        "BuyingGroupID bigint, PrimaryContactPersonID bigint, DeliveryPostalCode string, AccountOpenedDate date"
    ),
    "customercategories": _schema("CustomerCategoryID bigint, CustomerCategoryName string"),
    "buyinggroups": _schema("BuyingGroupID bigint, BuyingGroupName string"),
    "people": _schema("PersonID bigint, FullName string"),
    "stockitems": _schema(
        "StockItemID bigint, StockItemName string, SupplierID bigint, ColorID bigint, UnitPackageID bigint,"
        "OuterPackageID bigint, Brand string, Size string, LeadTimeDays int, QuantityPerOuter int,"
        "IsChillerStock boolean, Barcode string, TaxRate rate, UnitPrice money, RecommendedRetailPrice money,"
        "TypicalWeightPerUnit rate"
    ),
    "colors": _schema("ColorID bigint, ColorName string"),
    "packagetypes": _schema("PackageTypeID bigint, PackageTypeName string"),
    "suppliers": _schema(
        "SupplierID bigint, SupplierName string, SupplierCategoryID bigint, PrimaryContactPersonID bigint,"
        "SupplierReference string, PaymentDays int, DeliveryPostalCode string"
    ),
    "suppliercategories": _schema("SupplierCategoryID bigint, SupplierCategoryName string"),
    "invoices": _schema(
        "InvoiceID bigint, CustomerID bigint, BillToCustomerID bigint, SalespersonPersonID bigint,"
        "InvoiceDate date, LastEditedWhen timestamp_ntz, TotalDryItems int, TotalChillerItems int"
    ),
    "invoicelines": _schema(
        "InvoiceLineID bigint, InvoiceID bigint, StockItemID bigint, Description string, PackageTypeID bigint,"
        "Quantity int, UnitPrice money, TaxRate rate, TaxAmount money, LineProfit money, ExtendedPrice money,"
        "LastEditedWhen timestamp_ntz"
    ),
}

# The source's table behind each operational one, and its key.
SOURCE_TABLES = {
    "customers": ("Sales.Customers", "CustomerID"),
    "customercategories": ("Sales.CustomerCategories", "CustomerCategoryID"),
    "buyinggroups": ("Sales.BuyingGroups", "BuyingGroupID"),
    "people": ("Application.People", "PersonID"),
    "stockitems": ("Warehouse.StockItems", "StockItemID"),
    "colors": ("Warehouse.Colors", "ColorID"),
    "packagetypes": ("Warehouse.PackageTypes", "PackageTypeID"),
    "suppliers": ("Purchasing.Suppliers", "SupplierID"),
    "suppliercategories": ("Purchasing.SupplierCategories", "SupplierCategoryID"),
    "invoices": ("Sales.Invoices", "InvoiceID"),
    "invoicelines": ("Sales.InvoiceLines", "InvoiceLineID"),
}

LINEAGE = _schema(
    "Lineage_Key bigint, Data_Load_Started timestamp_ntz, Table_Name string, Data_Load_Completed timestamp_ntz,"
    "Was_Successful boolean, Source_System_Cutoff_Time timestamp_ntz"
)
CUTOFFS = _schema("Table_Name string, Cutoff_Time timestamp_ntz")
CONTROL_TOTALS = _schema(
    "fact_sale_rows bigint, fact_sale_total_incl total, fact_sale_total_excl total, fact_sale_quantity bigint,"
    "fact_sale_profit total, dim_customer_rows bigint, dim_stockitem_rows bigint, dim_supplier_rows bigint"
)
LOADED_SALE = _schema(
    "City_Key bigint, Customer_Key bigint, Bill_To_Customer_Key bigint, Stock_Item_Key bigint, Invoice_Date_Key int, Delivery_Date_Key int,"
    "Salesperson_Key bigint, WWI_Invoice_ID bigint, Description string, Package string, Quantity int, Unit_Price money, Tax_Rate rate,"
    "Total_Excluding_Tax money, Tax_Amount money, Profit money, Total_Including_Tax money, Total_Dry_Items int, Total_Chiller_Items int,"
    "Lineage_Key bigint"
)
