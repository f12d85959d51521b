"""The operational, staging and control tables, derived from the star-schema test data.

Derived ids are pure expressions of one row, so nothing here shuffles unless the text says so.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.constants import END_OF_TIME, end_of_time
from starloom.operators.history import CUSTOMER, STOCK_ITEM, SUPPLIER, HistorySpec
from starloom.functions import date_key
from starloom.operators.lookup import VersionedDimension, look_up
from starloom.plans.dimensions import customer_attributes, stockitem_attributes, supplier_attributes
from starloom.plans.facts import fact_measures
from starloom.sources.landing import extract
from starloom.sources.schemas import OPERATIONAL

EPOCH = "1990-01-01"  # derived surrogate keys count days from here
BATCH_START = "2001-01-01"  # changes from this day on form the staged batch

# Order, line number, quantity and a mix of part and supplier, packed into one number: no smaller set
# of columns tells all lines apart.
LINE_ID = (
    "l_orderkey * 8388608 + l_linenumber * 1048576 + CAST(l_quantity AS INT) * 16384"
    " + (l_partkey * 31 + l_suppkey) % 16384"
)

DERIVATIONS = {
    "customers": (
        "customer",
        {
            "CustomerID": "c_custkey",
            "CustomerName": "c_name",
            "BillToCustomerID": "c_custkey - c_custkey % 10",
            "CustomerCategoryID": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey END",
            "BuyingGroupID": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 5 END",
            "PrimaryContactPersonID": "c_custkey % 100",
            "DeliveryPostalCode": "lpad(CAST(c_custkey % 1000 AS STRING), 5, '0')",
            "AccountOpenedDate": "date_add(DATE '1995-01-01', CAST(c_custkey % 365 AS INT))",
        },
    ),
    "customercategories": ("nation", {"CustomerCategoryID": "n_nationkey", "CustomerCategoryName": "n_name"}),
    "buyinggroups": ("region", {"BuyingGroupID": "r_regionkey", "BuyingGroupName": "r_name"}),
    "people": ("customer", {"PersonID": "c_custkey", "FullName": "c_name"}),
    "stockitems": (
        "part",
        {
            "StockItemID": "p_partkey",
            "StockItemName": "p_name",
            "SupplierID": "p_partkey % 10",
            "ColorID": "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_partkey % 5 END",
            "UnitPackageID": "p_size % 30",
            "OuterPackageID": "p_partkey % 25",
            "Brand": "p_brand",
            "Size": "p_type",
            "LeadTimeDays": "p_size % 14",
            "QuantityPerOuter": "p_size",
            "IsChillerStock": "p_partkey % 7 = 0",
            "Barcode": "CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE lpad(CAST(p_partkey AS STRING), 13, '0') END",
            "TaxRate": "CAST(p_size % 4 * 5 AS DECIMAL(18,3))",
            "UnitPrice": "CAST(p_retailprice AS DECIMAL(18,2))",
            "RecommendedRetailPrice": (
                "CASE WHEN p_partkey % 6 = 0 THEN NULL"
                " ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(1.5 AS DECIMAL(2,1)) AS DECIMAL(18,2)) END"
            ),
            "TypicalWeightPerUnit": "CAST(p_size * CAST(0.125 AS DECIMAL(4,3)) AS DECIMAL(18,3))",
        },
    ),
    "colors": ("region", {"ColorID": "r_regionkey", "ColorName": "r_name"}),
    "packagetypes": ("nation", {"PackageTypeID": "n_nationkey", "PackageTypeName": "n_name"}),
    "suppliers": (
        "supplier",
        {
            "SupplierID": "s_suppkey",
            "SupplierName": "s_name",
            "SupplierCategoryID": "s_nationkey",
            "PrimaryContactPersonID": "s_suppkey",
            "SupplierReference": "CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE concat('REF-', s_suppkey) END",
            "PaymentDays": "s_suppkey % 3 * 7 + 7",
            "DeliveryPostalCode": "lpad(CAST(s_suppkey % 1000 AS STRING), 5, '0')",
        },
    ),
    "suppliercategories": ("nation", {"SupplierCategoryID": "n_nationkey", "SupplierCategoryName": "n_name"}),
    "invoices": (
        "orders",
        {
            "InvoiceID": "o_orderkey",
            "CustomerID": "CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_custkey END",
            "BillToCustomerID": "o_custkey - o_custkey % 10",
            "SalespersonPersonID": "o_custkey % 10",
            "InvoiceDate": "CAST(o_orderdate AS DATE)",
            "LastEditedWhen": "o_orderdate",
            "TotalDryItems": "CAST(o_orderkey % 5 AS INT)",
            "TotalChillerItems": "CAST(o_orderkey % 3 AS INT)",
        },
    ),
    "invoicelines": (
        "lineitem",
        {
            "InvoiceLineID": LINE_ID,
            "InvoiceID": "CASE WHEN l_partkey % 499 = 0 THEN NULL ELSE l_orderkey END",
            "StockItemID": "CASE WHEN l_orderkey % 103 = 0 THEN -1 ELSE l_partkey END",
            "Description": "concat(l_returnflag, l_linestatus, '-', l_partkey)",
            "PackageTypeID": "l_linenumber % 4",
            "Quantity": "CAST(l_quantity AS INT)",
            "UnitPrice": "CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE CAST(900 + l_partkey % 1000 AS DECIMAL(18,2)) END",
            "TaxRate": "CAST(CAST(l_tax AS DECIMAL(6,3)) * 100 AS DECIMAL(18,3))",
            "TaxAmount": "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(6,3)) AS DECIMAL(18,2))",
            "LineProfit": "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(6,3)) AS DECIMAL(18,2))",
            "ExtendedPrice": "CAST(l_extendedprice AS DECIMAL(18,2))",
            "LastEditedWhen": "l_shipdate",
        },
    ),
}


RAW = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table by its declared schema, so that no job reads file footers to infer it."""
    return spark.read.schema(RAW[table]).parquet(f"{sf_dir}/{table}.parquet")


class OperationalTables(Mapping):
    """The eleven operational tables, each read when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._read:
            table, columns = DERIVATIONS[name]
            derived = raw(self.spark, self.sf_dir, table).selectExpr(*[f"{sql} AS {column}" for column, sql in columns.items()])
            self._read[name] = extract(derived, OPERATIONAL[name])
        return self._read[name]

    def __iter__(self):
        return iter(DERIVATIONS)

    def __len__(self):
        return len(DERIVATIONS)


def _versions(changes: DataFrame, key: str, day: str, business_key: str) -> DataFrame:
    """Validity intervals from change days: each version ends where the key's next one starts.

    A key has at most one change per calendar day, which bounds its set of days. Tasks unite the days they saw, so rows are shuffled once.
    """
    day_of = F.struct(F.col(day).cast("date").alias("_day"))  # a set drops a plain NULL
    days = changes.groupBy(F.col(key).alias(business_key)).agg(F.sort_array(F.collect_set(day_of)).alias("_days"))
    starts = days.select(business_key, "_days", F.posexplode("_days").alias("_at", "_start"))
    next_day = F.get("_days", F.col("_at") + 1)["_day"]
    return starts.select(
        business_key,
        F.col("_start._day").cast("timestamp_ntz").alias("Valid_From"),
        F.coalesce(next_day.cast("timestamp_ntz"), end_of_time()).alias("Valid_To"),
    )


def _keyed(versions: DataFrame, business_key: str, surrogate: str) -> DataFrame:
    """A key that is unique per version and known from the version alone."""
    days = F.date_diff(F.col("Valid_From").cast("date"), F.lit(EPOCH).cast("date"))
    return versions.withColumn(surrogate, F.col(business_key) * 100000 + days)


def customer_history(spark: SparkSession, sf_dir: str) -> VersionedDimension:
    versions = _versions(raw(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "WWI_Customer_ID")
    return VersionedDimension(_keyed(versions, "WWI_Customer_ID", "Customer_Key"), "WWI_Customer_ID", "Customer_Key")


def stockitem_history(spark: SparkSession, sf_dir: str) -> VersionedDimension:
    versions = _versions(raw(spark, sf_dir, "lineitem"), "l_partkey", "l_shipdate", "WWI_Stock_Item_ID")
    return VersionedDimension(_keyed(versions, "WWI_Stock_Item_ID", "Stock_Item_Key"), "WWI_Stock_Item_ID", "Stock_Item_Key")


def employee_history(spark: SparkSession, sf_dir: str) -> VersionedDimension:
    versions = _versions(raw(spark, sf_dir, "lineitem"), "l_suppkey", "l_shipdate", "WWI_Employee_ID")
    return VersionedDimension(_keyed(versions, "WWI_Employee_ID", "Employee_Key"), "WWI_Employee_ID", "Employee_Key")


def city_history(spark: SparkSession, sf_dir: str) -> VersionedDimension:
    """One open version per city from 1996 on, so that earlier lines find none."""
    cities = raw(spark, sf_dir, "nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS WWI_City_ID",
        "CAST(n_nationkey + 1 AS BIGINT) AS City_Key",
        "TIMESTAMP_NTZ '1996-01-01 00:00:00' AS Valid_From",
        f"TIMESTAMP_NTZ '{END_OF_TIME}' AS Valid_To",
    )
    return VersionedDimension(cities, "WWI_City_ID", "City_Key")


def sale_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged sale lines: all that the fact holds, and the business ids and the time that the key lookups need.

    Orders get their city before lines multiply them, and lines are shuffled once, in the columns they are derived from. The rows
    come out dealt by their invoice, which a later join on it can use.
    """
    tables = OperationalTables(spark, sf_dir)
    derived = ("InvoiceLineID", "Description", "PackageTypeID", "Quantity", "UnitPrice", "TaxRate", "TaxAmount", "LineProfit", "ExtendedPrice")
    home = raw(spark, sf_dir, "customer").selectExpr("c_custkey", "CAST(c_nationkey AS BIGINT) AS WWI_City_ID")
    orders = raw(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey AS WWI_Customer_ID", "o_custkey - o_custkey % 10 AS WWI_Bill_To_Customer_ID",
        "CAST(o_orderdate AS DATE) AS Invoice_Date", "CAST(o_orderkey % 5 AS INT) AS Total_Dry_Items", "CAST(o_orderkey % 3 AS INT) AS Total_Chiller_Items",
    )
    orders = orders.join(home, F.col("WWI_Customer_ID") == F.col("c_custkey"), "left")
    staged = raw(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        *orders.columns, "l_orderkey", "l_suppkey AS WWI_Salesperson_ID", "l_partkey AS WWI_Stock_Item_ID", "l_shipdate AS Last_Modified_When",
        "date_add(CAST(l_shipdate AS DATE), l_linenumber) AS Delivery_Date", *[f"{DERIVATIONS['invoicelines'][1][c]} AS {c}" for c in derived],
    )
    staged = look_up(fact_measures(staged), "PackageTypeID", tables["packagetypes"], "PackageTypeID", {"PackageTypeName": "Package"})
    return staged.select(
        F.col("InvoiceLineID").alias("Sale_Key"), "WWI_City_ID", "WWI_Customer_ID", "WWI_Bill_To_Customer_ID", "WWI_Stock_Item_ID",
        "WWI_Salesperson_ID", "Last_Modified_When", "Invoice_Date", date_key(F.col("Invoice_Date")).alias("Invoice_Date_Key"),
        date_key(F.col("Delivery_Date")).alias("Delivery_Date_Key"), F.col("l_orderkey").alias("WWI_Invoice_ID"), "Description", "Package",
        "Quantity", F.col("UnitPrice").alias("Unit_Price"), F.col("TaxRate").alias("Tax_Rate"), "Total_Excluding_Tax", "Tax_Amount", "Profit",
        "Total_Including_Tax", "Total_Dry_Items", "Total_Chiller_Items",
    )


def _customer_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    return customer_attributes(tables["customers"], tables).select(
        F.col("CustomerID").alias("WWI_Customer_ID"), F.col("CustomerName").alias("Customer"), "Bill_To_Customer", "Category",
        "Buying_Group", "Primary_Contact", F.col("DeliveryPostalCode").alias("Postal_Code"),
    )


def _stockitem_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    return stockitem_attributes(tables["stockitems"], tables).select(
        F.col("StockItemID").alias("WWI_Stock_Item_ID"), F.col("StockItemName").alias("Stock_Item"), "Color", "Selling_Package",
        "Buying_Package", "Brand", "Size", F.col("LeadTimeDays").alias("Lead_Time_Days"),
        F.col("QuantityPerOuter").alias("Quantity_Per_Outer"), F.col("IsChillerStock").alias("Is_Chiller_Stock"), "Barcode",
        F.col("TaxRate").alias("Tax_Rate"), F.col("UnitPrice").alias("Unit_Price"),
        F.col("RecommendedRetailPrice").alias("Recommended_Retail_Price"), F.col("TypicalWeightPerUnit").alias("Typical_Weight_Per_Unit"),
        F.lit(None).cast("binary").alias("Photo"),
    )


def _supplier_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    return supplier_attributes(tables["suppliers"], tables).select(
        F.col("SupplierID").alias("WWI_Supplier_ID"), F.col("SupplierName").alias("Supplier"), "Category", "Primary_Contact",
        F.col("SupplierReference").alias("Supplier_Reference"), F.col("PaymentDays").alias("Payment_Days"),
        F.col("DeliveryPostalCode").alias("Postal_Code"),
    )


# Per dimension: its rows, the table whose dates mark changes, and the key and date columns there.
_CHANGES = {
    CUSTOMER.table: (_customer_rows, "orders", "o_custkey", "o_orderdate"),
    STOCK_ITEM.table: (_stockitem_rows, "lineitem", "l_partkey", "l_shipdate"),
    SUPPLIER.table: (_supplier_rows, "lineitem", "l_suppkey", "l_shipdate"),
}


def dimension_base(spark: SparkSession, sf_dir: str, spec: HistorySpec) -> DataFrame:
    """One open version per business key, from the key's first change day."""
    rows, table, key, day = _CHANGES[spec.table]
    first = raw(spark, sf_dir, table).groupBy(F.col(key).alias("_bk")).agg(F.min(day).alias("Valid_From"))
    described = rows(OperationalTables(spark, sf_dir))
    return first.join(described, F.col("_bk") == F.col(spec.business_key)).select(
        (F.col(spec.business_key) + 1).alias(spec.surrogate), *described.columns, "Valid_From",
        end_of_time().alias("Valid_To"), F.lit(1).cast("bigint").alias("Lineage_Key"),
    )


def dimension_batch(spark: SparkSession, sf_dir: str, spec: HistorySpec) -> DataFrame:
    """The versions that start on or after the batch day."""
    rows, table, key, day = _CHANGES[spec.table]
    recent = raw(spark, sf_dir, table).where(F.col(day) >= F.lit(BATCH_START).cast("timestamp_ntz"))
    described = rows(OperationalTables(spark, sf_dir))
    versions = _versions(recent, key, day, "_bk")
    return versions.join(described, F.col("_bk") == F.col(spec.business_key)).select(*described.columns, "Valid_From", "Valid_To")


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load per event: errors are unfinished loads, except that employee loads finish and fail."""
    return raw(spark, sf_dir, "events").selectExpr(
        "event_id + 1 AS Lineage_Key",
        "ts AS Data_Load_Started",
        "CASE event_id % 5 WHEN 0 THEN 'Customer' WHEN 1 THEN 'Stock Item' WHEN 2 THEN 'Supplier' WHEN 3 THEN 'Sale' ELSE 'Employee' END AS Table_Name",
        "CASE WHEN event_id % 5 <> 4 AND event_type = 'error' THEN NULL ELSE ts + INTERVAL 1 HOUR END AS Data_Load_Completed",
        "event_type <> 'error' AS Was_Successful",
        "CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ) AS Source_System_Cutoff_Time",
    )


def cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage(spark, sf_dir).groupBy("Table_Name").agg(F.min("Source_System_Cutoff_Time").alias("Cutoff_Time"))


def loaded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines stamped with the load that brought them in."""
    lines = OperationalTables(spark, sf_dir)["invoicelines"]
    return lines.select("InvoiceLineID", "InvoiceID", "ExtendedPrice", (F.col("InvoiceLineID") % 1000 + 1).alias("Lineage_Key"))
