"""The SQL each query is checked against, in the plain form: correlated lookups, global numbering, IN lists.

The texts run on another engine over the raw test tables and share no code with the Spark side.
"""

from __future__ import annotations

END = "TIMESTAMP '9999-12-31 23:59:59.999999'"

# The operational, staging and control tables as views over the raw ones.
VIEWS = {
    "customers": """
        SELECT c_custkey AS CustomerID, c_name AS CustomerName,
               (c_custkey - c_custkey % 10)::BIGINT AS BillToCustomerID,
               CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey END::BIGINT AS CustomerCategoryID,
               CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 5 END::BIGINT AS BuyingGroupID,
               (c_custkey % 100)::BIGINT AS PrimaryContactPersonID,
               lpad((c_custkey % 1000)::VARCHAR, 5, '0') AS DeliveryPostalCode,
               (DATE '1995-01-01' + (c_custkey % 365)::INTEGER)::DATE AS AccountOpenedDate
        FROM customer""",
    "stockitems": """
        SELECT p_partkey AS StockItemID, p_name AS StockItemName, (p_partkey % 10)::BIGINT AS SupplierID,
               CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_partkey % 5 END::BIGINT AS ColorID,
               (p_size % 30)::BIGINT AS UnitPackageID, (p_partkey % 25)::BIGINT AS OuterPackageID,
               p_brand AS Brand, p_type AS Size, (p_size % 14)::INTEGER AS LeadTimeDays,
               p_size::INTEGER AS QuantityPerOuter, p_partkey % 7 = 0 AS IsChillerStock,
               CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE lpad(p_partkey::VARCHAR, 13, '0') END AS Barcode,
               (p_size % 4 * 5)::DECIMAL(18,3) AS TaxRate, p_retailprice::DECIMAL(18,2) AS UnitPrice,
               CASE WHEN p_partkey % 6 = 0 THEN NULL
                    ELSE (p_retailprice::DECIMAL(18,2) * 1.5::DECIMAL(2,1))::DECIMAL(18,2) END AS RecommendedRetailPrice,
               (p_size * 0.125::DECIMAL(4,3))::DECIMAL(18,3) AS TypicalWeightPerUnit
        FROM part""",
    "suppliers": """
        SELECT s_suppkey AS SupplierID, s_name AS SupplierName, s_nationkey::BIGINT AS SupplierCategoryID,
               s_suppkey AS PrimaryContactPersonID,
               CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'REF-' || s_suppkey END AS SupplierReference,
               (s_suppkey % 3 * 7 + 7)::INTEGER AS PaymentDays,
               lpad((s_suppkey % 1000)::VARCHAR, 5, '0') AS DeliveryPostalCode
        FROM supplier""",
    "invoices": """
        SELECT o_orderkey AS InvoiceID, CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_custkey END AS CustomerID,
               (o_custkey - o_custkey % 10)::BIGINT AS BillToCustomerID, (o_custkey % 10)::BIGINT AS SalespersonPersonID,
               o_orderdate::DATE AS InvoiceDate, o_orderdate AS LastEditedWhen,
               (o_orderkey % 5)::INTEGER AS TotalDryItems, (o_orderkey % 3)::INTEGER AS TotalChillerItems
        FROM orders""",
    "invoicelines": """
        SELECT l_orderkey * 8388608 + l_linenumber * 1048576 + l_quantity::INTEGER * 16384
                   + (l_partkey * 31 + l_suppkey) % 16384 AS InvoiceLineID,
               CASE WHEN l_partkey % 499 = 0 THEN NULL ELSE l_orderkey END AS InvoiceID,
               CASE WHEN l_orderkey % 103 = 0 THEN -1 ELSE l_partkey END AS StockItemID,
               l_returnflag || l_linestatus || '-' || l_partkey AS Description,
               (l_linenumber % 4)::BIGINT AS PackageTypeID, l_quantity::INTEGER AS Quantity,
               CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE (900 + l_partkey % 1000)::DECIMAL(18,2) END AS UnitPrice,
               (l_tax::DECIMAL(6,3) * 100)::DECIMAL(18,3) AS TaxRate,
               (l_extendedprice::DECIMAL(18,2) * l_tax::DECIMAL(6,3))::DECIMAL(18,2) AS TaxAmount,
               (l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(6,3))::DECIMAL(18,2) AS LineProfit,
               l_extendedprice::DECIMAL(18,2) AS ExtendedPrice, l_orderkey, l_suppkey, l_shipdate, l_partkey, l_linenumber
        FROM lineitem""",
    "customer_versions": f"""
        SELECT bk, vf, coalesce(lead(vf) OVER (PARTITION BY bk ORDER BY vf), {END}) AS vt,
               bk * 100000 + date_diff('day', DATE '1990-01-01', vf::DATE) AS sk
        FROM (SELECT DISTINCT o_custkey AS bk, o_orderdate AS vf FROM orders)""",
    "item_versions": f"""
        SELECT bk, vf, coalesce(lead(vf) OVER (PARTITION BY bk ORDER BY vf), {END}) AS vt,
               bk * 100000 + date_diff('day', DATE '1990-01-01', vf::DATE) AS sk
        FROM (SELECT DISTINCT l_partkey AS bk, l_shipdate AS vf FROM lineitem)""",
    "employee_versions": f"""
        SELECT bk, vf, coalesce(lead(vf) OVER (PARTITION BY bk ORDER BY vf), {END}) AS vt,
               bk * 100000 + date_diff('day', DATE '1990-01-01', vf::DATE) AS sk
        FROM (SELECT DISTINCT l_suppkey AS bk, l_shipdate AS vf FROM lineitem)""",
    "city_versions": f"""
        SELECT n_nationkey::BIGINT AS bk, TIMESTAMP '1996-01-01' AS vf, {END} AS vt, (n_nationkey + 1)::BIGINT AS sk
        FROM nation""",
    "staged_sales": """
        SELECT InvoiceLineID AS Sale_Key, c_nationkey::BIGINT AS WWI_City_ID, o_custkey AS WWI_Customer_ID,
               (o_custkey - o_custkey % 10)::BIGINT AS WWI_Bill_To_Customer_ID, l_partkey AS WWI_Stock_Item_ID,
               l_suppkey AS WWI_Salesperson_ID, l_shipdate AS Last_Modified_When, o_orderdate::DATE AS Invoice_Date,
               strftime(o_orderdate, '%Y%m%d')::INTEGER AS Invoice_Date_Key,
               strftime(l_shipdate::DATE + l_linenumber::INTEGER, '%Y%m%d')::INTEGER AS Delivery_Date_Key,
               l_orderkey AS WWI_Invoice_ID, Description, n_name AS Package, Quantity, UnitPrice AS Unit_Price, TaxRate AS Tax_Rate,
               (ExtendedPrice - TaxAmount)::DECIMAL(18,2) AS Total_Excluding_Tax, TaxAmount AS Tax_Amount, LineProfit AS Profit,
               ExtendedPrice AS Total_Including_Tax, (o_orderkey % 5)::INTEGER AS Total_Dry_Items, (o_orderkey % 3)::INTEGER AS Total_Chiller_Items
        FROM invoicelines JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
        LEFT JOIN nation ON n_nationkey = PackageTypeID""",
    "loads": """
        SELECT event_id + 1 AS Lineage_Key, ts AS Data_Load_Started,
               ['Customer', 'Stock Item', 'Supplier', 'Sale', 'Employee'][event_id % 5 + 1] AS Table_Name,
               CASE WHEN event_id % 5 <> 4 AND event_type = 'error' THEN NULL ELSE ts + INTERVAL 1 HOUR END AS Data_Load_Completed,
               event_type <> 'error' AS Was_Successful,
               date_trunc('hour', ts)::TIMESTAMP AS Source_System_Cutoff_Time
        FROM events""",
    "dim_c": """
        SELECT row_number() OVER (ORDER BY a.CustomerID) AS Customer_Key, a.CustomerID AS WWI_Customer_ID,
               a.CustomerName AS Customer, b.CustomerName AS Bill_To_Customer, n_name AS Category, r_name AS Buying_Group,
               w.c_name AS Primary_Contact, a.DeliveryPostalCode AS Postal_Code, a.AccountOpenedDate AS Valid_From,
               DATE '9999-12-31' AS Valid_To
        FROM customers a
        LEFT JOIN customers b ON b.CustomerID = a.BillToCustomerID
        LEFT JOIN nation ON n_nationkey = a.CustomerCategoryID
        LEFT JOIN region ON r_regionkey = a.BuyingGroupID
        LEFT JOIN customer w ON w.c_custkey = a.PrimaryContactPersonID""",
    "dim_i": """
        SELECT row_number() OVER (ORDER BY StockItemID) AS Stock_Item_Key, StockItemID AS WWI_Stock_Item_ID,
               StockItemName AS Stock_Item, r_name AS Color, s.n_name AS Selling_Package, b.n_name AS Buying_Package,
               Brand, Size, LeadTimeDays AS Lead_Time_Days, QuantityPerOuter AS Quantity_Per_Outer,
               IsChillerStock AS Is_Chiller_Stock, TaxRate AS Tax_Rate, UnitPrice AS Unit_Price,
               RecommendedRetailPrice AS Recommended_Retail_Price, TypicalWeightPerUnit AS Typical_Weight_Per_Unit
        FROM stockitems
        LEFT JOIN region ON r_regionkey = ColorID
        LEFT JOIN nation s ON s.n_nationkey = UnitPackageID
        LEFT JOIN nation b ON b.n_nationkey = OuterPackageID""",
    "dim_s": """
        SELECT row_number() OVER (ORDER BY SupplierID) AS Supplier_Key, SupplierID AS WWI_Supplier_ID,
               SupplierName AS Supplier, n_name AS Category, c_name AS Primary_Contact,
               SupplierReference AS Supplier_Reference, PaymentDays AS Payment_Days, DeliveryPostalCode AS Postal_Code
        FROM suppliers
        LEFT JOIN nation ON n_nationkey = SupplierCategoryID
        LEFT JOIN customer ON c_custkey = PrimaryContactPersonID""",
    "sales": """
        SELECT l.InvoiceLineID AS Sale_Key, own.Customer_Key, payer.Customer_Key AS Bill_To_Customer_Key, i.Stock_Item_Key,
               h.InvoiceDate AS Invoice_Date, strftime(h.InvoiceDate, '%Y%m%d')::INTEGER AS Invoice_Date_Key,
               h.SalespersonPersonID AS WWI_Salesperson_ID, h.InvoiceID AS WWI_Invoice_ID, l.Description, n_name AS Package,
               l.Quantity, l.UnitPrice AS Unit_Price, l.TaxRate AS Tax_Rate,
               (l.ExtendedPrice - l.TaxAmount)::DECIMAL(18,2) AS Total_Excluding_Tax, l.TaxAmount AS Tax_Amount,
               l.LineProfit AS Profit, l.ExtendedPrice AS Total_Including_Tax
        FROM invoicelines l
        JOIN invoices h ON h.InvoiceID = l.InvoiceID
        LEFT JOIN dim_c own ON own.WWI_Customer_ID = h.CustomerID
        LEFT JOIN dim_c payer ON payer.WWI_Customer_ID = h.BillToCustomerID
        LEFT JOIN dim_i i ON i.WWI_Stock_Item_ID = l.StockItemID
        LEFT JOIN nation ON n_nationkey = l.PackageTypeID""",
    "customer_base": f"""
        SELECT WWI_Customer_ID + 1 AS Customer_Key, WWI_Customer_ID, Customer, Bill_To_Customer, Category, Buying_Group,
               Primary_Contact, Postal_Code, min(o_orderdate) AS Valid_From, {END} AS Valid_To, 1::BIGINT AS Lineage_Key
        FROM dim_c JOIN orders ON o_custkey = WWI_Customer_ID GROUP BY ALL""",
    "customer_batch": f"""
        SELECT WWI_Customer_ID, Customer, Bill_To_Customer, Category, Buying_Group, Primary_Contact, Postal_Code,
               day AS Valid_From, coalesce(lead(day) OVER (PARTITION BY bk ORDER BY day), {END}) AS Valid_To
        FROM (SELECT DISTINCT o_custkey AS bk, o_orderdate AS day FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')
        JOIN dim_c ON WWI_Customer_ID = bk""",
    "item_base": f"""
        SELECT WWI_Stock_Item_ID + 1 AS Stock_Item_Key, d.* EXCLUDE (Stock_Item_Key), Barcode, NULL::BLOB AS Photo,
               first_day AS Valid_From, {END} AS Valid_To, 1::BIGINT AS Lineage_Key
        FROM dim_i d JOIN stockitems ON StockItemID = WWI_Stock_Item_ID
        JOIN (SELECT l_partkey AS bk, min(l_shipdate) AS first_day FROM lineitem GROUP BY 1) ON bk = WWI_Stock_Item_ID""",
    "item_batch": f"""
        SELECT d.* EXCLUDE (Stock_Item_Key), Barcode, NULL::BLOB AS Photo, day AS Valid_From,
               coalesce(lead(day) OVER (PARTITION BY bk ORDER BY day), {END}) AS Valid_To
        FROM (SELECT DISTINCT l_partkey AS bk, l_shipdate AS day FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01')
        JOIN dim_i d ON WWI_Stock_Item_ID = bk JOIN stockitems ON StockItemID = bk""",
    "supplier_base": f"""
        SELECT WWI_Supplier_ID + 1 AS Supplier_Key, d.* EXCLUDE (Supplier_Key), first_day AS Valid_From, {END} AS Valid_To,
               1::BIGINT AS Lineage_Key
        FROM dim_s d
        JOIN (SELECT l_suppkey AS bk, min(l_shipdate) AS first_day FROM lineitem GROUP BY 1) ON bk = WWI_Supplier_ID""",
    "supplier_batch": f"""
        SELECT d.* EXCLUDE (Supplier_Key), day AS Valid_From,
               coalesce(lead(day) OVER (PARTITION BY bk ORDER BY day), {END}) AS Valid_To
        FROM (SELECT DISTINCT l_suppkey AS bk, l_shipdate AS day FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01')
        JOIN dim_s d ON WWI_Supplier_ID = bk""",
}

_NEEDS = {
    "staged_sales": ("invoicelines",),
    "dim_c": ("customers",),
    "dim_i": ("stockitems",),
    "dim_s": ("suppliers",),
    "sales": ("customers", "stockitems", "invoices", "invoicelines", "dim_c", "dim_i"),
    "customer_base": ("customers", "dim_c"),
    "customer_batch": ("customers", "dim_c"),
    "item_base": ("stockitems", "dim_i"),
    "item_batch": ("stockitems", "dim_i"),
    "supplier_base": ("suppliers", "dim_s"),
    "supplier_batch": ("suppliers", "dim_s"),
}


def _over(views: str, sql: str) -> str:
    """``sql`` behind the named views and all that they build on."""
    named = views.split()
    needed = {need for view in named for need in (*_NEEDS.get(view, ()), view)}
    return "WITH " + ",\n".join(f"{view} AS ({VIEWS[view]})" for view in VIEWS if view in needed) + "\n" + sql


def _as_of(versions: str, business_key: str) -> str:
    return f"""coalesce((SELECT v.sk FROM {versions} v
        WHERE v.bk = s.{business_key} AND s.Last_Modified_When > v.vf AND s.Last_Modified_When <= v.vt
        ORDER BY v.vf, v.sk LIMIT 1), 0)::BIGINT"""


_ROLES = {
    "pit_customer": ("customer_versions", "WWI_Customer_ID", "Customer_Key"),
    "pit_bill_to": ("customer_versions", "WWI_Bill_To_Customer_ID", "Bill_To_Customer_Key"),
    "pit_stockitem": ("item_versions", "WWI_Stock_Item_ID", "Stock_Item_Key"),
    "pit_salesperson": ("employee_versions", "WWI_Salesperson_ID", "Salesperson_Key"),
    "pit_city": ("city_versions", "WWI_City_ID", "City_Key"),
}


def _as_of_query(*names: str) -> str:
    roles = [_ROLES[name] for name in names]
    ids = ", ".join(f"s.{business_key}" for _, business_key, _ in roles)
    keys = ", ".join(f"{_as_of(versions, business_key)} AS {output}" for versions, business_key, output in roles)
    views = " ".join(dict.fromkeys(["staged_sales", *(versions for versions, _, _ in roles)]))
    return _over(views, f"SELECT s.Sale_Key, {ids}, s.Last_Modified_When, {keys} FROM staged_sales s")


def _close(base: str, batch: str, bk: str) -> str:
    return f"""
        SELECT b.* REPLACE (CASE WHEN b.Valid_To = {END} AND b.{bk} IN (SELECT {bk} FROM {batch})
                                 THEN (SELECT min(Valid_From) FROM {batch} x WHERE x.{bk} = b.{bk})
                                 ELSE b.Valid_To END AS Valid_To)
        FROM {base} b"""


def _number(base: str, batch: str, bk: str, sk: str) -> str:
    return f"""
        SELECT ((SELECT max({sk}) FROM {base}) + row_number() OVER (ORDER BY {bk}, Valid_From))::BIGINT AS {sk}, *
        FROM {batch}"""


def _apply(base: str, batch: str, bk: str, sk: str, table: str) -> str:
    load = f"(SELECT max(Lineage_Key) FROM loads WHERE Table_Name = '{table}' AND Data_Load_Completed IS NULL)"
    return _over(
        f"loads {base} {batch}",
        f"{_close(base, batch, bk)} UNION ALL BY NAME SELECT *, {load} AS Lineage_Key FROM ({_number(base, batch, bk, sk)})",
    )


def _bounds(versions: str, bk: str, sk: str) -> str:
    return f"{versions}_versions AS (SELECT {bk} AS bk, Valid_From AS vf, Valid_To AS vt, {sk} AS sk FROM {versions})"


def _loaded_keys(state: str) -> str:
    """The five keys of a staged line by the dimensions of before or after their load."""
    own = {"customer_versions": f"customer_{state}_versions", "item_versions": f"item_{state}_versions"}
    return ", ".join(f"{_as_of(own.get(versions, versions), key)} AS {output}" for versions, key, output in _ROLES.values())


_TOTALS = """
    SELECT count(*) AS fact_sale_rows, sum(Total_Including_Tax)::DECIMAL(38,2) AS fact_sale_total_incl,
           sum(Total_Excluding_Tax)::DECIMAL(38,2) AS fact_sale_total_excl, sum(Quantity)::BIGINT AS fact_sale_quantity,
           sum(Profit)::DECIMAL(38,2) AS fact_sale_profit,
           (SELECT count(*) FROM customer) AS dim_customer_rows, (SELECT count(*) FROM part) AS dim_stockitem_rows,
           (SELECT count(*) FROM supplier) AS dim_supplier_rows
    FROM sales"""
_RECONCILED = f"""
    SELECT metric, v AS actual, CASE WHEN metric = 'dim_supplier_rows' THEN (SELECT count(*) FROM customer) ELSE v END::DECIMAL(38,2) AS expected,
           metric LIKE 'fact%' AS exact, CASE WHEN metric LIKE 'fact%' THEN 'PASS' ELSE 'INFO' END AS status
    FROM (UNPIVOT (SELECT COLUMNS(*)::DECIMAL(38,2) FROM ({_TOTALS})) ON COLUMNS(*) INTO NAME metric VALUE v)"""
_CATEGORIES = """
    SELECT coalesce(Category, '(sin categoría)') AS category, round(sum(Total_Including_Tax), 0)::BIGINT AS revenue
    FROM sales JOIN dim_c USING (Customer_Key) GROUP BY 1 ORDER BY 2 DESC, 1"""
_MONTHS = """
    SELECT strftime(Invoice_Date, '%Y-%m') AS month, round(sum(Total_Including_Tax), 0)::BIGINT AS revenue
    FROM sales GROUP BY 1 ORDER BY 1"""
_ITEMS = """
    SELECT Stock_Item AS item, round(sum(Total_Including_Tax), 0)::BIGINT AS revenue
    FROM sales JOIN dim_i USING (Stock_Item_Key) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 6"""
_KPIS = """
    SELECT round(sum(Total_Including_Tax), 0)::BIGINT AS revenue, count(*) AS lines, count(DISTINCT Customer_Key) AS customers,
           round(avg(Total_Including_Tax), 2)::DECIMAL(18,2) AS ticket
    FROM sales"""


def _bars(report: str) -> str:
    return f""", report AS ({report}), scale AS (SELECT coalesce(nullif(max(revenue), 0), 1) AS largest FROM report)
        SELECT report.*, greatest(2, round_even(100 * revenue / largest, 0))::BIGINT AS share,
               'S/ ' || format('{{:,}}', revenue) AS label
        FROM report, scale"""


# Columns of the loaded fact that are neither keys nor the load's number.
_SALE = """Invoice_Date_Key, Delivery_Date_Key, WWI_Invoice_ID, Description, Package, Quantity, Unit_Price, Tax_Rate, Total_Excluding_Tax,
           Tax_Amount, Profit, Total_Including_Tax, Total_Dry_Items, Total_Chiller_Items"""

_REPLACED = _over(
    "staged_sales",
    """, kept AS (SELECT * EXCLUDE (WWI_City_ID) FROM staged_sales),
         restated AS (SELECT * REPLACE (Quantity + 1 AS Quantity) FROM kept WHERE Last_Modified_When >= TIMESTAMP '2001-01-01')
       SELECT * FROM kept WHERE WWI_Invoice_ID NOT IN (SELECT WWI_Invoice_ID FROM restated)
       UNION ALL SELECT * FROM restated""",
)

ORACLE: dict[str, str] = {
    # sources and sinks
    "parquet_roundtrip": _over("invoices", "SELECT * FROM invoices"),
    "extract_projection": _over("customers", "SELECT * FROM customers"),
    "extract_full": "SELECT * FROM supplier",
    "csv_roundtrip_typed": _over("stockitems", "SELECT * FROM stockitems"),
    "csv_infer_to_parquet": _over(
        "customers",
        "SELECT * REPLACE (CustomerID::BIGINT AS CustomerID, DeliveryPostalCode::BIGINT AS DeliveryPostalCode) FROM customers",
    ),
    "capture_control_totals": _over("sales", _TOTALS),
    "entity_row_counts": "\nUNION ALL\n".join(
        f"SELECT '{entity}' AS entity, count(*) AS n_rows FROM {table}"
        for entity, table in {
            "customers": "customer",
            "customercategories": "nation",
            "buyinggroups": "region",
            "people": "customer",
            "stockitems": "part",
            "colors": "region",
            "packagetypes": "nation",
            "suppliers": "supplier",
            "suppliercategories": "nation",
            "invoices": "orders",
            "invoicelines": "lineitem",
        }.items()
    ),
    # dimensions
    "dim_customer": _over("dim_c", "SELECT * FROM dim_c"),
    "dim_stockitem": _over("dim_i", "SELECT * FROM dim_i"),
    "dim_supplier": _over("dim_s", "SELECT * FROM dim_s"),
    "surrogate_key_dense": "SELECT row_number() OVER (ORDER BY o_orderkey) AS Invoice_Key, o_orderkey AS InvoiceID FROM orders",
    "self_join_bill_to": _over(
        "customers",
        """SELECT CustomerID, BillToCustomerID,
                  (SELECT c_name FROM customer WHERE c_custkey = BillToCustomerID) AS Bill_To_Customer FROM customers""",
    ),
    "dim_preview": _over("dim_c", "SELECT * FROM dim_c ORDER BY Customer_Key LIMIT 5"),
    "dim_current_rows": _over(
        "customer_versions",
        f"SELECT bk AS WWI_Customer_ID, vf AS Valid_From, vt AS Valid_To, sk AS Customer_Key FROM customer_versions WHERE vt = {END}",
    ),
    # fact
    "fact_sale": _over("sales", "SELECT * FROM sales"),
    "warehouse_rebuild": _over("sales", "SELECT * FROM sales"),
    "resolve_current_keys": _over(
        "invoices dim_c",
        """SELECT InvoiceID, CustomerID, BillToCustomerID,
                  (SELECT Customer_Key FROM dim_c WHERE WWI_Customer_ID = CustomerID) AS Customer_Key,
                  (SELECT Customer_Key FROM dim_c WHERE WWI_Customer_ID = BillToCustomerID) AS Bill_To_Customer_Key
           FROM invoices""",
    ),
    "fact_measures": _over(
        "invoicelines",
        """SELECT InvoiceLineID, (ExtendedPrice - TaxAmount)::DECIMAL(18,2) AS Total_Excluding_Tax, TaxAmount AS Tax_Amount,
                  LineProfit AS Profit, ExtendedPrice AS Total_Including_Tax FROM invoicelines""",
    ),
    "date_key": "SELECT o_orderkey AS InvoiceID, strftime(o_orderdate, '%Y%m%d')::INTEGER AS Invoice_Date_Key FROM orders",
    # point-in-time lookups
    **{name: _as_of_query(name) for name in _ROLES},
    "pit_salesperson_swept": _as_of_query("pit_salesperson"),
    "pit_all_roles": _as_of_query(*_ROLES),
    # history
    "rows_to_close_off": _over(
        "customer_batch", "SELECT WWI_Customer_ID, min(Valid_From) AS Valid_From FROM customer_batch GROUP BY 1"
    ),
    "scd2_close": _over("customer_base customer_batch", _close("customer_base", "customer_batch", "WWI_Customer_ID")),
    "scd2_new_keys": _over(
        "customer_base customer_batch",
        f"""SELECT Customer_Key, WWI_Customer_ID, Valid_From, Valid_To
            FROM ({_number("customer_base", "customer_batch", "WWI_Customer_ID", "Customer_Key")})""",
    ),
    "scd2_apply_customer": _apply("customer_base", "customer_batch", "WWI_Customer_ID", "Customer_Key", "Customer"),
    "scd2_apply_stockitem": _apply("item_base", "item_batch", "WWI_Stock_Item_ID", "Stock_Item_Key", "Stock Item"),
    "scd2_apply_supplier": _apply("supplier_base", "supplier_batch", "WWI_Supplier_ID", "Supplier_Key", "Supplier"),
    "scd2_apply_bucketed": _apply("customer_base", "customer_batch", "WWI_Customer_ID", "Customer_Key", "Customer"),
    "pit_customer_bucketed": _as_of_query("pit_customer"),
    "multi_version_keys": """
        SELECT l_partkey AS WWI_Stock_Item_ID, count(DISTINCT l_shipdate) AS versions
        FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_shipdate) > 1""",
    "fact_replace_by_invoice": _REPLACED,
    "fact_replace_by_month": _REPLACED,
    "sale_load": _over(
        "staged_sales loads " + " ".join(dict.fromkeys(versions for versions, _, _ in _ROLES.values())),
        f""", restated AS (SELECT * REPLACE ((Quantity + 1)::INTEGER AS Quantity) FROM staged_sales WHERE Last_Modified_When >= TIMESTAMP '2001-01-01')
           SELECT Sale_Key, {_SALE}, {", ".join(f"0::BIGINT AS {output}" for _, _, output in _ROLES.values())}, 1::BIGINT AS Lineage_Key
           FROM staged_sales WHERE WWI_Invoice_ID NOT IN (SELECT WWI_Invoice_ID FROM restated)
           UNION ALL BY NAME
           SELECT Sale_Key, {_SALE}, {", ".join(f"{_as_of(versions, key)} AS {output}" for versions, key, output in _ROLES.values())},
                  (SELECT max(Lineage_Key) FROM loads WHERE Table_Name = 'Sale' AND Data_Load_Completed IS NULL) AS Lineage_Key
           FROM restated s""",
    ),
    "rebuild_totals": _over("sales", _TOTALS),
    "staged_load": _over(
        "staged_sales customer_base customer_batch item_base item_batch employee_versions city_versions",
        f""", customer_applied AS ({_close("customer_base", "customer_batch", "WWI_Customer_ID")}
             UNION ALL BY NAME ({_number("customer_base", "customer_batch", "WWI_Customer_ID", "Customer_Key")})),
             item_applied AS ({_close("item_base", "item_batch", "WWI_Stock_Item_ID")}
             UNION ALL BY NAME ({_number("item_base", "item_batch", "WWI_Stock_Item_ID", "Stock_Item_Key")})),
             {_bounds("customer_base", "WWI_Customer_ID", "Customer_Key")}, {_bounds("customer_applied", "WWI_Customer_ID", "Customer_Key")},
             {_bounds("item_base", "WWI_Stock_Item_ID", "Stock_Item_Key")}, {_bounds("item_applied", "WWI_Stock_Item_ID", "Stock_Item_Key")},
             old AS (SELECT * FROM staged_sales WHERE Last_Modified_When < TIMESTAMP '2001-01-01'),
             restated AS (SELECT * REPLACE ((Quantity + 1)::INTEGER AS Quantity) FROM staged_sales WHERE Last_Modified_When >= TIMESTAMP '2001-01-01')
           SELECT {_loaded_keys("base")}, {_SALE}, 1::BIGINT AS Lineage_Key FROM old s WHERE WWI_Invoice_ID NOT IN (SELECT WWI_Invoice_ID FROM restated)
           UNION ALL BY NAME SELECT {_loaded_keys("applied")}, {_SALE}, 4::BIGINT AS Lineage_Key FROM restated s""",
    ),
    # load control
    "lineage_open": _over(
        "loads",
        """SELECT * FROM loads
           UNION ALL SELECT max(Lineage_Key) + 1, TIMESTAMP '2024-02-01', 'Customer', NULL, false, TIMESTAMP '2024-01-31' FROM loads""",
    ),
    "lineage_started_key": _over("loads", "SELECT max(Lineage_Key) + 1 AS Lineage_Key FROM loads"),
    "lineage_open_key": _over(
        "loads",
        """SELECT DISTINCT Table_Name,
                  (SELECT o.Lineage_Key FROM loads o WHERE o.Table_Name = l.Table_Name AND o.Data_Load_Completed IS NULL
                   ORDER BY o.Lineage_Key DESC LIMIT 1) AS Lineage_Key FROM loads l""",
    ),
    "lineage_close": _over(
        "loads",
        """, this AS (SELECT max(Lineage_Key) AS k FROM loads WHERE Table_Name = 'Customer' AND Data_Load_Completed IS NULL)
           SELECT * EXCLUDE (k)
                  REPLACE (CASE WHEN Lineage_Key = k THEN TIMESTAMP '2024-02-01 01:00:00' ELSE Data_Load_Completed END AS Data_Load_Completed,
                           Was_Successful OR coalesce(Lineage_Key = k, false) AS Was_Successful)
           FROM loads, this""",
    ),
    "cutoff_advance": _over(
        "loads",
        """SELECT Table_Name, CASE WHEN Table_Name = 'Customer'
                  THEN (SELECT Source_System_Cutoff_Time FROM loads WHERE Table_Name = 'Customer' AND Data_Load_Completed IS NULL
                        ORDER BY Lineage_Key DESC LIMIT 1)
                  ELSE min(Source_System_Cutoff_Time) END AS Cutoff_Time
           FROM loads GROUP BY 1""",
    ),
    "visible_loads": _over(
        "loads invoicelines",
        """SELECT InvoiceLineID, InvoiceID, ExtendedPrice, InvoiceLineID % 1000 + 1 AS Lineage_Key FROM invoicelines
           WHERE InvoiceLineID % 1000 + 1 IN (SELECT Lineage_Key FROM loads WHERE Was_Successful)""",
    ),
    # quality
    "reconcile_totals": _over("sales", f"SELECT * FROM ({_RECONCILED}) WHERE exact"),
    "reconcile_shape": _over("sales", f"SELECT * FROM ({_RECONCILED}) WHERE NOT exact"),
    "reconcile_verdict": _over(
        "sales",
        f"""SELECT bool_and(status <> 'FAIL') AS passed, count(*) FILTER (status = 'FAIL') AS failed,
                   count(*) FILTER (exact) AS checked FROM ({_RECONCILED})""",
    ),
    "unresolved_keys": _over("sales", "SELECT count(*) AS unresolved FROM sales WHERE Customer_Key IS NULL OR Stock_Item_Key IS NULL"),
    "grain_check": _over(
        "sales",
        """SELECT count(*) AS fact_rows, (SELECT count(*) FROM lineitem) AS line_rows,
                  count(*) = (SELECT count(*) FROM lineitem) AS same_grain FROM sales""",
    ),
    # reports
    "sales_kpis": _over("sales", _KPIS),
    "revenue_by_category": _over("sales", _CATEGORIES),
    "revenue_by_month": _over("sales", _MONTHS),
    "top_items": _over("sales", _ITEMS),
    "bar_share": _over("sales", _bars(_CATEGORIES)),
    "monthly_bar_share": _over("sales", _bars(_MONTHS)),
    "top_items_bar_share": _over("sales", _bars(_ITEMS)),
    "kpi_labels": _over(
        "sales",
        f""", kpis AS ({_KPIS})
            SELECT 'Ingresos (con IGV)' AS label, 'S/ ' || format('{{:,}}', revenue) AS value FROM kpis
            UNION ALL SELECT 'Líneas de venta', format('{{:,}}', lines) FROM kpis
            UNION ALL SELECT 'Clientes', format('{{:,}}', customers) FROM kpis
            UNION ALL SELECT 'Ticket promedio', 'S/ ' || format('{{:,.2f}}', ticket::DOUBLE) FROM kpis""",
    ),
    "kpis_from_summaries": _over("sales", _KPIS),
    "category_from_summaries": _over("sales", _CATEGORIES),
    "month_from_summaries": _over("sales", _MONTHS),
    "items_from_summaries": _over("sales", _ITEMS),
    "category_share_check": _over(
        "sales",
        """, parts AS (SELECT sum(Total_Including_Tax) AS total,
                              sum(Total_Including_Tax) FILTER (Customer_Key IS NOT NULL) AS named FROM sales)
           SELECT total::DECIMAL(38,2) AS total, named::DECIMAL(38,2) AS categories, (total - named)::DECIMAL(38,2) AS outside,
                  total = named AS agrees FROM parts""",
    ),
}
