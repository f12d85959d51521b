"""Every operator as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import date_key
from starloom.operators import control, history
from starloom.operators.lookup import LookupLimits, Role, VersionedDimension, resolve_point_in_time
from starloom.operators.ordered import dense_keys
from starloom.operators.replace import replace_by_invoice
from starloom.plans import dimensions, facts, history_store, loads, months, quality, reports, summaries, warehouse
from starloom.session import materialise, scratch_path
from starloom.sources import landing, testdata
from starloom.sources.schemas import CONTROL_TOTALS, OPERATIONAL
from starloom.sources.testdata import OperationalTables

Query = Callable[[SparkSession, str], DataFrame]

DIMENSIONS = {
    "customer": dimensions.dim_customer,
    "stockitem": dimensions.dim_stockitem,
    "supplier": dimensions.dim_supplier,
}
OPENED_AT, OPENED_CUTOFF = "2024-02-01 00:00:00", "2024-01-31 00:00:00"
COMPLETED_AT = "2024-02-01 01:00:00"


class _Built(dict):
    """Dimensions built and stored when first asked for, as every later step reads them several times."""

    def __init__(self, tables: OperationalTables):
        super().__init__()
        self.tables = tables

    def __missing__(self, name: str) -> DataFrame:
        self[name] = materialise(DIMENSIONS[name](self.tables), f"dim-{name}")
        return self[name]


def _warehouse(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> tuple[DataFrame, _Built]:
    tables = OperationalTables(spark, sf_dir)
    dims = _Built(tables)
    return facts.fact_sale(tables, dims, columns), dims


# --- sources and sinks


def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "invoices")
    landing.write_parquet(OperationalTables(spark, sf_dir)["invoices"], path)
    return landing.read_parquet(spark, path, OPERATIONAL["invoices"])


def extract_projection(spark, sf_dir):
    return landing.extract(OperationalTables(spark, sf_dir)["customers"], OPERATIONAL["customers"])


def extract_full(spark, sf_dir):
    return testdata.raw(spark, sf_dir, "supplier").select("*")


def csv_roundtrip_typed(spark, sf_dir):
    path = scratch_path(spark, "stockitems-csv")
    landing.write_csv(OperationalTables(spark, sf_dir)["stockitems"], path)
    return landing.read_csv(spark, path, OPERATIONAL["stockitems"])


def csv_infer_to_parquet(spark, sf_dir):
    source, target = scratch_path(spark, "customers-csv"), scratch_path(spark, "customers")
    landing.write_csv(OperationalTables(spark, sf_dir)["customers"], source)
    return landing.csv_to_parquet(spark, source, target)


def capture_control_totals(spark, sf_dir):
    fact, dims = _warehouse(spark, sf_dir, ("Total_Including_Tax", "Total_Excluding_Tax", "Quantity", "Profit"))
    path = scratch_path(spark, "control-totals")
    landing.write_totals(quality.control_totals(fact, {name: dims[name] for name in DIMENSIONS}), path)
    return landing.read_totals(spark, path, CONTROL_TOTALS)


def entity_row_counts(spark, sf_dir):
    return landing.row_counts(OperationalTables(spark, sf_dir))


# --- dimensions


def dim_customer(spark, sf_dir):
    return dimensions.dim_customer(OperationalTables(spark, sf_dir))


def dim_stockitem(spark, sf_dir):
    return dimensions.dim_stockitem(OperationalTables(spark, sf_dir))


def dim_supplier(spark, sf_dir):
    return dimensions.dim_supplier(OperationalTables(spark, sf_dir))


def surrogate_key_dense(spark, sf_dir):
    invoices = OperationalTables(spark, sf_dir)["invoices"].select("InvoiceID")
    return dense_keys(invoices, ["InvoiceID"], "Invoice_Key")


def self_join_bill_to(spark, sf_dir):
    customers = OperationalTables(spark, sf_dir)["customers"]
    return dimensions.bill_to_name(customers.select("CustomerID", "BillToCustomerID"), customers)


def dim_preview(spark, sf_dir):
    return dimensions.dim_preview(dim_customer(spark, sf_dir), "Customer_Key", 5)


def dim_current_rows(spark, sf_dir):
    return history.current_rows(testdata.customer_history(spark, sf_dir).frame)


# --- fact


def fact_sale(spark, sf_dir):
    return _warehouse(spark, sf_dir, facts.FACT_COLUMNS)[0]


def resolve_current_keys(spark, sf_dir):
    tables = OperationalTables(spark, sf_dir)
    resolved = facts.resolve_customer_keys(tables["invoices"], dimensions.dim_customer(tables))
    return resolved.select("InvoiceID", "CustomerID", "BillToCustomerID", "Customer_Key", "Bill_To_Customer_Key")


def fact_measures(spark, sf_dir):
    lines = facts.fact_measures(OperationalTables(spark, sf_dir)["invoicelines"])
    return lines.select("InvoiceLineID", "Total_Excluding_Tax", "Tax_Amount", "Profit", "Total_Including_Tax")


def date_keys(spark, sf_dir):
    invoices = OperationalTables(spark, sf_dir)["invoices"]
    return invoices.select("InvoiceID", date_key(F.col("InvoiceDate")).alias("Invoice_Date_Key"))


# --- point-in-time lookups

ROLES = {
    "pit_customer": Role("WWI_Customer_ID", "customer", "Customer_Key"),
    "pit_bill_to": Role("WWI_Bill_To_Customer_ID", "customer", "Bill_To_Customer_Key"),
    "pit_stockitem": Role("WWI_Stock_Item_ID", "stockitem", "Stock_Item_Key"),
    "pit_salesperson": Role("WWI_Salesperson_ID", "employee", "Salesperson_Key"),
    "pit_city": Role("WWI_City_ID", "city", "City_Key"),
}


HISTORIES = {
    "customer": testdata.customer_history,
    "stockitem": testdata.stockitem_history,
    "employee": testdata.employee_history,
    "city": testdata.city_history,
}


def _histories(spark: SparkSession, sf_dir: str, roles: Iterable[Role]) -> dict[str, VersionedDimension]:
    """The roles' dimensions as stored tables, the state an incremental load finds."""
    dims = {role.dimension: HISTORIES[role.dimension](spark, sf_dir) for role in roles}
    return {name: replace(dim, frame=materialise(dim.frame, f"history-{name}")) for name, dim in dims.items()}


def _resolved(spark: SparkSession, sf_dir: str, roles: Sequence[Role], limits: LookupLimits = LookupLimits()) -> DataFrame:
    staged = testdata.sale_staging(spark, sf_dir).select(
        "Sale_Key", *dict.fromkeys(role.business_key for role in roles), "Last_Modified_When"
    )
    return resolve_point_in_time(staged, "Last_Modified_When", roles, _histories(spark, sf_dir, roles), limits=limits)


def _pit(name: str) -> Query:
    return lambda spark, sf_dir: _resolved(spark, sf_dir, [ROLES[name]])


def pit_salesperson_swept(spark, sf_dir):
    """The salesperson lookup by the sweep that serves keys with any number of versions."""
    return _resolved(spark, sf_dir, [ROLES["pit_salesperson"]], LookupLimits(versions_per_key=0))


def pit_all_roles(spark, sf_dir):
    return _resolved(spark, sf_dir, list(ROLES.values()))


# --- history


def _stored(spark: SparkSession, sf_dir: str, spec: history.HistorySpec) -> tuple[DataFrame, DataFrame]:
    """A dimension and a staged batch as stored tables, the state a load finds."""
    base, batch = testdata.dimension_base(spark, sf_dir, spec), testdata.dimension_batch(spark, sf_dir, spec)
    return materialise(base, "dimension"), materialise(batch, "batch")


def rows_to_close_off(spark, sf_dir):
    return history.rows_to_close_off(testdata.dimension_batch(spark, sf_dir, history.CUSTOMER), history.CUSTOMER)


def scd2_close(spark, sf_dir):
    return history.close_versions(*_stored(spark, sf_dir, history.CUSTOMER), history.CUSTOMER)


def scd2_new_keys(spark, sf_dir):
    spec = history.CUSTOMER
    numbered = history.number_staged(*_stored(spark, sf_dir, spec), spec)
    return numbered.select(spec.surrogate, spec.business_key, history.VALID_FROM, history.VALID_TO)


def _applied(spec: history.HistorySpec) -> Query:
    def query(spark, sf_dir):
        load = control.open_load_key(testdata.lineage(spark, sf_dir), spec.table).scalar()
        base = materialise(testdata.dimension_base(spark, sf_dir, spec), "dimension")
        return history.apply_history(base, testdata.dimension_batch(spark, sf_dir, spec), spec, load)

    return query


def scd2_apply_bucketed(spark, sf_dir):
    """The customer load over a history that is stored by its business key."""
    spec, folder = history.CUSTOMER, scratch_path(spark, "history")
    load = control.open_load_key(testdata.lineage(spark, sf_dir), spec.table).first()[0]
    history_store.start(testdata.dimension_base(spark, sf_dir, spec), spec, folder)
    history_store.apply(spark, folder, testdata.dimension_batch(spark, sf_dir, spec), spec, load)
    return history_store.read(spark, folder, spec).drop(history_store.PART)


def pit_customer_bucketed(spark, sf_dir):
    """The customer lookup against a history that is stored by its business key."""
    spec, folder = history.CUSTOMER, scratch_path(spark, "history")
    history_store.start(testdata.customer_history(spark, sf_dir).frame, spec, folder)
    staged = testdata.sale_staging(spark, sf_dir).select("Sale_Key", "WWI_Customer_ID", "Last_Modified_When")
    stored = {"customer": history_store.dimension(spark, folder, spec)}
    return resolve_point_in_time(staged, "Last_Modified_When", [ROLES["pit_customer"]], stored, limits=LookupLimits(broadcast_rows=0))


def multi_version_keys(spark, sf_dir):
    return history.multi_version_keys(testdata.stockitem_history(spark, sf_dir).frame, history.STOCK_ITEM)


def _sales_and_restatement(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All sale lines as loaded before, and the recent ones staged again with one more piece each."""
    staged = testdata.sale_staging(spark, sf_dir)
    restated = staged.where(F.col("Last_Modified_When") >= F.lit(testdata.BATCH_START).cast("timestamp_ntz"))
    return staged, restated.withColumn("Quantity", F.col("Quantity") + 1)


NOT_IN_FACT = ("WWI_City_ID",)


def fact_replace_by_invoice(spark, sf_dir):
    fact, restated = _sales_and_restatement(spark, sf_dir)
    return replace_by_invoice(fact.drop(*NOT_IN_FACT), restated)


def fact_replace_by_month(spark, sf_dir):
    """The same replacement in a fact stored by month: two loads, of which the second rewrites what it touches."""
    folder = scratch_path(spark, "fact-by-month")
    fact, restated = (months.with_month(df) for df in _sales_and_restatement(spark, sf_dir))
    loads = control.close_load(testdata.lineage(spark, sf_dir), F.lit(1), COMPLETED_AT)
    months.store_months(fact.drop(*NOT_IN_FACT), fact.select(months.MONTH).distinct(), 1, folder)
    visible = months.visible_months(*months.stored_months(spark, folder), loads.where("Lineage_Key = 1"))
    months.store_months(*months.restate_months(visible, restated), 2, folder)
    both = control.close_load(loads, F.lit(2), COMPLETED_AT).where("Lineage_Key <= 2")
    return months.visible_months(*months.stored_months(spark, folder), both).drop(months.MONTH)


def sale_load(spark, sf_dir):
    """One whole load of restated lines into a fact stored by month: find its lineage, resolve all five keys, replace the invoices."""
    folder = scratch_path(spark, "sale-load")
    before, restated = (months.with_month(df) for df in _sales_and_restatement(spark, sf_dir))
    columns = ("Sale_Key", *facts.LOADED_COLUMNS)
    unresolved = {role.output: F.lit(0).cast("bigint") for role in ROLES.values()}
    fact = before.withColumns({**unresolved, "Lineage_Key": F.lit(1).cast("bigint")}).select(*columns, months.MONTH)
    lineage = control.close_load(testdata.lineage(spark, sf_dir), F.lit(1), COMPLETED_AT)
    months.store_months(fact, fact.select(months.MONTH).distinct(), 1, folder)
    loaded = warehouse.load_sales_by_month(
        {warehouse.LINEAGE: lineage, warehouse.CUTOFFS: testdata.cutoffs(spark, sf_dir)},
        folder, restated, list(ROLES.values()), _histories(spark, sf_dir, ROLES.values()), COMPLETED_AT, columns=columns,
    )
    return months.read_months(spark, folder, loaded[warehouse.LINEAGE], fact.schema).drop(months.MONTH)


def warehouse_rebuild(spark, sf_dir):
    """The fact of a star that was rebuilt, declared complete and read back."""
    folder = scratch_path(spark, "warehouse")
    warehouse.rebuild(testdata.OperationalTables(spark, sf_dir), folder)
    return warehouse.read_star(spark, folder)["fact"]


def rebuild_totals(spark, sf_dir):
    """The control totals that the tasks took while they wrote a rebuilt star."""
    folder = scratch_path(spark, "warehouse")
    warehouse.rebuild(testdata.OperationalTables(spark, sf_dir), folder)
    return warehouse.read_totals(spark, folder)


def staged_load(spark, sf_dir):
    """Two staged batches over a started warehouse: old sales, then changed customers and items with the recent sales restated."""
    folder = scratch_path(spark, "loaded")
    sales, restated = _sales_and_restatement(spark, sf_dir)
    first = {spec.table: testdata.dimension_base(spark, sf_dir, spec) for spec in loads.LOADED}
    first |= {loads.CITY.table: testdata.city_history(spark, sf_dir).frame, loads.EMPLOYEE.table: testdata.employee_history(spark, sf_dir).frame}
    loads.start(spark, first, folder)
    old = sales.where(F.col("Last_Modified_When") < F.lit(testdata.BATCH_START).cast("timestamp_ntz"))
    loads.load_staged(spark, folder, {"Sale": old}, OPENED_CUTOFF, OPENED_AT)
    changes = {spec.table: testdata.dimension_batch(spark, sf_dir, spec) for spec in (history.CUSTOMER, history.STOCK_ITEM)}
    loads.load_staged(spark, folder, {**changes, "Sale": restated}, OPENED_CUTOFF, COMPLETED_AT)
    return loads.read_sales(spark, folder)


# --- load control


def lineage_open(spark, sf_dir):
    return control.open_load(testdata.lineage(spark, sf_dir), "Customer", OPENED_AT, OPENED_CUTOFF)


def lineage_open_key(spark, sf_dir):
    return control.open_load_keys(testdata.lineage(spark, sf_dir))


def lineage_started_key(spark, sf_dir):
    return control.started_load_key(lineage_open(spark, sf_dir), "Customer", OPENED_AT)


def lineage_close(spark, sf_dir):
    lineage = testdata.lineage(spark, sf_dir)
    return control.close_load(lineage, control.open_load_key(lineage, "Customer").scalar(), COMPLETED_AT)


def cutoff_advance(spark, sf_dir):
    lineage = testdata.lineage(spark, sf_dir)
    load = control.open_load_key(lineage, "Customer").scalar()
    return control.advance_cutoff(testdata.cutoffs(spark, sf_dir), lineage, "Customer", load)


def visible_loads(spark, sf_dir):
    return control.visible_loads(testdata.loaded_lines(spark, sf_dir), testdata.lineage(spark, sf_dir))


# --- quality


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact against totals taken from the invoiced lines and the source tables alone."""
    fact, dims = _warehouse(spark, sf_dir, ("Total_Including_Tax", "Total_Excluding_Tax", "Quantity", "Profit"))
    tables = OperationalTables(spark, sf_dir)
    invoiced = facts.fact_measures(tables["invoicelines"]).where(F.col("InvoiceID").isNotNull())
    sources = {"customer": tables["customers"], "stockitem": tables["stockitems"], "supplier": tables["people"]}
    path = scratch_path(spark, "answer-key")
    landing.write_totals(quality.control_totals(invoiced, sources), path)
    expected = landing.read_totals(spark, path, CONTROL_TOTALS)
    return quality.reconcile(quality.control_totals(fact, {name: dims[name] for name in DIMENSIONS}), expected)


def reconcile_totals(spark, sf_dir):
    return _reconciled(spark, sf_dir).where("exact")


def reconcile_shape(spark, sf_dir):
    return _reconciled(spark, sf_dir).where("NOT exact")


def reconcile_verdict(spark, sf_dir):
    return quality.verdict(_reconciled(spark, sf_dir))


def unresolved_keys(spark, sf_dir):
    return quality.unresolved_keys(_warehouse(spark, sf_dir, ("Customer_Key", "Stock_Item_Key"))[0])


def grain_check(spark, sf_dir):
    fact, _ = _warehouse(spark, sf_dir, ("WWI_Invoice_ID",))
    return quality.grain_check(fact, OperationalTables(spark, sf_dir)["invoicelines"])


# --- reports


def sales_kpis(spark, sf_dir):
    return reports.sales_kpis(_warehouse(spark, sf_dir, ("Customer_Key", reports.REVENUE))[0])


def revenue_by_category(spark, sf_dir):
    fact, dims = _warehouse(spark, sf_dir, ("Customer_Key", reports.REVENUE))
    return reports.revenue_by_category(fact, dims["customer"])


def revenue_by_month(spark, sf_dir):
    return reports.revenue_by_month(_warehouse(spark, sf_dir, ("Invoice_Date", reports.REVENUE))[0])


def top_items(spark, sf_dir):
    fact, dims = _warehouse(spark, sf_dir, ("Stock_Item_Key", reports.REVENUE))
    return reports.top_items(fact, dims["stockitem"])


def category_bar_share(spark, sf_dir):
    return reports.bar_labels(reports.with_bar_share(revenue_by_category(spark, sf_dir)))


def monthly_bar_share(spark, sf_dir):
    return reports.bar_labels(reports.with_bar_share(revenue_by_month(spark, sf_dir)))


def top_items_bar_share(spark, sf_dir):
    return reports.bar_labels(reports.with_bar_share(top_items(spark, sf_dir)))


def kpi_labels(spark, sf_dir):
    return reports.kpi_labels(sales_kpis(spark, sf_dir))


def category_share_check(spark, sf_dir):
    fact, dims = _warehouse(spark, sf_dir, ("Customer_Key", reports.REVENUE))
    return reports.category_share_check(fact, dims["customer"])


def _summarised(spark: SparkSession, sf_dir: str) -> tuple[summaries.Summaries, _Built]:
    """Sums that two loads have kept up: the first doubles the recent revenue, the second restates it."""
    folder = scratch_path(spark, "summaries")
    lines, dims = _warehouse(spark, sf_dir, ("WWI_Invoice_ID", "Invoice_Date_Key", "Customer_Key", "Stock_Item_Key", reports.REVENUE))
    fact = materialise(months.with_month(lines), "fact")
    recent = F.col("Invoice_Date_Key") >= 20010101
    doubled = F.when(recent, 2 * F.col(reports.REVENUE)).otherwise(F.col(reports.REVENUE)).cast("decimal(18,2)")
    first = fact.withColumn(reports.REVENUE, doubled)
    months.store_months(first, first.select(months.MONTH).distinct(), 1, folder)
    summaries.store(spark, folder, 1)
    lineage = control.close_load(testdata.lineage(spark, sf_dir).where("Lineage_Key <= 2"), F.col("Lineage_Key"), COMPLETED_AT)
    visible = months.read_months(spark, folder, lineage.where("Lineage_Key = 1"), fact.schema)
    months.store_months(*months.restate_months(visible, fact.where(recent)), 2, folder)
    summaries.store(spark, folder, 2)
    return summaries.read(spark, folder, lineage), dims


def kpis_from_summaries(spark, sf_dir):
    return summaries.sales_kpis(_summarised(spark, sf_dir)[0])


def category_from_summaries(spark, sf_dir):
    sums, dims = _summarised(spark, sf_dir)
    return summaries.revenue_by_category(sums, dims["customer"])


def month_from_summaries(spark, sf_dir):
    return summaries.revenue_by_month(_summarised(spark, sf_dir)[0])


def items_from_summaries(spark, sf_dir):
    sums, dims = _summarised(spark, sf_dir)
    return summaries.top_items(sums, dims["stockitem"])


QUERIES: dict[str, Query] = {
    "parquet_roundtrip": parquet_roundtrip,
    "extract_projection": extract_projection,
    "extract_full": extract_full,
    "csv_roundtrip_typed": csv_roundtrip_typed,
    "csv_infer_to_parquet": csv_infer_to_parquet,
    "capture_control_totals": capture_control_totals,
    "dim_customer": dim_customer,
    "dim_stockitem": dim_stockitem,
    "dim_supplier": dim_supplier,
    "surrogate_key_dense": surrogate_key_dense,
    "self_join_bill_to": self_join_bill_to,
    "dim_preview": dim_preview,
    "dim_current_rows": dim_current_rows,
    "fact_sale": fact_sale,
    "resolve_current_keys": resolve_current_keys,
    "fact_measures": fact_measures,
    "date_key": date_keys,
    **{name: _pit(name) for name in ROLES},
    "pit_salesperson_swept": pit_salesperson_swept,
    "pit_all_roles": pit_all_roles,
    "rows_to_close_off": rows_to_close_off,
    "scd2_close": scd2_close,
    "scd2_new_keys": scd2_new_keys,
    "scd2_apply_customer": _applied(history.CUSTOMER),
    "scd2_apply_stockitem": _applied(history.STOCK_ITEM),
    "scd2_apply_supplier": _applied(history.SUPPLIER),
    "scd2_apply_bucketed": scd2_apply_bucketed,
    "pit_customer_bucketed": pit_customer_bucketed,
    "multi_version_keys": multi_version_keys,
    "fact_replace_by_invoice": fact_replace_by_invoice,
    "fact_replace_by_month": fact_replace_by_month,
    "sale_load": sale_load,
    "warehouse_rebuild": warehouse_rebuild,
    "rebuild_totals": rebuild_totals,
    "staged_load": staged_load,
    "lineage_open": lineage_open,
    "lineage_started_key": lineage_started_key,
    "lineage_open_key": lineage_open_key,
    "lineage_close": lineage_close,
    "cutoff_advance": cutoff_advance,
    "visible_loads": visible_loads,
    "reconcile_totals": reconcile_totals,
    "reconcile_shape": reconcile_shape,
    "reconcile_verdict": reconcile_verdict,
    "unresolved_keys": unresolved_keys,
    "grain_check": grain_check,
    "entity_row_counts": entity_row_counts,
    "sales_kpis": sales_kpis,
    "revenue_by_category": revenue_by_category,
    "revenue_by_month": revenue_by_month,
    "top_items": top_items,
    "bar_share": category_bar_share,
    "monthly_bar_share": monthly_bar_share,
    "top_items_bar_share": top_items_bar_share,
    "kpi_labels": kpi_labels,
    "kpis_from_summaries": kpis_from_summaries,
    "category_from_summaries": category_from_summaries,
    "month_from_summaries": month_from_summaries,
    "items_from_summaries": items_from_summaries,
    "category_share_check": category_share_check,
}
