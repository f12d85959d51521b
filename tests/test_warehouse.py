"""Rebuild and incremental loads end to end."""

import random
import re
import time
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.constants import END_OF_TIME
from starloom.operators.history import CUSTOMER, current_rows
from starloom.plans import facts, loads, months, quality, reports, summaries, warehouse
from starloom.session import settings
from starloom.sources import testdata, versions
from starloom.sources.schemas import CUTOFFS, LINEAGE
from starloom.sources.testdata import OperationalTables

END = datetime.fromisoformat(END_OF_TIME)


def day(n):
    return datetime(2020, 1, 1) + timedelta(days=n)


def test_rebuild_writes_a_consistent_star(spark, sf_dir, tmp_path):
    tables = OperationalTables(spark, sf_dir)
    built = warehouse.rebuild(tables, str(tmp_path))
    assert built["fact"].columns == list(facts.FACT_COLUMNS)
    invoiced = tables["invoicelines"].where("InvoiceID IS NOT NULL")
    assert built["fact"].count() == invoiced.count()
    expected = invoiced.agg(F.sum("ExtendedPrice")).first()[0]
    assert quality.fact_totals(built["fact"]).first()["fact_sale_total_incl"] == expected
    for name, key in (("customer", "Customer_Key"), ("stockitem", "Stock_Item_Key"), ("supplier", "Supplier_Key")):
        low, high, n = built[name].agg(F.min(key), F.max(key), F.count_distinct(key)).first()
        assert (low, high) == (1, n) and n == built[name].count()


def test_rebuild_refuses_a_business_key_that_occurs_twice(spark, sf_dir, tmp_path):
    tables = dict(OperationalTables(spark, sf_dir))
    tables["customers"] = tables["customers"].unionAll(tables["customers"].where("CustomerID = 7"))
    with pytest.raises(ValueError, match="WWI_Customer_ID = 7 occurs 2 times"):
        warehouse.rebuild(tables, str(tmp_path))


def test_a_refused_rebuild_leaves_the_old_star_in_use(spark, sf_dir, tmp_path):
    tables = dict(OperationalTables(spark, sf_dir))
    warehouse.rebuild(tables, str(tmp_path))
    before = {name: (df.inputFiles(), df.count()) for name, df in warehouse.read_star(spark, str(tmp_path)).items()}
    twice = tables | {"customers": tables["customers"].unionAll(tables["customers"].where("CustomerID = 7"))}
    with pytest.raises(ValueError, match="occurs 2 times"):
        warehouse.rebuild(twice, str(tmp_path))
    assert {name: (df.inputFiles(), df.count()) for name, df in warehouse.read_star(spark, str(tmp_path)).items()} == before
    warehouse.rebuild(tables, str(tmp_path))
    assert "v00000003" in warehouse.read_star(spark, str(tmp_path))["fact"].inputFiles()[0]


def test_a_fact_column_joins_only_what_it_needs(spark, sf_dir):
    tables = OperationalTables(spark, sf_dir)
    plan = facts.fact_sale(tables, {}, ("Invoice_Date", "Total_Including_Tax"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 and "l_linenumber" not in plan


CUSTOMERS = "Customer_Key bigint, WWI_Customer_ID bigint, Customer string, Valid_From timestamp_ntz, Valid_To timestamp_ntz, Lineage_Key bigint"


def empty_warehouse(spark):
    cutoffs = spark.createDataFrame([("Customer", day(0)), ("Sale", day(0))], CUTOFFS)
    return {
        "Customer": spark.createDataFrame([], CUSTOMERS),
        warehouse.LINEAGE: spark.createDataFrame([], LINEAGE),
        warehouse.CUTOFFS: cutoffs,
    }


def staged_customers(spark, *rows):
    return spark.createDataFrame(list(rows), "WWI_Customer_ID bigint, Customer string, Valid_From timestamp_ntz, Valid_To timestamp_ntz")


STAGED_SALES = (
    "WWI_City_ID bigint, WWI_Customer_ID bigint, WWI_Bill_To_Customer_ID bigint, WWI_Stock_Item_ID bigint, WWI_Salesperson_ID bigint, Last_Modified_When timestamp_ntz,"
    "Invoice_Date_Key int, Delivery_Date_Key int, WWI_Invoice_ID bigint, Description string, Package string, Quantity int, Unit_Price decimal(18,2), Tax_Rate decimal(18,3),"
    "Total_Excluding_Tax decimal(18,2), Tax_Amount decimal(18,2), Profit decimal(18,2), Total_Including_Tax decimal(18,2), Total_Dry_Items int, Total_Chiller_Items int"
)


def staged_sales(spark, *rows):
    """Lines of (customer, invoice, amount, day), the other columns derived from these."""
    money = lambda v: Decimal(v).quantize(Decimal("0.01"))
    full = [
        (1, c, 8, 5, 6, day(t), 20200100 + t, 20200200 + t, i, f"line of {i}", "Each", i % 7, money("2.50"), Decimal("15.000"),
         money(v) - 1, money("1.00"), money("0.30"), money(v), i % 2, i % 3)
        for c, i, v, t in rows
    ]
    return spark.createDataFrame(full, STAGED_SALES)


def first_tables(spark):
    """A started warehouse's dimensions: customers 7 and 8, one item, city and employee, no supplier."""
    one = lambda bk, key, *rows: spark.createDataFrame(list(rows), f"{key} bigint, {bk} bigint, Valid_From timestamp_ntz, Valid_To timestamp_ntz, Lineage_Key bigint")
    return {
        "Customer": spark.createDataFrame([(1, 7, "old name", day(1), END, 0), (2, 8, "other", day(1), END, 0)], CUSTOMERS),
        "Stock Item": one("WWI_Stock_Item_ID", "Stock_Item_Key", (50, 5, day(0), END, 0)),
        "Supplier": one("WWI_Supplier_ID", "Supplier_Key"),
        "City": one("WWI_City_ID", "City_Key", (10, 1, day(0), END, 0)),
        "Employee": one("WWI_Employee_ID", "Employee_Key", (60, 6, day(0), END, 0)),
    }


FIRST = ((7, 100, "5.00", 2), (7, 101, "6.00", 3), (9, 102, "1.00", 3))
SECOND = ((7, 101, "6.50", 15), (7, 103, "9.00", 16))


def shown(spark, folder, version=None):
    return {(r["WWI_Invoice_ID"], r["Customer_Key"], str(r["Total_Including_Tax"]), r["Lineage_Key"]) for r in loads.read_sales(spark, folder, version).collect()}


def test_two_batches(spark, tmp_path):
    folder = str(tmp_path)
    loads.start(spark, first_tables(spark), folder)
    one = loads.load_staged(spark, folder, {"Sale": staged_sales(spark, *FIRST)}, day(9), day(10))
    two = loads.load_staged(
        spark, folder, {"Customer": staged_customers(spark, (7, "new name", day(15), END)), "Sale": staged_sales(spark, *SECOND)}, day(19), day(20)
    )
    wh = warehouse.read_warehouse(spark, two, ["Customer", "Stock Item", warehouse.CUTOFFS])
    versions = {r["Customer_Key"]: (r["Customer"], r["Valid_From"], r["Valid_To"], r["Lineage_Key"]) for r in wh["Customer"].collect()}
    assert versions == {1: ("old name", day(1), day(15), 0), 2: ("other", day(1), END, 0), 3: ("new name", day(15), END, 2)}
    assert current_rows(wh["Customer"]).count() == 2
    # The restated line is stamped at the very start of the new version, where the old one still holds.
    assert shown(spark, folder) == {(100, 1, "5.00", 1), (101, 1, "6.50", 3), (102, 0, "1.00", 1), (103, 3, "9.00", 3)}
    assert shown(spark, folder, one) == {(100, 1, "5.00", 1), (101, 1, "6.00", 1), (102, 0, "1.00", 1)}
    line = loads.read_sales(spark, folder).where("WWI_Invoice_ID = 103").first()
    assert line == staged_line(103, "9.00", 16) and loads.read_sales(spark, folder).columns == list(facts.LOADED_COLUMNS)
    assert {tuple(r) for r in wh[warehouse.CUTOFFS].collect()} == {("Customer", day(19)), ("Sale", day(19)), ("Stock Item", None), ("Supplier", None)}
    assert [(r["Table_Name"], r["Lineage_Key"], r["Was_Successful"]) for r in loads.load_log(spark, folder).collect()] == [("Sale", 1, True), ("Customer", 2, True), ("Sale", 3, True)]
    assert not (tmp_path / two.split("/")[-1] / "Stock Item").exists(), "tables without a batch are pointed to"


def staged_line(invoice, amount, t):
    """The fact row of a staged line of customer 7 after the second load."""
    v = Decimal(amount)
    return (10, 3, 2, 50, 20200100 + t, 20200200 + t, 60, invoice, f"line of {invoice}", "Each", invoice % 7, Decimal("2.50"), Decimal("15.000"),
            v - 1, Decimal("1.00"), Decimal("0.30"), v, invoice % 2, invoice % 3, 3)


def test_a_load_that_broke_off_is_not_seen_and_is_run_again(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    loads.start(spark, first_tables(spark), folder)
    loads.load_staged(spark, folder, {"Sale": staged_sales(spark, *FIRST)}, day(9), day(10))
    before = shown(spark, folder)
    with monkeypatch.context() as broken:
        broken.setattr(warehouse, "write_warehouse", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            loads.load_staged(spark, folder, {"Sale": staged_sales(spark, *SECOND)}, day(19), day(20))
    assert shown(spark, folder) == before
    loads.load_staged(spark, folder, {"Sale": staged_sales(spark, *SECOND)}, day(19), day(20))
    assert shown(spark, folder) == {(100, 1, "5.00", 1), (101, 1, "6.50", 2), (102, 0, "1.00", 1), (103, 1, "9.00", 2)}


def test_loads_refuse_unknown_and_missing_tables(spark, tmp_path):
    with pytest.raises(ValueError, match="missing: City"):
        loads.start(spark, {k: v for k, v in first_tables(spark).items() if k != "City"}, str(tmp_path))
    loads.start(spark, first_tables(spark), str(tmp_path))
    with pytest.raises(ValueError, match="no load for City"):
        loads.load_staged(spark, str(tmp_path), {"City": spark.range(1)}, day(1), day(1))


def test_a_load_rewrites_only_its_months_sums(spark, tmp_path):
    folder = str(tmp_path)
    loads.start(spark, first_tables(spark), folder)
    far = staged_sales(spark, (8, 300, "4.00", 2)).withColumn("Invoice_Date_Key", F.lit(20190305))
    undated = staged_sales(spark, (7, 301, "2.00", 2)).withColumn("Invoice_Date_Key", F.lit(None).cast("int"))
    loads.load_staged(spark, folder, {"Sale": staged_sales(spark, *FIRST).unionByName(far).unionByName(undated)}, day(9), day(10))
    loads.load_staged(spark, folder, {"Sale": staged_sales(spark, *SECOND)}, day(19), day(20))
    for kind in ("lines", *summaries.SCHEMAS):
        stored = {(p.parent.name, p.name) for p in (tmp_path / "sale" / kind).glob("Stored_By=*/Invoice_Month=*")}
        first = {("Stored_By=1", f"Invoice_Month={m}") for m in (0, 201903, 202001)}
        assert stored == first | {("Stored_By=2", "Invoice_Month=202001")}, kind
    sums, sales = loads.read_summaries(spark, folder), loads.read_sales(spark, folder)
    assert {(r["Invoice_Month"], r["Customer_Key"]): (str(r["Total_Including_Tax"]), r["lines"]) for r in sums.per_customer.collect()} == {
        (0, 1): ("2.00", 1), (201903, 2): ("4.00", 1), (202001, 0): ("1.00", 1), (202001, 1): ("20.50", 3),
    }
    assert summaries.sales_kpis(sums).collect() == reports.sales_kpis(sales).collect()
    dated = sales.withColumn("Invoice_Date", F.to_date(F.col("Invoice_Date_Key").cast("string"), "yyyyMMdd"))
    assert summaries.revenue_by_month(sums).collect() == reports.revenue_by_month(dated).collect()


def test_distinct_customers_merge_across_months_and_skip_nulls(spark, tmp_path):
    rng = random.Random(3)
    keys = [None, 0, 1, 32767, 32768, 32769, 5_000_000_000, *range(100, 140)]
    rows = [(rng.choice(keys), rng.randint(1, 9), Decimal(rng.randint(1, 999)) / 100 if rng.random() < 0.9 else None, rng.choice([202001, 202002, 202003])) for _ in range(500)]
    lines = spark.createDataFrame(rows, "Customer_Key bigint, Stock_Item_Key bigint, Total_Including_Tax decimal(18,2), Invoice_Month int")
    assert summaries.sales_kpis(summaries.summarise(lines)).collect() == reports.sales_kpis(lines).collect()
    nothing = summaries.summarise(lines.limit(0))
    assert summaries.sales_kpis(nothing).collect() == reports.sales_kpis(lines.limit(0)).collect()


def test_totals_are_taken_while_the_star_is_written(spark, sf_dir, tmp_path):
    built = warehouse.rebuild(OperationalTables(spark, sf_dir), str(tmp_path))
    fact = built.pop("fact")
    taken = warehouse.read_totals(spark, str(tmp_path))
    assert taken.collect() == quality.control_totals(fact, built).collect()
    assert "parquet" not in taken._jdf.queryExecution().executedPlan().toString().lower()
    expected = taken.collect()
    (tmp_path / "v00000001" / warehouse.TOTALS).unlink()
    assert warehouse.read_totals(spark, str(tmp_path)).collect() == expected, "a version without totals is counted"


def test_a_load_needs_an_open_lineage(spark):
    with pytest.raises(ValueError, match="no open load for Customer"):
        warehouse.load_dimension(empty_warehouse(spark), staged_customers(spark), CUSTOMER, day(1))


def test_a_version_is_declared_complete_once(spark, tmp_path):
    versions.publish(spark, str(tmp_path), {"a": "b"})
    with pytest.raises(FileExistsError):
        versions.publish(spark, str(tmp_path), {"a": "c"})
    assert versions.tables_of(spark, str(tmp_path)) == {"a": "b"}


def test_a_written_warehouse_is_not_overwritten(spark, tmp_path):
    warehouse.write_warehouse(empty_warehouse(spark), str(tmp_path / "w"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        warehouse.write_warehouse(empty_warehouse(spark), str(tmp_path / "w"))


def fact_lines(spark, *rows):
    df = spark.createDataFrame(list(rows), "WWI_Invoice_ID bigint, line string, Invoice_Date_Key int")
    return months.with_month(df)


def lineage_of(spark, *successful):
    return spark.createDataFrame([(k, day(0), "Sale", day(1), True, day(0)) for k in successful], LINEAGE)


def seen(spark, folder, *successful):
    visible = months.visible_months(*months.stored_months(spark, folder), lineage_of(spark, *successful))
    return visible


def test_months_hold_one_visible_content_each(spark, tmp_path):
    folder = str(tmp_path)
    first = fact_lines(spark, (1, "a", 20200105), (1, "b", 20200106), (2, "c", 20200201), (3, "d", 20200301), (None, "e", None))
    months.store_months(first, first.select(months.MONTH).distinct(), 1, folder)
    lines = lambda *done: sorted(r["line"] for r in seen(spark, folder, *done).collect())
    assert lines() == [] and lines(1) == ["a", "b", "c", "d", "e"]

    # Invoice 1 shrinks, invoice 2 moves to March and leaves February empty.
    staged = fact_lines(spark, (1, "a2", 20200105), (2, "c2", 20200302))
    content, touched = months.restate_months(seen(spark, folder, 1), staged)
    assert sorted(r[0] for r in touched.collect()) == [202001, 202002, 202003]
    months.store_months(content, touched, 2, folder)
    assert lines(1) == ["a", "b", "c", "d", "e"], "an unfinished load changes nothing"
    assert lines(1, 2) == ["a2", "c2", "d", "e"]

    months.store_months(content, touched, 2, folder)
    assert lines(1, 2) == ["a2", "c2", "d", "e"], "a retry replaces its own files"


def test_reading_months_lists_only_the_wanted_folders(spark, tmp_path):
    folder = str(tmp_path)
    first = fact_lines(spark, (1, "a", 20200105), (2, "b", 20200201), (3, "c", 20200301))
    read = lambda *done: months.read_months(spark, folder, lineage_of(spark, *done), first.schema)
    assert read(1).collect() == []
    months.store_months(first, first.select(months.MONTH).distinct(), 1, folder)
    content, touched = months.restate_months(read(1), fact_lines(spark, (2, "b2", 20200302)))
    months.store_months(content, touched, 2, folder)
    assert sorted(r["line"] for r in read(1).collect()) == ["a", "b", "c"]
    assert sorted(r["line"] for r in read(1, 2).collect()) == ["a", "b2", "c"], "a month that became empty has no folder"
    parts = {tuple(f.split("/")[-3:-1]) for f in read(1, 2).inputFiles()}
    assert parts == {("Stored_By=1", "Invoice_Month=202001"), ("Stored_By=2", "Invoice_Month=202003")}
    assert not (tmp_path / "lines" / "Stored_By=2" / "Invoice_Month=202001").exists(), "a month no line touches gains no file"


def test_month_folders_of_other_loads_are_pruned(spark, tmp_path):
    folder = str(tmp_path)
    first = fact_lines(spark, (1, "a", 20200105))
    months.store_months(first, first.select(months.MONTH).distinct(), 1, folder)
    plan = seen(spark, folder, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Stored_By" in plan


def test_history_of_test_data_keeps_one_current_row_per_key(spark, sf_dir):
    from starloom.operators.history import apply_history

    base, batch = testdata.dimension_base(spark, sf_dir, CUSTOMER), testdata.dimension_batch(spark, sf_dir, CUSTOMER)
    applied = apply_history(base, batch, CUSTOMER, 2)
    assert applied.count() == base.count() + batch.count()
    assert current_rows(applied).count() == base.count()
    assert applied.select("Customer_Key").distinct().count() == applied.count()


def scanned_rows(df):
    """Rows that the scans of an executed plan gave."""
    df.collect()

    def nodes(plan):
        if plan.nodeName() == "AdaptiveSparkPlan":
            plan = plan.executedPlan()
        if "QueryStage" in plan.nodeName():
            plan = plan.plan()
        yield plan
        for i in range(plan.children().size()):
            yield from nodes(plan.children().apply(i))

    return sum(n.metrics().apply("numOutputRows").value() for n in nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan"))


def test_restated_invoices_open_few_row_groups(spark, tmp_path, monkeypatch):
    """A month of scattered invoice ids: lines lie in order of them, and each row group's bloom filter tells which it holds."""
    folder, n = str(tmp_path), 60_000
    lines = spark.range(n).select(
        F.xxhash64("id").alias("WWI_Invoice_ID"), F.md5(F.col("id").cast("string")).alias("line"), F.lit(20200105).alias("Invoice_Date_Key")
    )
    fact = months.with_month(lines)
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(64 * 1024))
    try:
        months.store_months(fact, fact.select(months.MONTH).distinct(), 1, folder)
    finally:
        hadoop.unset("parquet.block.size")
    visible = months.read_months(spark, folder, lineage_of(spark, 1), fact.schema)
    some = [r[0] for r in lines.select("WWI_Invoice_ID").limit(3).collect()]
    staged = months.with_month(spark.createDataFrame([(i, "restated", 20200305) for i in some], "WWI_Invoice_ID bigint, line string, Invoice_Date_Key int"))
    assert sorted(r[0] for r in months.touched_months(visible, staged).collect()) == [202001, 202003]
    with settings(spark, spark_sql_parquet_pushdown_inFilterThreshold=str(months.PROBED)):
        assert 0 < scanned_rows(visible.where(F.col("WWI_Invoice_ID").isin(some)).select(months.MONTH)) < n / 4
        assert scanned_rows(visible.where(F.col("WWI_Invoice_ID").isin([7, 8, 9])).select(months.MONTH)) < n / 10
    monkeypatch.setattr(months, "PROBED", 2)
    assert sorted(r[0] for r in months.touched_months(visible, staged).collect()) == [202001, 202003], "many invoices are joined"


@pytest.mark.parametrize("words", [0, 1000])
def test_restated_months_shuffle_no_stored_line(spark, tmp_path, monkeypatch, words):
    """Many invoices, of any sign and far apart, some missing: packed as bits they are broadcast; too many words are joined."""
    from starloom.operators import replace

    monkeypatch.setattr(months, "PROBED", 2)
    monkeypatch.setattr(replace, "WORDS", words)
    ids = [None, -65, -64, -1, 0, 1, 63, 64, 65, 127, 128, 2**62, -(2**62)]
    stored = fact_lines(spark, *[(i, f"old {i} {n}", 20200105 + 100 * n) for i in ids for n in range(2)])
    gone = [-64, 0, 63, 64, 128, 2**62, 5]
    staged = fact_lines(spark, (None, "new", 20200105), *[(i, f"new {i}", 20200405) for i in gone])
    months.store_months(stored, stored.select(months.MONTH).distinct(), 1, str(tmp_path))
    content, touched = months.restate_months(seen(spark, str(tmp_path), 1), staged)
    assert sorted(r[0] for r in touched.collect()) == [202001, 202002, 202004]
    kept = [f"old {i} {n}" for i in ids if i not in gone for n in range(2)]
    assert sorted(r["line"] for r in content.collect()) == sorted(kept + ["new"] + [f"new {i}" for i in gone])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        content, _ = months.restate_months(seen(spark, str(tmp_path), 1), staged)
        shuffles = content._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffles == (0 if words else 2)


def test_kept_lines_stay_in_their_months(spark, tmp_path, monkeypatch):
    """Kept lines are written from where they lie, not dealt by month again, unless loads have left a month in many files."""
    stored = fact_lines(spark, *[(i, f"old {i}", 20200105 + 100 * (i % 3)) for i in range(30)])
    staged = fact_lines(spark, (4, "new 4", 20200105), (99, "new 99", 20200405))
    months.store_months(stored, stored.select(months.MONTH).distinct(), 1, str(tmp_path))
    visible = months.read_months(spark, str(tmp_path), lineage_of(spark, 1), stored.schema)
    for most, dealt in ((8, 0), (0, 1)):
        monkeypatch.setattr(months, "FILES_PER_MONTH", most)
        content, touched = months.restate_months(visible, staged, staged.withColumn("line", F.upper("line")))
        assert content._jdf.queryExecution().optimizedPlan().toString().count("RebalancePartitions") == dealt
        months.store_months(content, touched, 2, str(tmp_path), dealt=True)
        got = months.read_months(spark, str(tmp_path), lineage_of(spark, 1, 2), stored.schema)
        assert sorted(r["line"] for r in got.collect()) == sorted([f"old {i}" for i in range(30) if i != 4] + ["NEW 4", "NEW 99"])


def test_a_load_removes_what_it_shuffled(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+", disk.getAllFiles().mkString(" ")))
    before = shuffled()
    loads.start(spark, first_tables(spark), str(tmp_path))
    loads.load_staged(spark, str(tmp_path), {"Sale": staged_sales(spark, *FIRST)}, day(9), day(10))
    for _ in range(50):  # the files go a moment later
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert shown(spark, str(tmp_path)) == {(100, 1, "5.00", 1), (101, 1, "6.00", 1), (102, 0, "1.00", 1)}
