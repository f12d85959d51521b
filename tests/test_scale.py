"""Plan shapes that matter at scale, and hot keys."""

import pytest
from pyspark.sql import functions as F

from starloom.catalog import QUERIES
from starloom.constants import end_of_time
from starloom.operators.history import HistorySpec, close_versions
from starloom.operators.lookup import LookupLimits, Role, VersionedDimension, look_up, resolve_point_in_time
from starloom.operators.replace import replace_by_invoice
from starloom.plans import quality, reports
from starloom.sources import testdata
from starloom.sources.testdata import OperationalTables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_skew_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def hot_lines(spark, n=60_000):
    """A third of all lines carry one key; several map tasks write it, as a large table's would."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    return spark.range(0, n, 1, 16).select(key.alias("WWI_Invoice_ID"), F.md5(F.col("id").cast("string")).alias("line"))


def test_a_hot_key_of_a_lookup_is_split(spark, small_skew_limits):
    table = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    found = look_up(hot_lines(spark), "WWI_Invoice_ID", table, "k", {"v": "v"})
    assert found.where("v = WWI_Invoice_ID * 2").count() == 60_000
    found.collect()
    assert "skew=true" in plan(found)


def test_a_hot_invoice_of_a_replacement_is_split(spark, small_skew_limits):
    staged = hot_lines(spark).where("WWI_Invoice_ID BETWEEN 100 AND 2000")
    replaced = replace_by_invoice(hot_lines(spark), staged)
    assert len(replaced.collect()) == 60_000
    assert "skew=true" in plan(replaced)


def test_a_hot_key_of_a_point_in_time_lookup_is_split(spark, small_skew_limits):
    start = F.lit("2020-01-01").cast("timestamp_ntz")
    versions = spark.range(5000).select(
        F.col("id").alias("bk"), (F.col("id") + 1).alias("key"), start.alias("Valid_From"), F.lit("2021-01-01").cast("timestamp_ntz").alias("Valid_To")
    )
    staged = hot_lines(spark).withColumn("t", F.lit("2020-06-01").cast("timestamp_ntz"))
    dims = {"d": VersionedDimension(versions, "bk", "key")}
    found = resolve_point_in_time(staged, "t", [Role("WWI_Invoice_ID", "d", "found")], dims, limits=LookupLimits(broadcast_rows=0))
    assert found.where("found = WWI_Invoice_ID + 1").count() == 60_000
    found.collect()
    assert "skew=true" in plan(found)


def test_a_hot_key_of_a_history_is_split(spark, small_skew_limits):
    spec = HistorySpec("Thing", "WWI_Invoice_ID", "key")
    base = hot_lines(spark).select("*", F.lit("2020-01-01").cast("timestamp_ntz").alias("Valid_From"), end_of_time().alias("Valid_To"))
    batch = spark.range(5000).select(F.col("id").alias("WWI_Invoice_ID"), F.lit("2021-01-01").cast("timestamp_ntz").alias("Valid_From"))
    closed = close_versions(base, batch, spec)
    assert len(closed.where("Valid_To < TIMESTAMP_NTZ '2022-01-01 00:00:00'").collect()) == 60_000
    closed.collect()
    assert "skew=true" in plan(closed)


def test_revenue_is_summed_before_it_meets_the_dimension(spark):
    fact = spark.range(1000).select(
        (F.col("id") % 5).alias("Customer_Key"), F.col("id").cast("decimal(18,2)").alias("Total_Including_Tax")
    )
    dim = spark.createDataFrame([(1, "c")], "Customer_Key bigint, Category string")
    text = plan(reports.category_revenue(fact, dim))
    assert "partial_sum(Total_Including_Tax" in text[text.index("Join"):]


def test_all_fact_totals_come_from_one_scan(spark, sf_dir):
    lines = OperationalTables(spark, sf_dir)["invoicelines"].select(
        F.col("ExtendedPrice").alias("Total_Including_Tax"), F.col("TaxAmount").alias("Total_Excluding_Tax"), "Quantity",
        F.col("LineProfit").alias("Profit"),
    )
    text = plan(quality.fact_totals(lines))
    assert text.count("FileScan") == 1 and "l_shipdate" not in text


def test_months_read_only_the_line_columns_they_need(spark, sf_dir):
    text = plan(QUERIES["revenue_by_month"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in text


def exchanges(df):
    """(partitioning, output columns) of each shuffle of a plan."""
    def nodes(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.initialPlan()
        yield node
        for i in range(node.children().size()):
            yield from nodes(node.children().apply(i))

    found = [node for node in nodes(df._jdf.queryExecution().executedPlan()) if node.nodeName() == "Exchange"]
    return [(node.outputPartitioning().toString(), node.output().toString()) for node in found]


def test_staged_lines_are_dealt_by_their_invoice_alone(spark, sf_dir):
    """Orders get their city before lines meet them, and the replacement uses the lines as they lie."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        lines = testdata.sale_staging(spark, sf_dir).select("Sale_Key", "WWI_City_ID", "WWI_Invoice_ID", "Quantity")
        found = exchanges(replace_by_invoice(lines, lines.where("Quantity < 3")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # With so low a threshold the package types, 25 rows, are shuffled as well.
    wide = [how for how, columns in found if ("l_quantity" in columns or "Quantity" in columns) and "PackageTypeID" not in how]
    assert len(wide) == 2 and all("l_orderkey" in how for how in wide), "once for the lines, once for the restated ones"


def test_versions_take_one_shuffle(spark):
    rows = [(1, "2020-01-03"), (1, "2020-01-01"), (1, "2020-01-03"), (1, None), (2, None), (2, None), (None, "2020-01-05"), (None, "2020-01-04")]
    changes = spark.createDataFrame(rows, "k bigint, d string").select("k", F.col("d").cast("timestamp_ntz").alias("d"))
    versions = testdata._versions(changes, "k", "d", "bk")
    end = "9999-12-31"
    assert {(r["bk"], str(r["Valid_From"])[:10], str(r["Valid_To"])[:10]) for r in versions.collect()} == {
        (1, "None", "2020-01-01"), (1, "2020-01-01", "2020-01-03"), (1, "2020-01-03", end), (2, "None", end),
        (None, "2020-01-04", "2020-01-05"), (None, "2020-01-05", end),
    }
    assert versions.count() == 6 and len(exchanges(versions)) == 1
