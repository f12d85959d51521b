"""Time the headline queries, cold and warm, and two operators against their literal SQL forms.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores. Every result is computed in
full and thrown away. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.catalog import QUERIES
from starloom.operators.ordered import dense_keys
from starloom.session import build_session
from starloom.sources import testdata

HEADLINES = (
    "dim_customer dim_stockitem dim_supplier surrogate_key_dense fact_sale fact_measures resolve_current_keys "
    "pit_customer pit_bill_to pit_stockitem pit_salesperson pit_salesperson_swept pit_city pit_all_roles "
    "scd2_close scd2_apply_customer scd2_apply_stockitem scd2_apply_supplier fact_replace_by_invoice "
    "lineage_open_key cutoff_advance visible_loads reconcile_totals unresolved_keys grain_check "
    "sales_kpis revenue_by_category revenue_by_month top_items bar_share kpi_labels parquet_roundtrip csv_roundtrip_typed"
).split()


def seconds(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def literal_lookup(spark, sf_dir):
    """The customer lookup as one scalar subquery per line."""
    testdata.sale_staging(spark, sf_dir).createOrReplaceTempView("staged")
    testdata.customer_history(spark, sf_dir).frame.createOrReplaceTempView("versions")
    return spark.sql(
        """SELECT Sale_Key, coalesce((SELECT min_by(v.Customer_Key, v.Valid_From) FROM versions v
             WHERE v.WWI_Customer_ID = s.WWI_Customer_ID AND s.Last_Modified_When > v.Valid_From
               AND s.Last_Modified_When <= v.Valid_To), 0) AS Customer_Key FROM staged s"""
    )


def lines(spark, sf_dir):
    return testdata.raw(spark, sf_dir, "lineitem")


ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def literal_numbering(spark, sf_dir):
    return lines(spark, sf_dir).withColumn("line_key", F.row_number().over(Window.orderBy(*ORDER)))


def dense_numbering(spark, sf_dir):
    return dense_keys(lines(spark, sf_dir), ORDER, "line_key")


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = build_session("starloom-bench", cpus, **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")

    cold, warm = {}, {}
    for name in HEADLINES:
        cold[name] = seconds(lambda: QUERIES[name](spark, sf_dir))
        warm[name] = seconds(lambda: QUERIES[name](spark, sf_dir))

    # The literal lookup pairs every line with every version, so it runs on the next smaller data only.
    smaller = sf_dir.replace("sf0.1", "sf0.01")
    forms = {
        "numbering": (dense_numbering, literal_numbering, sf_dir),
        "lookup": (QUERIES["pit_customer"], literal_lookup, smaller),
    }
    against = {}
    for name, (ours, literal, folder) in forms.items():
        took = {"ours": min(seconds(lambda: ours(spark, folder)) for _ in range(2)), "literal": seconds(lambda: literal(spark, folder))}
        against[name] = {**took, "speedup": round(took["literal"] / took["ours"], 2), "data": os.path.basename(folder)}

    spark.stop()
    print(
        json.dumps(
            {
                "metric": "warm wall time of the headline queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "against_literal": against,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
