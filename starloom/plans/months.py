"""A fact stored by month, where a load rewrites only the months that hold old or new lines.

Each load writes the full content of its months under its own key and notes which months it touched.
Readers take every month from the newest successful load that touched it. Files in use are never
overwritten, a half-written load is never seen, and a load that empties a month hides its old lines.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from starloom.operators.replace import Restated, restated
from starloom.session import materialise, settings
from starloom.sources.versions import exists

MONTH = "Invoice_Month"
STORED_BY = "Stored_By"
INVOICE = "WWI_Invoice_ID"
#: Restated invoices that are looked for by filters; more are joined.
PROBED = 500
#: Files of a month, on average, beyond which its lines are dealt anew when they are written again.
FILES_PER_MONTH = 8


def with_month(lines: DataFrame, date_key: str = "Invoice_Date_Key") -> DataFrame:
    """Add the month as ``yyyymm``; lines without a date go to month 0."""
    return lines.withColumn(MONTH, F.coalesce(F.floor(F.col(date_key) / 100), F.lit(0)).cast("int"))


def _newest_loads(touched: DataFrame, lineage: DataFrame) -> dict[int, list[int]]:
    """Load -> months that readers take from it. One pair per calendar month is fetched."""
    done = lineage.where("Was_Successful").select(F.col("Lineage_Key").alias(STORED_BY))
    newest = touched.join(done, STORED_BY, "left_semi").groupBy(MONTH).agg(F.max(STORED_BY).alias(STORED_BY))
    by_load = defaultdict(list)
    for row in newest.collect():
        by_load[row[STORED_BY]].append(row[MONTH])
    return by_load


def visible_months(stored: DataFrame, touched: DataFrame, lineage: DataFrame) -> DataFrame:
    """The fact as readers see it: every month from the newest successful load that touched it.

    The pairs of load and month become a filter on folder names. All folders below the store have been listed by then; ``read_months`` lists
    only those it reads.
    """
    by_load = _newest_loads(touched, lineage)
    folders = [(F.col(STORED_BY) == load) & F.col(MONTH).isin(months) for load, months in by_load.items()]
    return stored.where(reduce(or_, folders, F.lit(False))).drop(STORED_BY)


def read_months(spark: SparkSession, folder: str, lineage: DataFrame, schema: StructType, kind: str = "lines") -> DataFrame:
    """The same rows as ``visible_months``, from the folders of the wanted loads and months alone; ``schema`` is that of the lines.

    Folders of superseded and of unfinished loads are never listed, however many there are. Whatever else loads
    store by month, such as sums, is read by its ``kind``.
    """
    noted = spark.read.schema(f"{MONTH} int, {STORED_BY} bigint").parquet(f"{folder}/months") if exists(spark, f"{folder}/months") else None
    wanted = _newest_loads(noted, lineage) if noted is not None else {}
    paths = [f"{folder}/{kind}/{STORED_BY}={load}/{MONTH}={month}" for load, months in sorted(wanted.items()) for month in sorted(months)]
    paths = [path for path in paths if exists(spark, path)]  # a load that emptied a month left no folder
    typed = _typed(schema)
    if not paths:
        return spark.createDataFrame([], typed).drop(STORED_BY)
    return spark.read.schema(typed).option("basePath", f"{folder}/{kind}").parquet(*paths).drop(STORED_BY)


def _typed(schema: StructType) -> StructType:
    lines = [field for field in schema.fields if field.name not in (MONTH, STORED_BY)]
    return StructType([*lines, StructField(STORED_BY, LongType()), StructField(MONTH, IntegerType())])


def read_load(spark: SparkSession, folder: str, load: int, columns: str) -> DataFrame | None:
    """The given columns of the lines that one load has written, with their month; None if it wrote none."""
    path = f"{folder}/lines/{STORED_BY}={load}"
    if not exists(spark, path):
        return None
    typed = _typed(spark.createDataFrame([], columns).schema)
    return spark.read.schema(typed).option("basePath", f"{folder}/lines").parquet(path).drop(STORED_BY)


def touched_months(visible: DataFrame, staged: DataFrame, invoices: Restated | None = None) -> DataFrame:
    """Months of the lines to drop and of the lines to add, one row each, written.

    Up to ``PROBED`` restated invoices are pushed down to the scan, where the bloom filters of the stored months tell which row groups
    can hold one; only these are read. For more, the invoice column of the fact is read.
    """
    spark = staged.sparkSession
    invoices = invoices or restated(staged, INVOICE)
    some = [row[0] for row in invoices.invoices.limit(PROBED + 1).collect()]
    if len(some) <= PROBED:
        dropped = visible.where(F.col(INVOICE).isin(some)).select(MONTH)
    else:
        dropped = invoices.lines(visible.select(INVOICE, MONTH), INVOICE, "left_semi").select(MONTH)
    with settings(spark, spark_sql_parquet_pushdown_inFilterThreshold=str(PROBED)):
        return materialise(dropped.unionByName(staged.select(MONTH).distinct()).distinct(), "touched-months")


def restate_months(visible: DataFrame, staged: DataFrame, added: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """New content of the touched months, and those months: one row per calendar month, written once.

    The months are fetched as well, so that the other months' folders stay closed. The staged invoices are gathered once and mostly
    broadcast as bits, so that the stored lines are shuffled only to be written. What is kept and added is as in ``replace_by_invoice``.

    ``added``: the staged lines as they are to be stored, dealt by month; ``staged`` then only has to have their invoices and months. The content
    is dealt by month as well: the kept lines stay where they lie, a month in few files. They are dealt anew if loads have left it in many, or if
    the invoices had to be joined.
    """
    invoices = restated(staged, INVOICE)
    months = touched_months(visible, staged, invoices)
    affected = visible.where(F.col(MONTH).isin([row[MONTH] for row in months.collect()]))
    kept = invoices.lines(affected, INVOICE, "left_anti")
    if added is not None and (invoices.words is None or _scattered(visible.inputFiles())):
        kept = kept.hint("rebalance", MONTH)
    return kept.unionByName((staged if added is None else added).select(*visible.columns)), months


def _scattered(files: list[str]) -> bool:
    """Whether months lie in more files than they should. Each rewriting adds some, as kept lines stay apart from new ones."""
    return len(files) > FILES_PER_MONTH * len({file.rpartition("/")[0] for file in files})


def store_months(content: DataFrame, months: DataFrame, load: int, folder: str, dealt: bool = False) -> None:
    """Write one load's months, then note them.

    A retry of the same load replaces only its own folders. A large month is split over several
    write tasks by the rebalance, small ones share a task; ``dealt``: the content is dealt by month already. Lines lie in order of their
    invoice, and each row group has a bloom filter of its invoices, sized by what it holds.
    """
    stamped = (content if dealt else content.hint("rebalance", MONTH)).withColumn(STORED_BY, F.lit(load).cast("bigint")).sortWithinPartitions(STORED_BY, MONTH, INVOICE)
    noted = months.withColumn(STORED_BY, F.lit(load).cast("bigint"))
    for df, name, folders in ((stamped, "lines", (STORED_BY, MONTH)), (noted.coalesce(1), "months", (STORED_BY,))):
        writer = df.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy(*folders)
        if name == "lines":
            writer = writer.option(f"parquet.bloom.filter.enabled#{INVOICE}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(f"{folder}/{name}")


def stored_months(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The stored lines and the months each load touched."""
    lines = spark.read.parquet(f"{folder}/lines")
    months = spark.read.parquet(f"{folder}/months")
    typed = {MONTH: "int", STORED_BY: "bigint"}
    return (
        lines.select(*[F.col(c).cast(typed[c]).alias(c) if c in typed else F.col(c) for c in lines.columns]),
        months.select(*[F.col(c).cast(typed[c]).alias(c) for c in months.columns]),
    )
