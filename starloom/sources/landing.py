"""Readers and writers: parquet, CSV, JSON control totals and database extracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starloom.sources import csv_split, inference
from starloom.sources.schemas import OPERATIONAL, SOURCE_TABLES

# Text fields may hold commas, quotes and line breaks; an absent value is an empty field.
CSV_OPTIONS = {
    "header": "true",
    "nullValue": "",
    "emptyValue": "",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path``, which must not be one that ``df`` reads."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """CSV with a header per file."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).option("maxRecordsPerFile", rows_per_file).csv(path)


def _csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The columns of ``schema``, whose files are split among tasks even where quoted fields hold line breaks."""
    reader = spark.read.schema(schema).options(**CSV_OPTIONS).option("mode", "FAILFAST")
    ranges = csv_split.ranges(spark, path)
    if csv_split.is_plain(ranges):
        return reader.csv(path)
    if not csv_split.is_balanced(ranges):  # only a parser that goes through the whole file can read it
        return reader.option("multiLine", "true").csv(path)
    options = {**CSV_OPTIONS, "mode": "FAILFAST"}
    fields = F.from_csv("record", F.lit(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)), options)
    return csv_split.records(spark, path, ranges).select(fields.alias("fields")).select("fields.*")


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV against a declared schema; a value that does not fit fails the read."""
    return _csv(spark, path, schema)


def read_csv_inferred(spark: SparkSession, path: str, keep_zeros: bool = False) -> DataFrame:
    """CSV with types taken from every row, at the price of one more pass over the values.

    Whole numbers are always bigint, so that the type does not depend on how large the values happen to be.
    """
    values = _csv(spark, path, _as_text(spark, path))
    return inference.with_types(values, inference.infer_types(values, keep_zeros))


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, schema: StructType | None = None) -> DataFrame:
    df = read_csv_inferred(spark, csv_path) if schema is None else read_csv(spark, csv_path, schema)
    write_parquet(df, parquet_path)
    return spark.read.parquet(parquet_path)


def extract(table: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns of a source table, in order and with the declared types."""
    return table.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema.fields])


#: Tables that grow with sales.
SLICED = (OPERATIONAL["invoices"], OPERATIONAL["invoicelines"])


def extract_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    schema: StructType,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Read a database table in parallel slices of ``partition_column``; only the declared columns travel.

    The sale tables are refused without slices, as one task would read them whole.
    """
    if schema in SLICED and (partition_column is None or bounds is None or partitions < 2):
        raise ValueError(f"{table} needs a partition column, its bounds and several partitions")
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if partition_column is not None and bounds is not None:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return extract(reader.load(), schema)


def key_bounds(spark: SparkSession, url: str, table: str, key: str, properties: Mapping[str, str]) -> tuple[int, int] | None:
    """The least and largest ``key``, computed by the database; None for an empty table."""
    query = f"(SELECT min({key}) AS lo, max({key}) AS hi FROM {table}) AS bounds"
    row = spark.read.format("jdbc").options(url=url, dbtable=query, **properties).load().first()
    return None if row is None or row[0] is None else (int(row[0]), int(row[1]))


def extract_source(spark: SparkSession, name: str, source: str, kind: str, options: Mapping[str, str], partitions: int = 1) -> DataFrame:
    """One operational table of a source: a folder of parquet or CSV files by the source's table names, or a database."""
    table, key = SOURCE_TABLES[name]
    schema = OPERATIONAL[name]
    if kind == "jdbc":
        if partitions == 1:
            return extract_jdbc(spark, source, table, schema, options)
        # The bounds only set the stride; Spark's outer slices are open-ended.
        low, high = key_bounds(spark, source, table, key, options) or (0, 0)
        return extract_jdbc(spark, source, table, schema, options, key, (low, high + 1), partitions)
    if kind == "csv":
        return extract(read_csv(spark, f"{source}/{table}.csv", _as_text(spark, f"{source}/{table}.csv")), schema)
    return extract(spark.read.parquet(f"{source}/{table}.parquet"), schema)


def _as_text(spark: SparkSession, path: str) -> StructType:
    """The columns of a CSV file's header, all as text."""
    names = spark.read.options(**CSV_OPTIONS).option("multiLine", "true").csv(path).columns
    return StructType([StructField(name, StringType()) for name in names])


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows, counted in a single job."""
    counted = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("entity"), "n_rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def write_totals(totals: DataFrame, path: str) -> None:
    """One JSON object of named totals; ``totals`` is a single row by construction."""
    totals.write.mode("overwrite").json(path)


def read_totals(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def land(df: DataFrame, path: str) -> int:
    """Write a table and return how many rows were written, counted from the files' own statistics."""
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def read_operational(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The eleven operational tables of a landing folder, cast to their declared types.

    Files landed by way of text may hold money as doubles; the cast per row makes later sums exact.
    """
    return {name: extract(spark.read.parquet(f"{folder}/src_{name}.parquet"), schema) for name, schema in OPERATIONAL.items()}
