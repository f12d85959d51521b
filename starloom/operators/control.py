"""Load control: the lineage of loads, their cutoffs and which rows readers may see.

Both tables are small, but every step is written over whole tables of any size.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.sources.schemas import LINEAGE


def _moment(value: datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def open_load(lineage: DataFrame, table: str, started: datetime | str, cutoff: datetime | str) -> DataFrame:
    """The lineage with one more row: a load of ``table`` that has started and not finished."""
    newest = lineage.agg(F.max("Lineage_Key").alias("newest"))
    opened = newest.select(
        (F.coalesce("newest", F.lit(0)) + 1).cast("bigint").alias("Lineage_Key"),
        _moment(started).alias("Data_Load_Started"),
        F.lit(table).alias("Table_Name"),
        F.lit(None).cast("timestamp_ntz").alias("Data_Load_Completed"),
        F.lit(False).alias("Was_Successful"),
        _moment(cutoff).alias("Source_System_Cutoff_Time"),
    )
    return lineage.select(*LINEAGE.names).unionByName(opened)


def started_load_key(lineage: DataFrame, table: str, started: datetime | str) -> DataFrame:
    """The newest key of the loads of ``table`` that started at that moment."""
    same = (F.col("Table_Name") == table) & (F.col("Data_Load_Started") == _moment(started))
    return lineage.where(same).agg(F.max("Lineage_Key").alias("Lineage_Key"))


def open_load_key(lineage: DataFrame, table: str) -> DataFrame:
    """One row: the newest unfinished load of ``table``, or NULL."""
    pending = (F.col("Table_Name") == table) & F.col("Data_Load_Completed").isNull()
    return lineage.where(pending).agg(F.max("Lineage_Key").alias("Lineage_Key"))


def open_load_keys(lineage: DataFrame) -> DataFrame:
    """The newest unfinished load of every table, or NULL, in one pass."""
    pending = F.when(F.col("Data_Load_Completed").isNull(), F.col("Lineage_Key"))
    return lineage.groupBy("Table_Name").agg(F.max(pending).alias("Lineage_Key"))


def require_open_load(lineage: DataFrame, table: str) -> int:
    """The open load's key. Without one the load is refused: it would erase the table's cutoff."""
    key = open_load_key(lineage, table).first()["Lineage_Key"]
    if key is None:
        raise ValueError(f"no open load for {table}")
    return key


def close_load(lineage: DataFrame, key: Column | int, completed: datetime | str) -> DataFrame:
    """Mark one load as finished and successful."""
    this = F.col("Lineage_Key") == key
    return lineage.withColumn(
        "Data_Load_Completed", F.when(this, _moment(completed)).otherwise(F.col("Data_Load_Completed"))
    ).withColumn("Was_Successful", F.when(this, F.lit(True)).otherwise(F.col("Was_Successful")))


def advance_cutoff(cutoffs: DataFrame, lineage: DataFrame, table: str, key: Column | int) -> DataFrame:
    """Set the cutoff of ``table`` to the source cutoff of the load ``key``."""
    reached = lineage.where(F.col("Lineage_Key") == key).agg(F.max("Source_System_Cutoff_Time").alias("reached"))
    mine = F.col("Table_Name") == table
    return cutoffs.withColumn("Cutoff_Time", F.when(mine, reached.scalar()).otherwise(F.col("Cutoff_Time")))


def visible_loads(rows: DataFrame, lineage: DataFrame) -> DataFrame:
    """Rows whose load succeeded: a reader never sees a load that is half done."""
    done = lineage.where("Was_Successful").select("Lineage_Key")
    return rows.join(done, "Lineage_Key", "left_semi")
