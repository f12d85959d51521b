"""Apply staged batches of a dimension or of the sales as their files arrive.

Each micro-batch is one load: it is opened, applied and closed like a batch load, and its result is
a new warehouse folder numbered by the batch, which points to the files of the tables it didn't change. A folder
counts once it is declared complete, so a crash at any point is repaired by running again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from starloom.operators.history import HistorySpec
from starloom.plans import loads
from starloom.plans.warehouse import CUTOFFS, LINEAGE, SALE, load_dimension, open_load, read_warehouse, write_warehouse
from starloom.sources.versions import is_complete, tables_of, version_folder


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def apply_batch(
    spark: SparkSession, folder: str, names: Sequence[str], spec: HistorySpec, staging: DataFrame, batch: int, now: datetime
) -> None:
    """Load one batch on top of version ``batch`` and write what it changes as version ``batch + 1``."""
    target = version_folder(folder, batch + 1)
    if is_complete(spark, target):
        return
    base = version_folder(folder, batch)
    opened = open_load(read_warehouse(spark, base, names), spec.table, now, now)
    changed = {spec.table, LINEAGE, CUTOFFS}
    unchanged = {name: path for name, path in tables_of(spark, base).items() if name not in changed}
    write_warehouse(load_dimension(opened, staging, spec, now), target, mode="overwrite", unchanged=unchanged)


def stream_dimension_loads(
    spark: SparkSession,
    staging: str,
    schema: StructType,
    folder: str,
    names: Sequence[str],
    spec: HistorySpec,
    checkpoint: str,
    files_per_load: int = 1000,
    now: Callable[[], datetime] = _utc_now,
) -> StreamingQuery:
    """Load all staged files that are not loaded yet, then stop. Version 0 of the warehouse must exist.

    ``now`` gives a load's time; a replay that must repeat it passes a clock of its own.
    """

    def load(staged: DataFrame, batch: int) -> None:
        apply_batch(staged.sparkSession, folder, names, spec, staged, batch, now())

    return _stream(spark, staging, schema, checkpoint, files_per_load, load)


def apply_sales(spark: SparkSession, folder: str, staging: DataFrame, batch: int, now: datetime) -> None:
    """Load one batch of sales on top of version ``batch`` as version ``batch + 1``; only the touched months are written."""
    target = version_folder(folder, batch + 1)
    if not is_complete(spark, target):
        loads.load_staged(spark, folder, {SALE: staging}, now, now, version_folder(folder, batch), target)


def stream_sale_loads(
    spark: SparkSession,
    staging: str,
    schema: StructType,
    folder: str,
    checkpoint: str,
    files_per_load: int = 1000,
    now: Callable[[], datetime] = _utc_now,
) -> StreamingQuery:
    """Load all staged sales that are not loaded yet, then stop. Version 0 of the warehouse must exist (``loads.start``).

    A replayed batch finds its version complete, or writes the same months under the same load key again.
    """

    def load(staged: DataFrame, batch: int) -> None:
        apply_sales(staged.sparkSession, folder, staged, batch, now())

    return _stream(spark, staging, schema, checkpoint, files_per_load, load)


def _stream(
    spark: SparkSession, staging: str, schema: StructType, checkpoint: str, files_per_load: int, load: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_load).parquet(staging)
    return arriving.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
