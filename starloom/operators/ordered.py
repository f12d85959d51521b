"""Numbering and running values over one global order, without gathering rows in one task.

The rows are counted, which gives the number of *chunks*, and then range-partitioned on the whole order
by a sample of it. So a chunk holds about ``CHUNK_ROWS`` rows whatever the session's settings, and a value of the
leading column that holds a large share of the rows is spread by the columns behind it. The sorted rows
are written once, a chunk by a task. What has to cross chunk borders is one summary row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.session import materialise

#: Rows that one task sorts, on average.
CHUNK_ROWS = 1_000_000
_ROW_BITS = 33  # monotonically_increasing_id keeps the task number above these bits


class Counted(NamedTuple):
    """Rows with their number, or a bound of it."""

    frame: DataFrame
    rows: int


def _placed(df: DataFrame | Counted, order: Sequence[Column | str], label: str) -> DataFrame:
    frame, rows = df if isinstance(df, Counted) else (df, df.count())
    chunks = max(1, -(-rows // CHUNK_ROWS))
    ordered = frame.repartitionByRange(chunks, *order).sortWithinPartitions(*order)
    return materialise(ordered.withColumn("_id", F.monotonically_increasing_id()), label).withColumn("_chunk", F.shiftright("_id", _ROW_BITS))


def dense_keys(
    df: DataFrame, order: Sequence[Column | str], name: str, after: Column | int = 0
) -> DataFrame:
    """Add ``name`` = ``after`` + 1, + 2, ... in the given order, which must tell all rows apart; nulls come last."""
    placed = _placed(df, [F.asc_nulls_last(c) if isinstance(c, str) else c for c in order], "dense-keys")
    sizes = placed.groupBy("_chunk").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_chunk", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    start = F.lit(after) if isinstance(after, int) else after
    position = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per chunk: safe to broadcast whatever the size of df.
    return placed.join(F.broadcast(offsets), "_chunk").select(
        (start + F.col("_offset") + position + 1).cast("bigint").alias(name), *df.columns
    )


def running_max(df: DataFrame, order: Sequence[Column | str], value: str, name: str, rows: int | None = None) -> DataFrame:
    """Add ``name`` = the largest ``value`` among all rows before this one in the given order.

    ``rows``: their number or a bound of it, if known; otherwise ``df`` is computed once more to count them.
    """
    placed = _placed(df if rows is None else Counted(df, rows), order, "running-max")
    tops = placed.groupBy("_chunk").agg(F.max(value).alias("_top"))
    earlier_chunks = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select("_chunk", F.max("_top").over(earlier_chunks).alias("_carried"))
    earlier_rows = Window.partitionBy("_chunk").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    # One row per chunk: safe to broadcast whatever the size of df.
    return (
        placed.withColumn("_inside", F.max(value).over(earlier_rows))
        .join(F.broadcast(carried), "_chunk")
        .select(*df.columns, F.greatest("_inside", "_carried").alias(name))
    )
