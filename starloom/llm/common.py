"""Small helpers that several operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: White space of the word rules: space and \x09 to \x0D.
BLANKS = " \t\n\x0b\f\r"
#: Texts that a task holds as Python strings at a time.
TEXTS_AT_A_TIME = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+"), "")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held_out(doc_id: Column, folds: int, which: int) -> Column:
    """Whether a row is kept from learning. A row without an id counts as not held out, yet is never learned from."""
    return F.coalesce(fold(doc_id, folds) == which, F.lit(False))


def spread_sample(rows: DataFrame, key: str, order_by: str, per_key: int) -> DataFrame:
    """At most ``per_key`` rows of each key, chosen by a hash of ``order_by`` and so alike on every run.

    The rows of a key are counted first; only about four times ``per_key`` of them, by a range of the hash, are then
    ranked, so that a hot key is never gathered. ``rows`` should be narrow.
    """
    draw = F.xxhash64(F.lit("sample"), F.col(order_by))
    drawn = rows.withColumn("_draw", draw)
    share = rows.groupBy(key).agg(F.least(F.lit(1.0), 4.0 * per_key / F.count(F.lit(1))).alias("_share"))
    few = drawn.join(share, key).filter((F.pmod(F.col("_draw"), F.lit(1 << 30)) / float(1 << 30)) < F.col("_share"))
    place = F.row_number().over(Window.partitionBy(key).orderBy("_draw", order_by))
    return few.withColumn("_place", place).filter(F.col("_place") <= per_key).drop("_draw", "_share", "_place")


def one_text_each(rows: DataFrame, *keys: str) -> DataFrame:
    """One row of the keys and ``text`` for each key: the text of least hash. Chosen in the tasks, so the copies of a repeated id aren't gathered."""
    return rows.groupBy(*keys).agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text"))


def texts(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """The named columns of Arrow batches as lists, a few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_A_TIME):
            part = batch.slice(at, TEXTS_AT_A_TIME)
            yield tuple(part.column(c).to_pylist() for c in columns)


def kept(key, make):
    """What ``make()`` gave for ``key`` in this Python process: the tasks of one worker share it. For a few keys only.

    Held by a module of its own, as functions that travel with a job are made anew for each task.
    """
    memory = sys.modules.setdefault("starloom_kept", types.ModuleType("starloom_kept")).__dict__.setdefault("memory", {})
    if key not in memory:
        memory[key] = make()
    return memory[key]


class Memo(dict):
    """Remembers what ``make`` gave for a key, up to ``size`` keys; later keys are made each time they occur.

    The frequent keys of a corpus occur early, so a full memo still answers nearly all lookups.
    """

    def __init__(self, make, size: int = 300_000):
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, key):
        value = self.make(key)
        if len(self) < self.size:
            self[key] = value
        return value
