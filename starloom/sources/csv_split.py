"""CSV files with line breaks inside quoted fields, read by many tasks.

A line break ends a record only where the quotes before it in the file are even in number. Each task counts the quotes of its byte ranges; a
running sum over a file's ranges then tells for each range whether it starts inside a field. With that every task finds the records that
start in its range on its own. What of a record lies in another range, at most one piece at either end of a range, is
joined to it afterwards.

Quotes inside a quoted field must be doubled, and a field with a quote must be quoted, as ``landing.write_csv`` does. A file with an odd number
of quotes can't be split that way.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.session import materialise

#: Ranges whose state every task may hold; of more, the rows are joined and sorted.
RANGES = 500_000


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines in the order of the file, with the byte range that a task reads them from."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def ranges(spark: SparkSession, path: str) -> DataFrame:
    """Each byte range with its quotes, its lines that don't end a record by themselves, and whether it starts ``inside`` a field."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    counted = _lines(spark, path).groupBy("file", "start").agg(
        F.sum(quotes).alias("quotes"), F.count_if((quotes % 2 == 1) | F.col("value").rlike("\r.")).alias("open_lines")
    )
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(earlier) % 2 == 1, F.lit(False))
    return materialise(materialise(counted, "csv-quotes").withColumn("inside", inside), "csv-ranges")


def is_plain(ranges: DataFrame) -> bool:
    """Whether every line is a record, so that any reader may split the files."""
    return ranges.where("open_lines > 0").limit(1).count() == 0


def is_balanced(ranges: DataFrame) -> bool:
    return ranges.groupBy("file").agg(F.sum("quotes").alias("quotes")).where("quotes % 2 = 1").limit(1).count() == 0


HEAD, MIDDLE, TAIL = range(3)


def _split(lines: DataFrame) -> DataFrame:
    """Records in the order of their lines: whole ones, and the pieces that cross the ends of ranges, which carry their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record", "header", "part", "file", "start"]
        types = [pa.string(), pa.bool_(), pa.int32(), pa.string(), pa.int64()]
        out: list[tuple] = []
        place, is_open, part, header, held = None, False, None, False, []

        def emit(part):
            nonlocal header
            out.append(("\n".join(held), header, part, *(place if part is not None else (None, None))))
            header = False
            held.clear()

        for batch in batches:
            for value, file, start, inside in zip(*(batch[c].to_pylist() for c in ("value", "file", "start", "inside")), strict=True):
                if (file, start) != place:
                    if held:
                        emit(MIDDLE if part == HEAD else TAIL)
                    place, is_open, part, header = (file, start), inside, HEAD if inside else None, start == 0
                held.append(value)
                is_open ^= bool(value.count('"') & 1)
                if not is_open:
                    emit(part)
                    part = None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                out = []
        if held:
            emit(MIDDLE if part == HEAD else TAIL)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return lines.mapInArrow(run, "record string, header boolean, part int, file string, start long")


def _joined(pieces: DataFrame) -> DataFrame:
    """The records that cross ranges: a tail with the heads and middles up to the next tail."""
    so_far = Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = pieces.select("file", "start", "part").withColumn("number", F.count_if(F.col("part") == TAIL).over(so_far))
    parts = pieces.join(numbered, ["file", "start", "part"]).groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("start", "part", "record"))).alias("parts"), F.bool_or("header").alias("header")
    )
    return parts.select(F.array_join("parts.record", "\n").alias("record"), "header")


def records(spark: SparkSession, path: str, ranges: DataFrame) -> DataFrame:
    """The ``record`` strings of the files, without each file's header and empty lines. Written once, as every reader needs them twice."""
    inside = ranges.select("file", "start", "inside")
    lines = _lines(spark, path)
    if ranges.count() <= RANGES:
        lines = lines.join(F.broadcast(inside), ["file", "start"])
    else:
        lines = lines.withColumn("_line", F.monotonically_increasing_id()).join(inside, ["file", "start"])
        lines = lines.repartition("file", "start").sortWithinPartitions("file", "start", "_line")
    split = materialise(_split(lines.select("value", "file", "start", "inside")), "csv-records")
    whole = split.where("part IS NULL").select("record", "header")
    found = whole.unionByName(_joined(split.where("part IS NOT NULL"))).where("NOT header")
    ended = F.regexp_replace("record", "\r$", "")
    return found.select(ended.alias("record")).where("record <> ''")
