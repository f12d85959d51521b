"""Type 2 histories stored by business key, so that loads and lookups don't shuffle them.

All files of a history are bucketed by the business key. Current versions lie in one folder and every load's closed versions in one of their
own. A load joins the staged keys to the current folder alone, bucket by bucket; it writes a new current folder and the rows that
it has closed, and leaves older closed rows where they are. Which folders make up a version of the history is written last
(``sources.versions``), so a half-written load is never seen.

A version is read through a catalog table of the session whose partitions are these folders: a filter on ``Part`` reads the current rows only.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.constants import end_of_time
from starloom.operators.history import LINEAGE_KEY, VALID_FROM, VALID_TO, HistorySpec, number_staged, rows_to_close_off
from starloom.operators.lookup import VersionedDimension
from starloom.session import materialise
from starloom.sources import versions

CURRENT = "current"
_SCHEMA, _BUCKETS, _LARGEST = "schema", "buckets", "largest"
PART = "Part"


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _bucketed(key: str, buckets: int) -> str:
    return f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS"


def _write(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write bucket files to a folder. Rows that are dealt by the key already stay in their tasks, one file each."""
    spark = df.sparkSession
    name = _name(path)
    spark.sql(f"CREATE TABLE {name} ({_columns(df.schema)}) USING parquet {_bucketed(key, buckets)} LOCATION '{path}'")
    try:
        df.write.insertInto(name, overwrite=True)
    finally:
        spark.sql(f"DROP TABLE {name}")  # of the name only: the files are external


def _name(path: str) -> str:
    return f"starloom_{sha256(path.encode()).hexdigest()[:24]}"


def _publish(spark: SparkSession, target: str, parts: Mapping[str, str], schema: StructType, buckets: int, largest: int) -> str:
    versions.publish(spark, target, {**parts, _SCHEMA: schema.json(), _BUCKETS: str(buckets), _LARGEST: str(largest)})
    return target


def _described(spark: SparkSession, version: str) -> tuple[dict[str, str], StructType, int, int]:
    """The parts of a version and their folders, the columns, the number of buckets and the largest key."""
    found = versions.tables_of(spark, version)
    schema = StructType.fromJson(json.loads(found.pop(_SCHEMA)))
    return found, schema, int(found.pop(_BUCKETS)), int(found.pop(_LARGEST))


def start(dimension: DataFrame, spec: HistorySpec, folder: str, buckets: int | None = None) -> str:
    """Store a history as version 0. ``buckets`` is for the lifetime of the store, as a task holds one.

    By default there are as many as the session has shuffle partitions. With fewer than that, Spark would rather deal the history
    anew in joins, to keep its tasks busy.
    """
    spark = dimension.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = versions.version_folder(folder, 0)
    dealt = dimension.repartition(buckets, spec.business_key)
    is_current = F.col(VALID_TO).eqNullSafe(end_of_time())
    parts = {CURRENT: f"{target}/{CURRENT}", "closed-0": f"{target}/closed"}
    _write(dealt.where(is_current), parts[CURRENT], spec.business_key, buckets)
    _write(dealt.where(~is_current), parts["closed-0"], spec.business_key, buckets)
    largest = dimension.agg(F.max(spec.surrogate)).first()[0] or 0
    return _publish(spark, target, parts, dimension.schema, buckets, largest)


def read(spark: SparkSession, folder: str, spec: HistorySpec, version: str | None = None) -> DataFrame:
    """All versions of the newest stored history, bucketed by the business key, with the ``Part`` that each row lies in."""
    version = version or versions.newest(spark, folder)
    parts, schema, buckets, _ = _described(spark, version)
    name = _name(version)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({_columns(schema)}, {PART} string) USING parquet PARTITIONED BY ({PART}) {_bucketed(spec.business_key, buckets)} LOCATION '{version}'")
        for part, path in parts.items():
            spark.sql(f"ALTER TABLE {name} ADD PARTITION ({PART} = '{part}') LOCATION '{path}'")
    return spark.table(name)


def current(spark: SparkSession, folder: str, spec: HistorySpec, version: str | None = None) -> DataFrame:
    """The current versions; no file with closed ones is opened."""
    return read(spark, folder, spec, version).where(F.col(PART) == CURRENT).drop(PART)


def dimension(spark: SparkSession, folder: str, spec: HistorySpec, version: str | None = None) -> VersionedDimension:
    """The history for point-in-time lookups, which then leave it where it is."""
    return VersionedDimension(read(spark, folder, spec, version).drop(PART), spec.business_key, spec.surrogate, stays=True)


def _split(spark: SparkSession, folder: str, version: str, staging: DataFrame, spec: HistorySpec) -> tuple[DataFrame, DataFrame]:
    """The current versions that the batch closes, closed, and the others."""
    rows = current(spark, folder, spec, version)
    starts = rows_to_close_off(staging, spec).select(F.col(spec.business_key).alias("_bk"), F.col(VALID_FROM).alias("_end"))
    same = F.col(spec.business_key) == F.col("_bk")
    closed = rows.join(starts, same).select(*[F.col("_end").alias(c) if c == VALID_TO else F.col(c) for c in rows.columns])
    return closed, rows.join(starts, same, "left_anti")


def apply(spark: SparkSession, folder: str, staging: DataFrame, spec: HistorySpec, lineage_key: int) -> str:
    """Apply a staged batch to the newest version, as ``apply_history`` does, and return the new one's folder."""
    base, target = versions.newest(spark, folder), versions.unused(spark, folder)
    parts, schema, buckets, largest = _described(spark, base)
    batch = materialise(staging, "staged")
    so_far = spark.createDataFrame([(largest,)], f"{spec.surrogate} bigint")
    numbered = number_staged(so_far, batch, spec).withColumn(LINEAGE_KEY, F.lit(lineage_key).cast("bigint")).select(*schema.names)
    numbered = materialise(numbered, "numbered")
    added = numbered.repartition(buckets, spec.business_key)
    is_current = F.col(VALID_TO).eqNullSafe(end_of_time())
    closed, untouched = _split(spark, folder, base, batch, spec)
    paths = {CURRENT: f"{target}/{CURRENT}", f"closed-{len(parts) - 1}": f"{target}/closed"}
    still_current = closed.where(is_current)  # a staged start at the end of time closes nothing
    _write(untouched.unionByName(still_current).unionByName(added.where(is_current)), paths[CURRENT], spec.business_key, buckets)
    _write(closed.where(~is_current).unionByName(added.where(~is_current)), paths[f"closed-{len(parts) - 1}"], spec.business_key, buckets)
    newest = numbered.agg(F.max(spec.surrogate)).first()[0] or largest
    return _publish(spark, target, {**parts, **paths}, schema, buckets, newest)
