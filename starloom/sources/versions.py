"""Version folders, and the one file that makes a version count.

Tables are written to a folder nobody reads yet. ``complete.json`` is put there last, by a rename, and names where each table's files are:
in this version, or in an earlier one if the load didn't change the table. A folder without that file is half-written and ignored.
Versions of one warehouse have a single writer.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import SparkSession

MARKER = "complete.json"


def _at(spark: SparkSession, path: str):
    """A path and its file system, through Spark's own configuration, so that any store Spark reaches will do."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def version_folder(folder: str, version: int) -> str:
    return f"{folder}/v{version:08d}"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file."""
    fs, at = _at(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def publish(spark: SparkSession, folder: str, tables: Mapping[str, str]) -> None:
    """Declare a version complete; ``tables`` are names and the folders of their files."""
    fs, marker = _at(spark, f"{folder}/{MARKER}")
    _, draft = _at(spark, f"{folder}/_{MARKER}")
    write_text(spark, f"{folder}/_{MARKER}", json.dumps(dict(tables), indent=1))
    # Some file systems rename over an existing file, so it is looked for first; a version has a single writer.
    if fs.exists(marker) or not fs.rename(draft, marker):
        raise FileExistsError(f"{folder} is already complete")


def is_complete(spark: SparkSession, folder: str) -> bool:
    return exists(spark, f"{folder}/{MARKER}")


def tables_of(spark: SparkSession, folder: str) -> dict[str, str]:
    """Names and folders of a complete version's tables; a half-written one is refused."""
    if not is_complete(spark, folder):
        raise FileNotFoundError(f"{folder} is not a complete version")
    return json.loads(spark.read.text(f"{folder}/{MARKER}", wholetext=True).first()[0])


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of all version folders, complete or not, ascending."""
    fs, at = _at(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(name[1:]) for name in names if re.fullmatch(r"v\d{8}", name))


def newest(spark: SparkSession, folder: str) -> str:
    """The folder of the newest complete version."""
    for version in reversed(versions(spark, folder)):
        if is_complete(spark, version_folder(folder, version)):
            return version_folder(folder, version)
    raise FileNotFoundError(f"{folder} holds no complete version")


def unused(spark: SparkSession, folder: str) -> str:
    """A version folder after all that exist, half-written ones included."""
    return version_folder(folder, max(versions(spark, folder), default=0) + 1)
