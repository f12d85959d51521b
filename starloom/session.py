"""Session defaults and the shared folder for tables written mid-plan."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "starloom", cores: str | int = "*", **settings: str) -> SparkSession:
    """A local session with the settings the library is tuned for; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is taken only for a local master, where driver and tasks share one disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return os.path.join(tempfile.gettempdir(), "starloom-checkpoints")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/starloom/{label}-{uuid.uuid4().hex}"


#: Under this setting a query's shuffle files go when it ends, not when the driver happens to collect its garbage. One that is
#: asked again computes them anew.
SHUFFLES_REMOVED = {"spark_sql_classic_shuffleDependency_fileCleanup_enabled": "true"}


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session, named with underscores for dots, for the jobs that run inside."""
    names = {name.replace("_", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Later steps then see one fixed set of rows however often they scan it, and a lost executor
    re-reads files instead of replaying the plan. The files are packed tightly, as they are written and read once or twice.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
