"""Session settings, shared scratch tables and broadcast bounds used across the library."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Largest side, in rows, that an operator may broadcast by hint.  Every hint in this library is
#: either on a literal table of fixed size or on one whose count was held against this bound.
BROADCAST_ROWS = 50_000


def local_session(cores: int | str = 8, name: str = "sievewright", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SIEVEWRIGHT_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    It is what the cluster names in ``spark.checkpoint.dir``.  Only where that is unset, as in
    tests on one machine, a temporary folder is made and remembered in the session.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="sievewright-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new place in the shared folder, below one folder of the application."""
    _REGISTERED or _REGISTERED.append(atexit.register(_clean_at_exit))
    return f"{scratch_dir(spark)}/sievewright/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


_REGISTERED: list = []


def clean(spark: SparkSession) -> bool:
    """Delete what this application has written to the shared folder; what is still read from there fails."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark)}/sievewright/{spark.sparkContext.applicationId}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _clean_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:  # else it was stopped, and whoever did had the folder to clean
        try:
            clean(spark)
        except Exception:  # nothing is left to report it to
            pass


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: the rows survive the loss of any executor, are computed once however
    often they are read, and are stored compressed and by column.  The folder goes when the
    application ends, or with :func:`clean`.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the tables of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
