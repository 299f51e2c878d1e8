"""Tables written to the cluster's shared folder, so that lost executors cost no rework."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from sunframe.errors import ConfigError


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only where it is unset and all runs on this machine, as in tests."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ConfigError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="sunframe-"))
    return context._jsc.sc().getCheckpointDir().get()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_folder(spark)}/sunframe/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove_late, spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def _remove_late(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone; the folder is scratch
        remove(spark, path)


def materialised(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet and read back with its schema: later stages do not recompute it."""
    path = shared_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
