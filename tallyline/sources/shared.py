"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; where unset, a folder of our own in one
    JVM (tests), and an error on a cluster, whose executors don't see the driver's."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tallyline-")
        spark.conf.set("spark.checkpoint.dir", found)
        _drop_at_exit(spark, found)
    return found.rstrip("/")


def _drop_at_exit(spark: SparkSession, path: str) -> None:
    def drop() -> None:
        try:
            remove(spark, path)
        except Exception:  # the session may have ended before
            pass

    atexit.register(drop)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, whatever store it is in."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, dropped when the driver ends."""
    path = f"{shared_dir(spark)}/tallyline-{name}-{uuid.uuid4().hex}"
    _drop_at_exit(spark, path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table written to the shared folder and read again: it cuts the
    lineage and the plan, and a lost executor costs no recomputation of what
    lies before."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def dropped(df: DataFrame) -> None:
    """Removes the table behind a result of `written` that nothing reads any more."""
    path = getattr(df, "_written_at", None)
    if path:
        remove(df.sparkSession, path)
