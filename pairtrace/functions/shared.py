"""Materialising intermediate tables where every executor and the driver can read them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUN = f"pairtrace-{uuid.uuid4().hex}"
#: How often the intermediates were dropped; what was cached before names tables that are gone.
_drops = 0


def shared_dir(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; a temporary one only where the session names none and runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named and not context.getCheckpointDir():
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="spark-checkpoint-")
    if named and not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named or context.getCheckpointDir()


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{_RUN}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends at replicated files."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another name on the same file system in one step; nothing is copied."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(new.getParent())
    if files.exists(new) or not files.rename(old, new):
        raise RuntimeError(f"{path} could not be moved to {to}")


def drop_intermediates(spark: SparkSession) -> None:
    """Remove what ``materialize`` wrote in this process. DataFrames that were not written yet can't be read any more."""
    global _drops
    _drops += 1
    path = spark._jvm.org.apache.hadoop.fs.Path(_run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def generation() -> int:
    return _drops


def changed_at(spark: SparkSession, path: str) -> int:
    """Latest change, in milliseconds, of a file or of a folder and its files; 0 where there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return 0
    inside = [s.getModificationTime() for s in files.listStatus(at)] if files.getFileStatus(at).isDirectory() else []
    return max([files.getFileStatus(at).getModificationTime(), *inside])
