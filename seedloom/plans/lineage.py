"""Cutting lineage through the folder that all executors share.

The folder is ``spark.checkpoint.dir`` of the session. Where it is unset, a local session (tests) gets a
temporary folder of this machine for its lifetime; on a cluster that is an error.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, without a slash at its end."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="seedloom_")
        atexit.register(shutil.rmtree, folder[len("file://"):], ignore_errors=True)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df``: computed once, read again after the loss of an executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder; later reads prune columns, partitions and row groups."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table_{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any file system; none if it isn't there."""
    system, at = _file_system(spark, folder)
    return [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []


def make_folder(spark: SparkSession, folder: str) -> None:
    """Makes a folder of any file system."""
    system, at = _file_system(spark, folder)
    system.mkdirs(at)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file of any file system."""
    return "\n".join(r.value for r in spark.read.option("lineSep", "\n").text(path).collect())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that appears whole, by a rename; a file that is there is refused."""
    system, at = _file_system(spark, path)
    _, draft = _file_system(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = system.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    if system.exists(at) or not system.rename(draft, at):
        system.delete(draft, False)
        raise FileExistsError(path)
