"""Helpers that read settings from the caller's session instead of replacing it."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or a
    folder in the session's warehouse (shared as well) where that is unset."""
    return (spark.conf.get("spark.checkpoint.dir", None)
            or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages").rstrip("/")


def materialize(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Cut the lineage of ``df`` by writing it as a Parquet table into ``folder``
    (by default the shared checkpoint folder) and reading it back.

    Used where one expensive stage (the stock fold) feeds several branches of a
    plan: the stage runs once (an RDD checkpoint would compute it a second time
    to write it), and a lost executor re-reads the files instead of recomputing
    the fold. Who names the folder removes it (``remove``).
    """
    spark = df.sparkSession
    path = f"{folder or checkpoint_dir(spark)}/retail_signals/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system and from its root (a table's location would
    else be looked for in the warehouse)."""
    where, system = _file_system(spark, path)
    return system.makeQualified(where).toString()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the file system that its path names."""
    where, system = _file_system(spark, path)
    system.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small text file to the file system that its path names."""
    where, system = _file_system(spark, path)
    out = system.create(where, True)
    try:
        out.write(text.encode("utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None where there is none."""
    where, system = _file_system(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file so that readers see the old text or the new one:
    a temporary file beside it is renamed over it in one step."""
    beside = f"{path}.{uuid.uuid4().hex}"
    write_text(spark, beside, text)
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs
    there = fs.Path(path)
    options = spark.sparkContext._gateway.new_array(getattr(fs.Options, "Rename"), 1)
    options[0] = getattr(fs.Options, "Rename").OVERWRITE
    fs.FileContext.getFileContext(there.toUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.Path(beside), there, options)
