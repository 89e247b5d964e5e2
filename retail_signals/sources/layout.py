"""Tables stored by series: bucketed by (store, item) and sorted, on any file system.

A bucketed table's files carry their bucket, but Spark learns the layout from the
catalog. So the layout (buckets, sort columns, schema) lies beside the files in
``_layout.json``, and reading registers an external table over them in the
session's catalog. Windows, folds and joins by series over such tables need no
exchange. One bucket is one file, so ``buckets`` has to follow the data (128 to
256 MB a bucket). ``materialize_by_series`` stores an intermediate table so, in as
many buckets as the session has shuffle partitions.
"""
from __future__ import annotations

import hashlib
import json
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..operators.demand import SERIES_KEYS
from ..session import checkpoint_dir, qualified, read_text, replace_text

LAYOUT = "_layout.json"


def _name(path: str) -> str:
    return "by_series_" + hashlib.sha256(path.encode()).hexdigest()[:24]


@contextmanager
def _bucket_by_bucket(spark: SparkSession):
    """While it lasts, tables by series are scanned one bucket to a task. Where nothing
    in a plan asks for the buckets, Spark packs files of many into a task; a task that
    writes by series sorts its rows by bucket, so it would sort (and spill) them all."""
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_by_series(df: DataFrame, path: str, buckets: int, sort_by: tuple[str, ...] | None = ("date",),
                    dealt: bool = False, options: dict[str, str] | None = None) -> str:
    """Write ``df`` with one file for each bucket of series, sorted by series and
    ``sort_by`` (None: each file in the order of its rows). ``dealt``: ``df`` lies by
    series already, as windows, joins and folds by series leave it, so its rows stay
    where they are; elsewhere every task would write a file into every bucket.
    ``options`` go to the Parquet writer."""
    spark, path = df.sparkSession, qualified(df.sparkSession, path)
    name = _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    order = () if sort_by is None else (*SERIES_KEYS, *(c for c in sort_by if c in df.columns))
    rows = df if dealt else df.repartition(buckets, *SERIES_KEYS)
    writer = (rows.write.mode("overwrite").options(**(options or {})).option("path", path)
              .option("compression", "zstd").bucketBy(buckets, *SERIES_KEYS))
    with _bucket_by_bucket(spark):
        (writer.sortBy(*order) if order else writer).saveAsTable(name)
    columns = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    replace_text(spark, f"{path}/{LAYOUT}", json.dumps({"buckets": buckets, "sort": order, "columns": columns}))
    return path


def stored_layout(spark: SparkSession, path: str) -> dict | None:
    """Buckets, sort columns and columns of a table by series; None for other tables."""
    text = read_text(spark, f"{path}/{LAYOUT}")
    return None if text is None else json.loads(text)


def read_by_series(spark: SparkSession, path: str) -> DataFrame:
    """A table of :func:`write_by_series`, from any session."""
    path = qualified(spark, path)
    layout, name = stored_layout(spark, path), _name(path)
    if layout is None:
        raise ValueError(f"{path}: not stored by series ({LAYOUT} is missing)")
    columns = ", ".join(f"`{c}` {t}" for c, t in layout["columns"])
    place = path.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    order = f"SORTED BY ({', '.join(layout['sort'])}) " if layout["sort"] else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(SERIES_KEYS)}) "
              f"{order}INTO {layout['buckets']} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def materialize_by_series(df: DataFrame, sort_by: tuple[str, ...] | None = None, dealt: bool = True) -> DataFrame:
    """As ``materialize``, stored by series: what reads it by series needs no exchange."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/retail_signals/{uuid.uuid4().hex}"
    return read_by_series(spark, write_by_series(
        df, path, int(spark.conf.get("spark.sql.shuffle.partitions")), sort_by, dealt))
