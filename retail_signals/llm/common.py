"""Helpers shared by the operators: staged tables, Arrow maps, worker state."""
from __future__ import annotations

import re
import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's setting to delete a query's shuffle files when the query has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's limit of an Arrow batch's bytes; its default counts rows only, so a
#: batch of long texts or large sets has no bound.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Settings of a staged table's write: the table replaces the shuffle files that
#: made it, and Python workers get small batches.
STAGE_SETTINGS = {CLEAN_UP: "true", BATCH_BYTES: "4m"}

ARROW_TYPES = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
    "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
}


def stage_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or a
    folder in the session's warehouse (shared as well) where that is unset."""
    return (spark.conf.get("spark.checkpoint.dir", None)
            or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages").rstrip("/")


def stage(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` once into the shared folder; return the table and its path.

    Cuts the lineage and fixes row order, random draws and row numbers: a lost
    executor re-reads the files instead of recomputing what made them.
    """
    spark = df.sparkSession
    path = f"{stage_dir(spark)}/llm/{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in STAGE_SETTINGS}
    for k, v in STAGE_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path), path


def drop_stage(spark: SparkSession, *paths: str) -> None:
    """Delete staged tables that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def stage_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a staged table's files."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def worker_state(name: str, make: Callable):
    """An object that is made once in each Python worker and kept between tasks
    (functions pickled by value get new globals in each task)."""
    store = sys.modules.setdefault("_retail_signals_llm_state", types.ModuleType("state")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def forget_state() -> None:
    """Drop what earlier operators left in this Python worker."""
    sys.modules.pop("_retail_signals_llm_state", None)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """Short runs of rows, so that Python copies of texts stay small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def record_batch(schema: str, columns: dict[str, list]) -> pa.RecordBatch:
    """An Arrow batch with the columns of a DDL schema of plain types."""
    fields = [f.strip().split(" ") for f in re.split(r",\s*", schema)]
    return pa.record_batch([pa.array(columns[n], type=ARROW_TYPES[t]) for n, t in fields],
                           names=[n for n, _ in fields])


def map_texts(df: DataFrame, kernel: Callable[[list[str]], dict[str, list]], schema: str,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Apply ``kernel`` to the whole texts of short runs of rows, Arrow batch by
    Arrow batch. ``schema`` lists the result columns after the id."""
    ids = df.schema[id_col].dataType.simpleString().replace("bigint", "long")
    full = f"{id_col} {ids}, {schema}"

    def run(batches):
        for part in slices(batches):
            out = kernel(part.column(1).to_pylist())
            yield record_batch(full, {id_col: part.column(0).to_pylist(), **out})

    return df.select(F.col(id_col), text_of(text_col).alias("text")).mapInArrow(run, full)


def byte_words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, as UTF-8
    (``bytes.split`` and ``bytes.lower`` know just these ASCII characters)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def map_rows(df: DataFrame, run: Callable) -> DataFrame:
    """``mapInArrow`` that keeps the columns of ``df``, whatever their names
    (Spark can't read names with dots there): batches have them by place."""
    placed = df.toDF(*(f"c{k}" for k in range(len(df.columns))))
    return placed.mapInArrow(run, placed.schema).toDF(*df.columns)


_SHINGLE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                     0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift, multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles; fewer words make
    one shingle, none make an empty set."""
    from xxhash import xxh3_64_intdigest

    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        if len(words) < 5:
            total = np.uint64(len(words))
            for x in h:
                total = mix64(np.array([total * _SHINGLE[0] + x]))[0]
            return np.array([total], np.uint64)
        n = len(h) - 4
        s = h[:n] * _SHINGLE[0]
        for j in range(1, 5):
            s = s + mix64(h[j:j + n] + _SHINGLE[j]) * _SHINGLE[j]
        return np.unique(mix64(s))
