"""Helpers the operators share: run folders, text blocks, files in shared storage, row identity."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.session import ensure_checkpoint_dir, ship_module

BLOCK_BYTES = 1 << 19


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder of the session, whose workers get this package."""
    ship_module(spark)
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def clear_runs(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Deletes the run folders that were last written so long ago; returns how many. Their results can't be read any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [x.getPath() for x in store.listStatus(folder) if time.time() * 1000 - x.getModificationTime() > older_than_hours * 3_600_000] if store.exists(
        folder) else []
    for path in old:
        store.delete(path, True)
    return len(old)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet at ``path`` and read again: cuts the lineage, survives lost executors."""
    df.write.mode("error").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(nullable(df.schema)).parquet(path)


def boxed(docs: DataFrame) -> DataFrame:
    """``text`` and one struct ``row`` of all other columns: added columns then clash with none of them."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.col("text").cast("string").alias("text"), F.struct(*others, F.lit(True).alias("_")).alias("row"))


def unboxed(docs: DataFrame, columns: list[str], *more: Column) -> DataFrame:
    """The columns as they were before ``boxed``, and more."""
    return docs.select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns), *more)


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def filesystem(path: str):
    """The Arrow file system of a path or URI and the path within it (usable in tasks)."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows (null: empty)."""
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterable[pa.RecordBatch], text: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``size`` bytes of text (always one row at least)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if not len(column):
            continue
        kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
        ends = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1]  # no copy
        at = 0
        while at < len(column):
            to = int(np.searchsorted(ends, ends[at] + size, "right")) - 1
            to = max(to, at + 1)
            yield batch.slice(at, to - at)
            at = to
    if not isinstance(batches, list):  # the end of a task
        tidy()


#: What a worker keeps from task to task (by name: the task that used it last, and the thing itself).
HELD: dict[str, tuple[int, object]] = {}


def held(name: str, make: Callable[[], object]) -> object:
    """A costly thing that later tasks of the same operator use again."""
    thing = HELD[name][1] if name in HELD else make()
    HELD[name] = (task_id(), thing)
    return thing


def task_id() -> int:
    context = TaskContext.get()
    return context.taskAttemptId() if context else 0


def tidy() -> None:
    """Gives memory that a task no longer needs back to the system: workers stay for later tasks.

    Things held for another operator's tasks go too.
    """
    for name in [name for name, (task, _) in HELD.items() if task != task_id()]:
        del HELD[name]
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def places(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``np.searchsorted(known, values)`` for many values: asked in order, so that memory is read in order."""
    order = np.argsort(values)
    out = np.empty(len(values), np.int64)
    out[order] = np.searchsorted(known, values[order])
    return out


def crc_of_id(column: str | Column) -> Column:
    """crc32 of the id as text (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string") if isinstance(column, str) else column.cast("string"),
                              F.lit("")).cast("binary"))


def slots(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
