"""Shared plumbing of the training-data operators: shared-folder tables, batches, words."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import gc
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import shared_dir

#: Text bytes that one vectorised step holds at most (a single longer text is a step of its own).
STEP_BYTES = 4 << 20

_caches: list = []


def registered(cache):
    """``cache`` (a dict with an old generation), which other operators' tasks may empty."""
    _caches.append(cache)
    return cache


def trim() -> None:
    """Give freed memory back to the system; called as a task begins, whose process may have served other operators."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def lean() -> None:
    """Give back also what other operators have cached in this process; called as a task begins that uses no such cache."""
    if any(c or c.old for c in _caches):
        for c in _caches:
            c.clear()
            c.old = {}
        gc.collect()
    trim()


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


_made: contextvars.ContextVar = contextvars.ContextVar("made", default=None)


@contextlib.contextmanager
def tables(spark: SparkSession):
    """Within it, what ``written`` makes is deleted at the end, but for the tables that are passed to the function it gives."""
    made: dict[str, DataFrame] = {}
    token = _made.set(made)
    try:
        yield lambda *kept: [made.pop(path) for path, df in list(made.items()) if any(df is k for k in kept)]
    finally:
        _made.reset(token)
        for path in made:
            dropped(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage ends here."""
    out, path = written_to(df, label)
    if (made := _made.get()) is not None:
        made[path] = out
    return out


def written_to(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Like ``written``, for a table that the caller deletes: also returns the path, for ``dropped``."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def file_system(path: str):
    """(pyarrow file system, path inside it) of a shared path; ``file:``, ``hdfs:``, ``s3:`` and bare paths."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


#: Rows of one key that a task may hold without being split.
HOT_ROWS = 100_000


def salted_join(rows: DataFrame, table: DataFrame, key: str, other: str, total: int, weights: DataFrame, least: int | None = None, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table`` (a row or few a key) on ``key``, where one key may hold any share of the ``total`` rows.

    ``weights``: ``key`` and ``weight``, its number of rows. Keys of more than ``max(HOT_ROWS, total / 1000)`` rows are fewer
    than 1,000, whatever the input; they alone are broadcast, with their number of parts. Their rows are dealt
    to the parts by ``other`` and their rows of ``table`` are repeated once for each part.
    """
    least = HOT_ROWS if least is None else least
    if total <= least:
        return rows.join(table, key, how)
    hot = F.broadcast(weights.where(F.col("weight") > max(least, total // 1000)).select(key, F.ceil(F.col("weight") / least).cast("int").alias("__parts")))
    dealt = rows.join(hot, key, "left").withColumn("__part", F.pmod(F.xxhash64(other), F.coalesce("__parts", F.lit(1))).cast("int")).drop("__parts")
    copies = table.join(hot, key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    return dealt.join(copies, [key, "__part"], how).drop("__part")


def text_steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` holds about ``limit`` bytes."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def batch_words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (null: none).

    Returns the words' codes in one array, the bounds of each text in it
    (one more than there are texts), and the array of distinct words by code.
    """
    parts = pc.ascii_split_whitespace(pc.fill_null(text.cast(pa.string()), ""))
    flat, bounds = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    full = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)))
    coded = pc.dictionary_encode(flat.filter(full))
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, kept[bounds], coded.dictionary


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` within each run of ``bounds``; empty runs give 0."""
    total = np.concatenate((np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values, dtype=None if values.dtype.kind == "f" else np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (the SplitMix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def row_of(bounds: np.ndarray) -> np.ndarray:
    """The run that each position belongs to."""
    return np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(bounds))
