"""Shared plumbing of the training-data operators: tables, shared folders, bounded Arrow chunks."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import glob
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from ..session import stage_table

#: Text bytes that one Python step holds at a time; a single longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the input tables through Spark, so that any store Spark knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared folder and read it back."""
    return stage_table(df, tag)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_bytes`` in each slice."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks, and would keep the peak of the step
    they did last while the JVM and other workers need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without malloc_trim
        ctypes.CDLL(None).malloc_trim(0)


def settle(spark: SparkSession) -> None:
    """Collect garbage on the driver, Python's and the JVM's, and return freed memory to the system: Spark's cleaner only
    drops the shuffle files and broadcasts of plans that are gone when the JVM collects, which an idle driver seldom does,
    and the C library keeps what the JVM's compiler, buffers and threads have freed."""
    give_back()
    jvm, new = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    jvm.System.gc()

    def array(kind: str, *items: object) -> object:
        made = new(getattr(jvm.java.lang, kind), len(items))
        for k, item in enumerate(items):
            made[k] = item
        return made

    with contextlib.suppress(Py4JError):  # a JVM without this command
        kind = jvm.java.lang.Class.forName
        kinds = [kind(n) for n in ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")]
        call = kind("javax.management.MBeanServer").getMethod("invoke", array("Class", *kinds))  # the server's own class is hidden
        commands = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        call.invoke(server, array("Object", commands, "systemTrimNativeHeap", array("Object"), array("String")))


def one_thread() -> None:
    """Keep numpy's matrix products of a task in its own thread: a task has one core, and waiting threads would take
    those of others."""
    for path in glob.glob(os.path.join(os.path.dirname(np.__file__), "..", "numpy.libs", "*openblas*")):
        with contextlib.suppress(OSError, AttributeError):  # another build of the library
            ctypes.CDLL(path).scipy_openblas_set_num_threads64_(1)


def large_text(column: pa.Array) -> pa.Array:
    """The column as large_string without nulls (null counts as empty)."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def words_of(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Split texts at white space after lower-casing.

    Returns (codes, vocabulary, ends): the word codes of all texts in a row, the distinct words they
    stand for, and where each text ends among the codes.
    """
    lists = pc.utf8_split_whitespace(pc.utf8_lower(large_text(column)))
    flat = lists.flatten()
    ends = lists.offsets.to_numpy()[1:].astype(np.int64) - int(lists.offsets[0].as_py())
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, ends


_POWER = np.cumprod(np.concatenate([[1], np.full(4095, 0x9E3779B97F4A7C15, np.uint64)]).astype(np.uint64))


def hash_words(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, computed over all bytes at once (polynomial, then mixed)."""
    words = pa.concat_arrays([words.cast(pa.large_binary())])
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    body = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at[0] : at[-1]] if len(words) else np.zeros(0, np.uint8)
    size = np.diff(at)
    out = np.zeros(len(words), np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        place = np.arange(len(body)) - np.repeat(at[:-1] - at[0], size)
        terms = (body.astype(np.uint64) + np.uint64(1)) * _POWER[place & 4095]
        out[some] = np.add.reduceat(terms, (at[:-1] - at[0])[some])
    out ^= size.astype(np.uint64)
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F)):
        out = (out ^ (out >> np.uint64(shift))) * np.uint64(factor)
    return out ^ (out >> np.uint64(32))


def drop_codes(codes: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Drop the words whose code isn't in ``keep`` (a mask by code) and move the ends along."""
    good = keep[codes] if len(codes) else np.zeros(0, bool)
    total = np.concatenate([[0], np.cumsum(good)])
    return codes[good], total[ends]
