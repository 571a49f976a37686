"""Helpers shared by the operators: words, tables stored between jobs, connected components."""

from __future__ import annotations

import atexit
import ctypes
import gc
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import shared_folder

_FOLDERS: list[tuple[SparkSession, str]] = []


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder; it is removed when the application ends."""
    path = f"{shared_folder(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    if not _FOLDERS:
        atexit.register(_remove_all)
    _FOLDERS.append((spark, path))
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends here and survives lost executors."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that no later plan reads."""
    for spark, path in [x for x in _FOLDERS if any(f"{x[1]}/" in f for f in df.inputFiles()[:1])]:
        _delete(spark, path)
        _FOLDERS.remove((spark, path))


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _remove_all() -> None:
    for spark, path in _FOLDERS:
        try:
            _delete(spark, path)
        except Exception:  # the session has already ended
            return


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8, A-Z lower-cased; none for null."""
    return text.encode().lower().split() if text else []


Batches = Iterator[pa.RecordBatch]


def _libc() -> ctypes.CDLL | None:
    try:
        found = ctypes.CDLL(None)
        return found if hasattr(found, "malloc_trim") else None
    except (OSError, TypeError):  # another platform
        return None


def tidy(function: Callable[[Batches], Iterable[pa.RecordBatch]]) -> Callable[[Batches], Batches]:
    """``function`` over record batches that gives freed memory back when a partition is done: Spark keeps its Python workers for later stages."""
    def run(batches: Batches) -> Batches:
        try:
            yield from function(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if libc := _libc():
                libc.malloc_trim(0)

    return run


#: Rows of a batch handed to Python within ``small_batches``. Spark's 10,000 are tens of MB of texts, held by the executor and the worker of every task.
BATCH_ROWS = 1000
_batch_guard = threading.Lock()
_batch_scopes: list[str] = []


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While it holds, batches for Python have ``BATCH_ROWS`` rows at most; the last scope to end restores the setting."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    with _batch_guard:
        _batch_scopes.append(_batch_scopes[0] if _batch_scopes else spark.conf.get(setting))
        before = int(_batch_scopes[0])
        spark.conf.set(setting, str(min(before, BATCH_ROWS) if before > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        with _batch_guard:
            first = _batch_scopes.pop()
            if not _batch_scopes:
                spark.conf.set(setting, first)


def map_rows(df: DataFrame, function: Callable[[Iterator[dict[str, list]]], Iterable[dict[str, list]]], schema: str) -> DataFrame:
    """``mapInArrow`` over dicts of Python lists, one per record batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ({name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)} for batch in batches)
        for out in function(columns):
            yield pa.RecordBatch.from_arrays([pa.array(v) if not isinstance(v, pa.Array) else v for v in out.values()], list(out))

    return df.mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b: long, not null) as (node, root), root the smallest node.

    Alternates large-star and small-star rounds; each round is stored, and rounds end when the edge set stands still.
    A node with very many neighbours is pre-aggregated to its minimum and met again in a join that Spark can split.
    """
    def star(pairs: DataFrame, lowest: DataFrame) -> DataFrame:
        return pairs.join(lowest, "a")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    # a is the larger end
    now = stored(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before, after = None, mark(now)
    while before != after and after[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = star(both, lowest).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            star(large, least)
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                      F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").filter(F.col("a") != F.col("b")).distinct()
        )
        then = stored(small, "edges")
        before, after = after, mark(then)
        remove(now)
        now = then
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
