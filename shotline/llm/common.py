"""Shared pieces of the corpus operators: scratch tables, word shingles, stable hashes."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids sent to every executor at most; beyond it the same join runs as a shuffle.
BROADCAST_ROWS = 1_000_000
#: What a worker is handed at once: rows of long texts come a few at a time.
BATCH_BYTES, _BATCH_BYTES = "8m", "spark.sql.execution.arrow.maxBytesPerBatch"
_left: dict[str, SparkSession] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder shared by the cluster for intermediate tables.

    ``spark.checkpoint.dir`` where the session names one.  Where it is unset, a
    temporary folder in local mode and the warehouse otherwise.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        named = f"{tempfile.gettempdir()}/shotline-scratch"
    else:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return named


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/t-{uuid.uuid4().hex}"
    if not _left:
        atexit.register(_sweep)
    _left[path] = spark
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch_path = path
    return back


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables that no later plan reads."""
    for t in tables:
        path = getattr(t, "_scratch_path", None)
        if path:
            _delete(t.sparkSession, path)
            _left.pop(path, None)


def _sweep() -> None:
    """At the end of the program, delete the scratch tables that results were read from."""
    for path, spark in _left.items():
        if spark.sparkContext._jsc is not None:
            _delete(spark, path)


def rows_with_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is in ``ids``; the ids are broadcast only while their count is under ``limit``."""
    ids = ids.select(key).distinct()
    if ids.count() <= limit:
        ids = F.broadcast(ids)
    return docs.join(ids, key, "left_semi")


#: A key is hot from this share of all rows; so there are no more hot keys than its inverse.
HOT = 1 / 10_000


def join_hot(rows: DataFrame, table: DataFrame, keys: list[str], total: int, n: str = "n") -> DataFrame:
    """``rows.join(table, keys)`` without ``n``, the number of a key's rows among ``total``.

    What ``table`` has of hot keys, 1 / HOT rows at most if its keys are unique, goes to every
    task; only the rows of other keys are shuffled, so no task gets more than HOT of all for a key.
    """
    limit = F.lit(max(HOT * total, 1.0))
    hot = F.broadcast(table.where(F.col(n) > limit).drop(n))
    often = rows.join(hot, keys)
    seldom = rows.join(hot.select(*keys), keys, "left_anti").join(table.where(F.col(n) <= limit).drop(n), keys)
    return often.unionByName(seldom)


def _trim() -> None:
    """Give this process's freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def give_back(spark: SparkSession) -> str | None:
    """Collect what the driver's Python and Java have dropped, and give freed memory back to the system.

    A driver that plans many queries keeps two things: the broadcasts and shuffles of dropped plans, until Java
    happens to collect them, and what its hundreds of short-lived threads have freed, which the C library holds
    for each of them.  Returns what Java says of the second, or None if it has no command for it.
    """
    gc.collect()  # the plans' handles
    _trim()
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    jvm.System.gc()
    try:
        find, names = jvm.java.lang.Class.forName, ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")
        types, args = gateway.new_array(jvm.java.lang.Class, 4), gateway.new_array(jvm.java.lang.Object, 4)
        for i, name in enumerate(names):
            types[i] = find(name)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke = find("javax.management.MBeanServer").getMethod("invoke", types)
        return invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:  # other Java, or another C library
        return None


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow``, after which the worker, which waits for further tasks, gives back what the task has freed."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _trim()

    conf = df.sparkSession.conf
    if conf.get(_BATCH_BYTES, None) == "67108864b":  # unless the session says otherwise
        conf.set(_BATCH_BYTES, BATCH_BYTES)
    return df.mapInArrow(tidy, schema)


class WordHashes(dict):
    """64-bit hash of each word (bytes), remembered between documents."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: runs of anything but space and 0x09-0x0D, with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_hashes(words: list[bytes], cache: WordHashes, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words than ``size`` make one shingle."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=n)
    width = min(size, n)
    out = h[: n - width + 1] * _MUL[0]
    for j in range(1, width):
        out += mix(h[j : n - width + 1 + j] + np.uint64(j)) * _MUL[j]
    return np.unique(mix(out + np.uint64(width)))
