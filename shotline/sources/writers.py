"""Sinks and merges into tables of Parquet files."""

from __future__ import annotations

import atexit
import functools
import os
import tempfile
import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import InputError, TargetExistsError
from ..operators import relational as R
from .readers import exists


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


_scratch: dict[str, SparkSession] = {}


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that the cluster shares for such tables (``spark.checkpoint.dir``, or the warehouse; a temporary
    one in local mode); what is there at the program's end is deleted."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        local = spark.sparkContext.master.startswith("local")
        named = f"{tempfile.gettempdir()}/shotline-tables" if local else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tables"
    if not _scratch:
        atexit.register(_sweep)
    path = f"{named.rstrip('/')}/t-{uuid.uuid4().hex}"
    _scratch[path] = spark
    return path


def _sweep() -> None:
    for path, spark in _scratch.items():
        if spark.sparkContext._jsc is not None:
            delete(spark, path)


def preflight(spark: SparkSession, targets: Sequence[str], overwrite: bool) -> None:
    """All targets are free, or may be replaced; checked before any work is done."""
    taken = [] if overwrite else [t for t in targets if exists(spark, t)]
    if taken:
        raise TargetExistsError(f"there already: {taken}")


def _rename(fs, a, b) -> None:
    if not fs.rename(a, b):
        raise OSError(f"{a} could not be renamed to {b}")


def recover(spark: SparkSession, path: str) -> None:
    """Finish what a cut-off ``replace`` left: a table that stands aside while its target is missing comes back."""
    target, fs = _fs(spark, path)
    if fs.exists(target):
        return
    aside = sorted(str(s.getPath()) for s in fs.globStatus(_fs(spark, f"{path.rstrip('/')}.old-*")[0]) or [])
    if aside:
        _rename(fs, _fs(spark, aside[-1])[0], target)


def replace(df: DataFrame, path: str, how: Callable | None = None) -> None:
    """Write beside the target, then put it in the target's place.

    The old table is renamed aside, not deleted, until the new one stands: a failure at any
    step leaves the old table, at its place or where ``recover`` finds it.  A table may be
    rewritten from itself.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    mark = uuid.uuid4().hex
    staged, aside = f"{base}.staged-{mark}", f"{base}.old-{mark}"
    (how or (lambda w, to: w.parquet(to)))(df.write, staged)
    (target, fs), old, new = _fs(spark, path), _fs(spark, aside)[0], _fs(spark, staged)[0]
    if not fs.exists(target):
        _rename(fs, new, target)
        return
    _rename(fs, target, old)
    try:
        _rename(fs, new, target)
    except BaseException:
        _rename(fs, old, target)
        raise
    fs.delete(old, True)


def append_then_mark(df: DataFrame, path: str, marks: str, key: str) -> None:
    """Rows first, then their keys' markers: a key counts as done only once all its rows are there."""
    df.write.mode("append").json(path)
    df.select(F.col(key).cast("string").alias("value")).distinct().write.mode("append").text(marks)


def drop_keys(spark: SparkSession, path: str, marks: str, schema: str, key: str, keys: Sequence[str]) -> None:
    """Take the keys' markers, then their rows, out of a log."""
    gone = ~F.col(key).isin(list(keys))
    replace(spark.read.text(marks).where(~F.col("value").isin(list(keys))), marks, lambda w, to: w.text(to))
    replace(spark.read.schema(schema).json(path).where(gone), path, lambda w, to: w.json(to))


def jsonl(df: DataFrame, path: str, overwrite: bool = False) -> None:
    df.write.mode("overwrite" if overwrite else "errorifexists").json(path)


def split_failures(df: DataFrame, good: str, bad: str, error: str = "error") -> int:
    """Rows without an error to one sink, those with one to another, which is taken away if there are none; gives their number."""
    spark = df.sparkSession
    df.where(F.col(error).isNull()).drop(error).write.mode("overwrite").json(good)
    failed = df.where(F.col(error).isNotNull())
    n = failed.count()
    if n:
        failed.write.mode("overwrite").json(bad)
    elif exists(spark, bad):
        delete(spark, bad)
    return n


def vectors(df: DataFrame, path: str) -> None:
    """Vectors as Parquet, a folder for each model and video; those that come anew replace their folder only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "video_id").parquet(path)


def csv(df: DataFrame, path: str, fallback: str | None = None) -> str:
    """Append with a header in each file; tasks write files of their own, so there is no lock.  Where the target cannot be
    written and there is a ``fallback``, that is written; gives the path used."""
    try:
        df.write.mode("append").option("header", True).csv(path)
        return path
    except Exception:
        if fallback is None:
            raise
    df.write.mode("append").option("header", True).csv(fallback)
    return fallback


def per_key(df: DataFrame, path: str, key: str = "video_id", rows: int = 1_000_000) -> None:
    """A folder for each key; a key of many rows is dealt to several tasks, of about ``rows`` each."""
    size = df.groupBy(F.col(key).alias("_key")).agg(F.ceil(F.count("*") / rows).alias("_parts"))
    salted = df.join(size, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    salted = salted.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.col("_parts")))
    salted.repartition(key, "_salt").drop("_salt", "_parts").write.mode("overwrite").partitionBy(key).json(path)


def report(df: DataFrame, path: str, title: str, n: int = 20) -> None:
    """The first ``n`` rows as text."""
    rows = df.limit(n).collect()
    lines = [title, "\t".join(df.columns), *("\t".join(map(str, r)) for r in rows)]
    spark = df.sparkSession
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def images(df: DataFrame, path: str, name: str = "name", content: str = "content", group: str = "video_id") -> int:
    """Write encoded pictures to ``path/group/name``, each by the task that holds it, and give the number of their bytes."""
    spark = df.sparkSession
    root = str(_fs(spark, path)[0].toUri().getPath()) if path.startswith(("/", "file:")) else None
    if root is None:
        raise InputError("pictures are written to a folder that all workers share")

    def run(batches):
        for batch in batches:
            sizes = []
            for g, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                os.makedirs(f"{root}/{g}", exist_ok=True)
                part = f"{root}/{g}/.{n}.{uuid.uuid4().hex}"
                with open(part, "wb") as f:
                    f.write(raw)
                os.replace(part, f"{root}/{g}/{n}")  # a task that runs again leaves no half of a picture
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n"])

    done = df.where(F.col(content).isNotNull()).select(F.col(group).cast("string"), F.col(name).cast("string"), content)
    return done.mapInArrow(run, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def bytes_stored(df: DataFrame, content: str = "content") -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(content)), F.lit(0))).first()[0]


class Store:
    """Named tables below one folder, with the merges of the ingest.

    Tables of BY have BUCKETS folders by a hash of that column; a merge reads and rewrites
    only the folders of the rows it brings, so a batch of videos costs what those folders
    hold.  A key must belong to one value of that column, as keys made from it do.
    """

    BY, BUCKETS = "video_id", 256
    _BUCKET = "_bucket"

    def __init__(self, spark: SparkSession, root: str, bucketed: Sequence[str] = ("frames", "shots", "transcript_segments", "frame_text", "vectors")):
        self.spark, self.root, self.bucketed = spark, root.rstrip("/"), frozenset(bucketed)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def has(self, name: str) -> bool:
        recover(self.spark, self.path(name))
        return exists(self.spark, self.path(name))

    def create(self, name: str, schema: str) -> None:
        if not self.has(name):
            # The rows of a table with folders are in these only: an empty one is a plain table until it has some.
            self.spark.createDataFrame([], schema).write.parquet(self.path(name))

    def drop(self, name: str) -> None:
        delete(self.spark, self.path(name))

    def _whole(self, name: str) -> DataFrame:
        recover(self.spark, self.path(name))
        return self.spark.read.parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        return self._whole(name).drop(self._BUCKET)

    def _spread(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self._BUCKET, F.pmod(F.xxhash64(F.col(self.BY).cast("string")), F.lit(self.BUCKETS)).cast("int"))

    def put(self, name: str, df: DataFrame) -> None:
        """The whole table anew."""
        if name in self.bucketed:
            replace(self._spread(df), self.path(name), lambda w, to: w.partitionBy(self._BUCKET).parquet(to))
        else:
            replace(df, self.path(name))

    def _merge(self, name: str, rows: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], first: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """Put ``merge(old, rows)``, or ``first(rows)`` where there is no table, in place of the table or of the folders it touches."""
        if not self.has(name):
            self.put(name, first(rows))
            return
        whole = self._whole(name)
        if self._BUCKET not in whole.columns or self.BY not in rows.columns:
            self.put(name, merge(self.read(name), rows))
            return
        touched = [r[0] for r in self._spread(rows).select(self._BUCKET).distinct().collect()]  # BUCKETS at most
        if not touched:
            return
        old = whole.where(F.col(self._BUCKET).isin(touched)).drop(self._BUCKET)
        merged = self._spread(merge(old, rows)).repartition(F.col(self._BUCKET))
        # Spark writes all new folders before it takes the old ones' places, and touches no other.
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self._BUCKET).parquet(self.path(name))

    def upsert(self, name: str, rows: DataFrame, key: str) -> None:
        self._merge(name, rows, lambda old, new: R.upsert(old, new, key), lambda new: R.one_per_key(new, key))

    def insert_if_absent(self, name: str, rows: DataFrame, key: str) -> None:
        self._merge(name, rows, lambda old, new: R.insert_if_absent(old, new, key), lambda new: R.one_per_key(new, key, first=True))

    def enrich(self, name: str, rows: DataFrame, key: str, columns: Sequence[str]) -> None:
        self._merge(name, rows, lambda old, new: R.enrich(old, new, key, columns))

    def refresh(self, name: str, rows: DataFrame, partition: str) -> None:
        self._merge(name, rows, lambda old, new: R.refresh(old, new, partition))

    def purge(self, value: str, names: Sequence[str], column: str = "video_id") -> None:
        """Delete a key's rows from every table."""
        for name in names:
            if not self.has(name):
                continue
            keep = ~F.col(column).eqNullSafe(F.lit(value))
            whole = self._whole(name)
            if self._BUCKET not in whole.columns or column != self.BY:
                self.put(name, self.read(name).where(keep))
                continue
            bucket = self._spread(self.spark.range(1).select(F.lit(value).alias(self.BY))).first()[self._BUCKET]
            rest = whole.where((F.col(self._BUCKET) == bucket) & keep)
            if not rest.isEmpty():
                rest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self._BUCKET).parquet(self.path(name))
            elif whole.where(F.col(self._BUCKET) != bucket).isEmpty():
                replace(whole.where(F.lit(False)).drop(self._BUCKET), self.path(name))
            else:
                delete(self.spark, f"{self.path(name)}/{self._BUCKET}={bucket}")

    def mark_step(self, video_id: str, step: str, status: str, count: int | None = None) -> None:
        """Set one step of a video's status; its other steps stay."""
        entry = F.create_map(F.lit(step), F.struct(F.lit(status).alias("status"), F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"), F.lit(count).cast("bigint").alias("count")))
        new = self.spark.range(1).select(F.lit(video_id).alias("video_id"), entry.alias("steps"))
        if self.has("ingest_status"):
            old = self.read("ingest_status").where(F.col("video_id") == video_id).select(F.col("steps").alias("old"))
            joined = new.join(old, F.lit(True), "left")  # one row on either side
            kept = F.map_filter(F.coalesce("old", F.create_map().cast("map<string,struct<status:string,updated_at:string,count:bigint>>")), lambda k, _: k != step)
            new = joined.select("video_id", F.map_concat(kept, "steps").alias("steps"))
        self.upsert("ingest_status", new, "video_id")

    def set_synced(self, ids: dict[str, DataFrame], key: str = "keyframe_id") -> None:
        """Note which stores have which frames: one merge for all of ``ids(store -> key)``."""
        all_ids = functools.reduce(DataFrame.union, (df.select(key, F.lit(store).alias("_store")) for store, df in ids.items()))
        stores = all_ids.groupBy(key).agg(F.collect_set("_store").alias("_stores"))

        def noted(frames: DataFrame, rows: DataFrame) -> DataFrame:
            hit = frames.join(rows.select(key, "_stores"), key, "left")
            flag = lambda name: F.coalesce(F.array_contains("_stores", name), F.lit(False)) | F.col("synced")[name]
            synced = functools.reduce(lambda c, name: c.withField(name, flag(name)), ids, F.col("synced"))
            return hit.withColumn("synced", synced).select(*frames.columns)

        self._merge("frames", stores.join(self.read("frames").select(key, self.BY), key), noted)
