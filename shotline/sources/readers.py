"""Scans of the artifact files.  Schemas are given, never inferred; a missing optional input is an empty relation."""

from __future__ import annotations

import os
import re
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields
from io import BytesIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import InputError, QualityError
from ..functions import text as X

IMAGES = ("jpg", "jpeg", "png", "bmp", "webp")
VIDEO_NAME = r"(?i)^[A-Z]+\d+_V\d+$"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at a path of any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def jsonl(spark: SparkSession, path: str, schema: str, optional: bool = False) -> DataFrame:
    """One record a line; a broken one fails the scan."""
    if optional and not exists(spark, path):
        return empty(spark, schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def last_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_x")).select(key, "_x.*")


def done_keys(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Distinct keys of a log whose lines may be blank."""
    if not exists(spark, path):
        return empty(spark, f"{key} string")
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", f"{key} string")[key].alias(key)).where(f"{key} is not null").distinct()


def markers(spark: SparkSession, path: str, key: str = "key") -> DataFrame:
    """Keys of marker files, one a line."""
    if not exists(spark, path):
        return empty(spark, f"{key} string")
    return spark.read.text(path).select(F.trim("value").alias(key)).where(F.col(key) != "").distinct()


def strict_jsonl(spark: SparkSession, path: str, schema: str, keys: set[str]) -> DataFrame:
    """Records with exactly these keys and types.  The file is checked at once; the first bad line of all is named with its number."""
    lines = spark.read.text(path).select("value", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    given = F.array_sort(F.json_object_keys("value"))
    parsed = lines.withColumns({"r": F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}), "keys": given})
    names = [f.name for f in spark.createDataFrame([], schema).schema.fields]
    filled = F.greatest(*(F.col("r")[n].isNull().cast("int") for n in names), F.lit(0)) == 0
    ok = F.coalesce((F.trim("value") != "") & (F.col("keys") == F.array(*map(F.lit, sorted(keys)))) & filled, F.lit(False))
    bad = parsed.where(~ok).orderBy("file", "block", "at").select("file", "block", "at", "value").first()
    if bad is not None:
        # Lines of earlier blocks of the file, and earlier ones of this block, which one task has read in order.
        before = lines.where((F.col("file") == bad["file"]) & ((F.col("block") < bad["block"]) | (F.col("block") == bad["block"]) & (F.col("at") < bad["at"]))).count()
        raise QualityError(f"bad record in {bad['file']}, line {before + 1}: {bad['value']}")
    return parsed.where(ok).select("r.*")


def json_array(spark: SparkSession, path: str, schema: str, tolerant: bool = False) -> DataFrame:
    """Records of a JSON array; a tolerant scan takes a missing or broken file as empty."""
    if tolerant and not exists(spark, path):
        return empty(spark, schema)
    whole = spark.read.text(path, wholetext=True).select(F.trim("value").alias("value"))
    root = F.from_json("value", f"array<struct<{_fields(spark, schema)}>>", {"mode": "PERMISSIVE" if tolerant else "FAILFAST"})
    if not tolerant:
        whole = whole.where(F.when(F.col("value").startswith("["), True).otherwise(F.raise_error(F.lit("the root is not an array")).cast("boolean")))
    return whole.select(F.explode(root).alias("r")).select("r.*")


def _fields(spark: SparkSession, schema: str) -> str:
    return ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in spark.createDataFrame([], schema).schema.fields)


def json_any(spark: SparkSession, candidates: Sequence[str], schema: str) -> DataFrame:
    """The first of several paths that exists, JSON lines or one array."""
    for path in candidates:
        if exists(spark, path):
            head = spark.read.text(path).where(F.trim("value") != "").select(F.substring(F.ltrim("value"), 1, 1).alias("c")).limit(1).collect()
            return json_array(spark, path, schema) if head and head[0]["c"] == "[" else jsonl(spark, path, schema)
    raise InputError(f"none of {list(candidates)} exists")


def shots(spark: SparkSession, candidates: Sequence[str]) -> DataFrame:
    """Raw shots; whole-number ids become S0001 and a missing frame rate 25."""
    raw = json_any(spark, candidates, "video_id string, shot_id string, start_frame bigint, end_frame bigint, fps double")
    from ..functions.media import normalised_shot_id

    return raw.withColumns({"shot_id": normalised_shot_id(F.col("shot_id")), "fps": F.coalesce("fps", F.lit(25.0))})


def csv(spark: SparkSession, path: str, schema: str, from_name: str | None = None) -> DataFrame:
    """A table with a header; ``from_name`` adds the file's stem as a column."""
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    return df.withColumn(from_name, X.stem(F.col("_metadata.file_path"))) if from_name else df


def matrices(spark: SparkSession, path: str, dim: int | None = None) -> DataFrame:
    """``name, pos, id, embedding`` of NPY matrices ``X.npy`` and their lists of ids ``X_ids.json``, paired by place.

    Files are read by the executors; a row count that differs from the number of ids is an
    error, as is a file without its partner.
    """
    stem = X.stem(F.col("path"))
    npy = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(path).select(stem.alias("name"), "content")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.load(BytesIO(raw), allow_pickle=False)
                if x.ndim != 2 or (dim and x.shape[1] != dim):
                    raise QualityError(f"{name}: shape {x.shape}")
                for i in range(0, max(len(x), 1), 4096):
                    part = np.ascontiguousarray(x[i : i + 4096], np.float32)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * x.shape[1]), pa.array(part.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part), pa.string()), pa.array(np.arange(i, i + len(part))), lists, pa.array([len(x)] * len(part), pa.int64())], ["name", "pos", "embedding", "n"])

    vectors = npy.mapInArrow(rows, "name string, pos bigint, embedding array<float>, n bigint")
    ids = spark.read.format("binaryFile").option("pathGlobFilter", "*_ids.json").load(path)
    ids = ids.select(F.regexp_replace(stem, "_ids$", "").alias("name"), F.from_json(F.col("content").cast("string"), "array<string>", {"mode": "FAILFAST"}).alias("ids"))
    alone = npy.select("name").join(ids.select("name"), "name", "left_anti").union(ids.select("name").join(npy.select("name"), "name", "left_anti")).limit(5).collect()
    if alone:
        raise QualityError(f"files without a partner: {sorted(r[0] for r in alone)}")
    both = vectors.join(ids, "name").where(F.when(F.col("n") == F.size("ids"), True).otherwise(F.raise_error(F.concat("name", F.lit(": ids and vectors differ in number"))).cast("boolean")))
    return both.select("name", "pos", F.get("ids", F.col("pos").cast("int")).alias("id"), "embedding")


def images(spark: SparkSession, path: str) -> DataFrame:
    """``frame_id, path`` of all images below a folder, in path order; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    found = found.where(F.lower("path").rlike(rf"\.({'|'.join(IMAGES)})$"))
    return found.select(X.frame_id(F.col("path")).alias("frame_id"), "path").orderBy("path")


def images_or_zip(spark: SparkSession, path: str, unpack_to: str) -> DataFrame:
    """``images``; a ZIP is unpacked first.  No image at all is an error."""
    if path.lower().endswith(".zip"):
        with zipfile.ZipFile(path) as z:
            for n in z.namelist():
                if os.path.isabs(n) or ".." in n.split("/"):
                    raise InputError(f"unsafe name {n}")
            z.extractall(unpack_to)
        path = unpack_to
    found = images(spark, path)
    if found.isEmpty():
        raise InputError(f"no images in {path}")
    return found


def datasets(spark: SparkSession, root: str) -> DataFrame:
    """``video_id, frames`` of the video folders below ``root`` or ``root/keyframes``, in natural order."""
    base = f"{root.rstrip('/')}/keyframes" if exists(spark, f"{root.rstrip('/')}/keyframes") else root
    parent = F.element_at(F.split("path", "/"), -2)
    found = images(spark, base).select(parent.alias("video_id")).where(F.col("video_id").rlike(VIDEO_NAME))
    return found.groupBy("video_id").agg(F.count("*").alias("frames")).orderBy(X.natural_key(F.col("video_id")), "video_id")


def videos(spark: SparkSession, path: str, suffixes: Sequence[str] = ("mp4", "mkv", "avi", "mov", "webm"), names: Sequence[str] | None = None) -> DataFrame:
    """``video_id, path`` of video files, perhaps only those named."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").where(F.lower("path").rlike(rf"\.({'|'.join(map(re.escape, suffixes))})$"))
    found = found.select(X.stem(F.col("path")).alias("video_id"), "path")
    return (found.where(F.col("video_id").isin(list(names))) if names else found).orderBy("path")


def ordinals(listing: DataFrame, key: str = "path") -> DataFrame:
    """Frames of a folder numbered from 0 in name order."""
    from pyspark.sql import Window

    return listing.withColumn("frame_idx", F.row_number().over(Window.partitionBy(F.regexp_replace(key, "/[^/]*$", "")).orderBy(key)) - 1)


@dataclass
class Config:
    """Settings: defaults, then a mapping, then the environment; a given 0 or empty text counts as given."""

    root: str = "/data"
    top_k: int = 100
    min_confidence: float = 0.3
    similarity: float = 0.9
    ratio: float = 0.02
    chunk: int = 300
    batch: str = "batch2"

    @classmethod
    def load(cls, given: dict | None = None, env: dict | None = None, prefix: str = "SHOTLINE_") -> Config:
        known = {f.name: f for f in fields(cls)}
        if unknown := set(given or {}) - set(known):
            raise InputError(f"unknown settings {sorted(unknown)}")
        values = {k: v for k, v in (given or {}).items() if v is not None}
        for name, f in known.items():
            if (raw := (os.environ if env is None else env).get(prefix + name.upper())) is not None:
                values[name] = type(f.default)(raw)
        return cls(**values)

    @staticmethod
    def dotenv(text: str) -> dict[str, str]:
        """``KEY=value`` lines; comments and blank lines are passed over, quotes go."""
        pairs = (line.split("=", 1) for line in text.splitlines() if "=" in line and not line.lstrip().startswith("#"))
        return {k.strip().removeprefix("export "): v.strip().strip("\"'") for k, v in pairs}
