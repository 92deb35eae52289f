"""Joins and runs on a time axis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlaps(start: Column, end: Column, lo, hi) -> Column:
    """Half-open overlap with one window."""
    return (start < F.lit(hi)) & (end > F.lit(lo))


def interval_join(left: DataFrame, right: DataFrame, key: str, *, start: str = "start_ms", end: str = "end_ms", bucket_ms: int | None = None) -> DataFrame:
    """Rows of ``left`` and ``right`` of one key whose closed intervals meet.

    Both sides are spread over the time buckets they touch and joined on key and bucket, so
    a key with very many rows is many small joins; a pair is taken in its first common
    bucket only.  Without ``bucket_ms`` the buckets are four mean intervals of the longer side,
    so that most intervals touch one or two.  Right columns other than the key get the prefix ``r_``.
    """
    if bucket_ms is None:
        mean = [df.agg(F.avg(F.col(end) - F.col(start))).first()[0] or 0 for df in (left, right)]
        bucket_ms = max(1, int(4 * max(mean)))
    spread = lambda df, a, b: df.withColumn("_b", F.explode(F.sequence(F.floor(F.col(a) / bucket_ms), F.floor(F.greatest(a, b) / bucket_ms))))
    r = right.select(key, *(F.col(c).alias(f"r_{c}") for c in right.columns if c != key))
    pairs = spread(left, start, end).join(spread(r, f"r_{start}", f"r_{end}"), [key, "_b"])
    first = F.floor(F.greatest(start, f"r_{start}") / bucket_ms)
    return pairs.where((F.col(f"r_{start}") <= F.col(end)) & (F.col(f"r_{end}") >= F.col(start)) & (F.col("_b") == first)).drop("_b")


def transcripts(shots: DataFrame, segments: DataFrame) -> DataFrame:
    """Per shot the texts of the speech segments it touches, by start; shots without speech are left out."""
    met = interval_join(shots.select("video_id", "shot_id", "start_ms", "end_ms"), segments.select("video_id", "seg_id", "start_ms", "end_ms", "text"), "video_id")
    parts = F.array_sort(F.collect_list(F.struct("r_start_ms", "r_seg_id", "r_text")))
    text = F.trim(F.array_join(F.transform(parts, lambda x: x["r_text"]), " "))
    return met.groupBy("video_id", "shot_id").agg(text.alias("text")).where(F.col("text") != "")


def asof_shot(frames: DataFrame, shots: DataFrame, *, key: str = "video_id", at: str = "frame_idx", start: str = "start_frame", end: str = "end_frame", value: str = "shot_id") -> DataFrame:
    """``frames`` with the ``value`` of the last shot that starts at or before them, empty if it has ended.

    One pass over the union of both sides in time order: linear, however many shots a video has.
    """
    mark = F.struct(F.col(end).cast("bigint").alias("end"), F.col(value).cast("string").alias("value"))
    right = shots.select(F.col(key).alias("_k"), F.col(start).cast("bigint").alias("_t"), F.lit(0).alias("_o"), mark.alias("_m"), F.lit(None).cast(frames.schema.simpleString()).alias("_f"))
    left = frames.select(F.col(key).alias("_k"), F.col(at).cast("bigint").alias("_t"), F.lit(1).alias("_o"), F.lit(None).cast("struct<end:bigint,value:string>").alias("_m"), F.struct(*frames.columns).alias("_f"))
    w = Window.partitionBy("_k").orderBy("_t", "_o").rowsBetween(Window.unboundedPreceding, 0)
    seen = right.unionByName(left).withColumn("_last", F.last("_m", ignorenulls=True).over(w)).where("_o = 1")
    return seen.select("_f.*", F.when(F.col("_t") <= F.col("_last.end"), F.col("_last.value")).otherwise(F.lit("")).alias(value))


def islands(rows: DataFrame, key: list[str], order: list[str], new: Column, name: str = "island") -> DataFrame:
    """A number for each run of rows; ``new`` marks the first row of a run."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn(name, F.sum(F.when(new, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def scenes(rows: DataFrame, key: str, order: str, score: str, threshold: float) -> DataFrame:
    """Runs of rows that are no transition: ``key, scene, start, end``; a row above the threshold ends one."""
    w = Window.partitionBy(key).orderBy(order)
    cut = F.coalesce(F.lag(F.col(score) > threshold).over(w), F.lit(True))
    return islands(rows.withColumn("_c", cut), [key], [order], F.col("_c"), "scene").groupBy(key, "scene").agg(F.min(order).alias("start"), F.max(order).alias("end"))


def gap_sessions(rows: DataFrame, key: str, start: str, end: str, gap: int, pad: int = 0) -> DataFrame:
    """Runs whose silent gaps are all shorter than ``gap``, widened by ``pad`` on both sides."""
    w = Window.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = before.isNull() | (F.col(start) - before >= gap)
    runs = islands(rows.withColumn("_n", new), [key], [start, end], F.col("_n"), "session")
    return runs.groupBy(key, "session").agg((F.min(start) - pad).alias("start"), (F.max(end) + pad).alias("end"), F.count("*").alias("n"))


def limit_length(sessions: DataFrame, key: str, most: int) -> DataFrame:
    """Sessions cut into pieces of ``most`` at most."""
    step = F.explode(F.sequence("start", F.greatest(F.col("end") - 1, F.col("start")), F.lit(most)))
    return sessions.withColumn("_s", step).select(key, "session", F.col("_s").alias("start"), F.least(F.col("_s") + most, F.col("end")).alias("end"))


def chunks(videos: DataFrame, key: str, total: str, size: int = 300) -> DataFrame:
    """Fixed runs of frames, the last one clipped."""
    start = F.explode(F.when(F.col(total) > 0, F.sequence(F.lit(0).cast("bigint"), F.col(total) - 1, F.lit(size).cast("bigint")))).alias("start_frame")
    return videos.select(key, total, start).select(key, "start_frame", F.least(F.col("start_frame") + (size - 1), F.col(total) - 1).alias("end_frame"))


def frame_range(rows: DataFrame, at: str, start: int, end: int, stride: int = 1) -> DataFrame:
    """Rows of a closed range of frames, each ``stride``-th."""
    return rows.where(F.col(at).between(start, end) & ((F.col(at) - start) % stride == 0))
