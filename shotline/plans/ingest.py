"""Batch ingest: artifacts to served tables, index documents and vectors."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import media as M
from ..operators import relational as R
from ..operators import timeline as T
from ..sources.writers import Store
from .index import TextIndex, VectorIndex
from .search import TEXTS, TextSearch


def served_shots(shots: DataFrame, transcripts: DataFrame) -> DataFrame:
    t = transcripts.select("shot_id", F.col("text").alias("_t"))
    rows = shots.join(t, "shot_id", "left")
    return rows.select("video_id", "shot_id", "start_frame", "end_frame", "fps", M.served_ms(F.col("start_frame"), F.col("fps")).alias("start_ms"), M.served_ms(F.col("end_frame") + 1, F.col("fps")).alias("end_ms"), F.coalesce("_t", F.lit("")).alias("transcript"))


def served_frames(keyframes: DataFrame, batch: str = "batch2") -> DataFrame:
    """Base rows of frames: nothing enriched, nothing synced."""
    flags = lambda *names: F.struct(*(F.lit(False).alias(n) for n in names))
    return keyframes.select(
        "keyframe_id", "video_id", "shot_id", "frame_idx", "timestamp_ms", "image_path", F.lit(batch).alias("batch"), F.create_map().cast("map<string,double>").alias("objects"),
        *(F.lit("").alias(c) for c in ("ocr_text", "ocr_api", "caption")), flags("beit3", "siglip", "siglip2", "clip32").alias("embeddings"), flags("elastic", "milvus").alias("synced"),
    )


def served_segments(segments: DataFrame) -> DataFrame:
    return segments.select("seg_id", "video_id", "start_ms", "end_ms", "text").where(F.trim("text") != "")


def enrichments(keyframes: DataFrame, detections: DataFrame, ocr: DataFrame, ocr_api: DataFrame, recap: DataFrame, least: float = 0.3, keep_empty: bool = True) -> DataFrame:
    """Per keyframe what the models found; null where an artifact has no row."""
    objects = M.label_confidence(F.col("objects"), least)
    if not keep_empty:
        objects = F.when(F.size(objects) > 0, objects)
    out = keyframes.select("keyframe_id")
    for df, key, value, name in (
        (detections, "frame_id", objects, "objects"), (ocr, "frame_id", M.joined_text(F.col("texts"), least), "ocr_text"),
        (ocr_api, "frame_id", M.joined_text(F.col("texts"), 0.0), "ocr_api"), (recap, "keyframe_id", F.col("caption"), "caption"),
    ):
        out = out.join(df.select(F.col(key).alias("keyframe_id"), value.alias(name)).dropDuplicates(["keyframe_id"]), "keyframe_id", "left")
    return out


def index_docs(frames: DataFrame, shots: DataFrame) -> DataFrame:
    """Search documents: labels as tags, the shot's transcript copied in."""
    t = shots.select("shot_id", F.col("transcript").alias("_t"))
    rows = frames.join(t, "shot_id", "left")
    return rows.select(
        F.col("keyframe_id").alias("frame_id"), "video_id", "shot_id", "frame_idx", "timestamp_ms", *(F.coalesce(c, F.lit("")).alias(c) for c in ("ocr_text", "ocr_api", "caption")),
        F.coalesce("_t", F.lit("")).alias("transcript"), F.array_sort(F.map_keys(F.coalesce("objects", F.create_map().cast("map<string,double>")))).alias("object_tags"),
    )


def vector_rows(vectors: DataFrame, frames: DataFrame, model: str) -> DataFrame:
    """Vectors with their frame's scalars; a vector of an unknown frame is an error."""
    f = frames.select(F.col("keyframe_id").alias("frame_id"), "video_id", "frame_idx", "shot_id", "timestamp_ms")
    both = R.must_match(vectors.select(F.col("id").alias("frame_id"), "embedding"), f, "frame_id")
    return both.select(F.lit(model).alias("model"), "frame_id", "video_id", "frame_idx", "shot_id", "timestamp_ms", "embedding")


def map_frames(map_rows: DataFrame, shots: DataFrame) -> DataFrame:
    """Frames of a keyframe map: id from video and number, time from seconds, shot by the last start before it."""
    rows = map_rows.select("video_id", F.format_string("%s_%03d", "video_id", "n").alias("keyframe_id"), "frame_idx", M.seconds_ms(F.col("pts_time")).alias("timestamp_ms"), F.format_string("%s/%03d.jpg", "video_id", "n").alias("image_path"))
    return T.asof_shot(rows, shots).select("video_id", "shot_id", "keyframe_id", "frame_idx", "timestamp_ms", "image_path")


def ingest(store: Store, *, shots, transcripts, keyframes, segments, detections, ocr, ocr_api, recap, vectors: dict[str, DataFrame], batch: str = "batch2", least: float = 0.3) -> None:
    """One pass for all videos of a batch; a second run changes nothing but the times of the status."""
    store.upsert("shots", served_shots(shots, transcripts), "shot_id")
    store.insert_if_absent("frames", served_frames(keyframes, batch), "keyframe_id")
    store.enrich("frames", enrichments(keyframes, detections, ocr, ocr_api, recap, least), "keyframe_id", ["objects", "ocr_text", "ocr_api", "caption"])
    store.upsert("transcript_segments", served_segments(segments), "seg_id")
    videos = shots.groupBy("video_id").agg(F.max("fps").alias("fps"), F.count("*").alias("num_shots")).join(keyframes.groupBy("video_id").agg(F.count("*").alias("num_keyframes")), "video_id", "left")
    store.upsert("videos", videos.select("video_id", "fps", "num_shots", F.coalesce("num_keyframes", F.lit(0)).alias("num_keyframes"), F.lit(batch).alias("batch")), "video_id")
    frames = store.read("frames").join(keyframes.select("video_id").distinct(), "video_id", "left_semi")
    store.refresh("frame_text", index_docs(frames, store.read("shots")), "video_id")
    whole = store.read("frames")
    new = functools.reduce(DataFrame.union, (vector_rows(df, whole, model) for model, df in vectors.items())) if vectors else None
    if new is not None:
        pair = lambda df: df.withColumn("_pair", F.concat_ws("/", "model", "video_id"))
        store._merge("vectors", new, lambda old, rows: R.refresh(pair(old), pair(rows), "_pair").drop("_pair"))
    synced = {"elastic": keyframes.select("keyframe_id")}
    if new is not None:
        synced["milvus"] = new.select(F.col("frame_id").alias("keyframe_id"))
    store.set_synced(synced)


def index_texts(store: Store) -> dict[str, TextIndex]:
    """The text indexes of the read service, anew from ``frame_text``."""
    docs = store.read("frame_text").withColumnRenamed("frame_id", "keyframe_id")
    return {name: TextIndex.build(TextSearch(docs, "keyframe_id", {f: F.expr(e) for f, e in fields.items()}), store.path(f"index_{name}")) for name, fields in TEXTS.items()}


def index_vectors(store: Store, models: Sequence[str]) -> dict[str, VectorIndex]:
    """The vector indexes of these models, anew from ``vectors``."""
    table = store.read("vectors").withColumnRenamed("frame_id", "keyframe_id")
    return {m: VectorIndex.build(table.where(F.col("model") == m), store.path(f"index_{m}"), "keyframe_id") for m in models}
