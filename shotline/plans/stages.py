"""The batch stages between models: keyframes, recognised text, captions."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import InputError
from ..functions import media as M
from ..functions import text as X
from ..operators import metrics
from ..operators import relational as R
from ..operators import sequence as S

# The named strategies, by whether frames are chosen before they are encoded, and by encoder.
STRATEGIES = {"pipeline_a": (False, "beit3"), "pipeline_b": (False, "mobilenet"), "pipeline_c": (True, "beit3"), "pipeline_d": (True, "mobilenet")}

# ---- keyframes ----------------------------------------------------------------------------------


def every_frame(frames: DataFrame) -> DataFrame:
    """All frames of a shot are candidates."""
    return frames


def steepest_frames(ratio: float = 0.02, window: int = 3, digits: int = 9) -> Callable[[DataFrame], DataFrame]:
    """Candidates: per shot its first frame and those where the encoded size changes most, smoothed."""
    key, order = ["video_id", "shot_id"], ["frame_idx"]

    def pick(frames: DataFrame) -> DataFrame:
        steep = frames.withColumn("_steep", S.steepness("size", key, order))
        smooth = steep.withColumn("_score", F.round(S.moving_average(F.col("_steep"), key, order, window), digits))
        return S.candidates(smooth, key, "frame_idx", "_score", ratio).drop("_steep", "_score")

    return pick


def extract_keyframes(frames: DataFrame, candidates: Callable[[DataFrame], DataFrame] = every_frame, encode: Callable[[DataFrame], DataFrame] | None = None, threshold: float = 0.9, fps: Column | None = None, ms: Column | None = None) -> DataFrame:
    """Keyframes of ``frames(video_id, shot_id, frame_idx, ...)``: candidates, their vectors, and of those the ones less
    like the last kept one than ``threshold``.  A strategy is a choice of ``candidates`` and ``encode``; without ``encode``
    the frames carry their ``embedding``.  All three steps share one partitioning by shot.

    ``ms`` is the time of a frame where it is known exactly; else it is cut off from the frame rate's division, which may
    lose a millisecond (frame 201 at 25 a second: 8,039)."""
    chosen = candidates(frames)
    chosen = encode(chosen) if encode else chosen
    kept = S.keep_last(chosen, ["video_id", "shot_id"], ["frame_idx"], "embedding", threshold).where("kept")
    number = S.numbered(["video_id", "shot_id"], ["frame_idx"])
    at = M.keyframe_ms(F.col("frame_idx"), F.lit(25.0) if fps is None else fps) if ms is None else ms
    return kept.select("video_id", "shot_id", M.keyframe_id(F.col("shot_id"), number).alias("keyframe_id"), "frame_idx", at.alias("timestamp_ms"), F.lit("").alias("image_path"), "embedding")


def strategy(name: str, encoders: dict[str, Callable[[DataFrame], DataFrame]], threshold: float = 0.9, ratio: float = 0.02, window: int = 3) -> Callable[[DataFrame], DataFrame]:
    """One of the four named ways to extract keyframes: every frame or the steepest ones, encoded by the large or the small model.

    ``encoders`` has one for each of ``beit3`` and ``mobilenet`` that is used; an encoder is
    given all chosen frames at once, so its model is loaded once a task, and not at all where it is not.
    """
    if name not in STRATEGIES:
        raise InputError(f"no strategy {name}; there are {', '.join(STRATEGIES)}")
    steep, encoder = STRATEGIES[name]
    if encoder not in encoders:
        raise InputError(f"strategy {name} needs an encoder {encoder}")
    return functools.partial(extract_keyframes, candidates=steepest_frames(ratio, window) if steep else every_frame, encode=encoders[encoder], threshold=threshold)


def dataset(keyframes: DataFrame, embed: Callable[[DataFrame], DataFrame] | None = None, caption: Callable[[DataFrame], DataFrame] | None = None, done: DataFrame | None = None) -> dict[str, DataFrame]:
    """Vectors and captions of all videos' keyframes in one job each; captions of an earlier run are taken over."""
    out = {}
    if embed:
        out["embeddings"] = embed(keyframes)
    if caption:
        out["captions"] = caption(keyframes) if done is None else resume_captions(keyframes, done, caption)
    if not out:
        raise InputError("neither an embedder nor a captioner was given")
    return out


def playable(videos: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Videos with a frame rate, and the others with their failure."""
    ok = F.coalesce(F.col("fps") > 0, F.lit(False))
    return videos.where(ok), videos.where(~ok).withColumn("error", F.lit("no frame rate"))


# ---- what to skip, and whose result to reuse ------------------------------------------------------


# Mean brightness of a blank picture, variance of a blurry one's edges.
BLANK, BLURRY = 15.0, 50.0
# The share of a picture's rows at its top and at its bottom where a banner may be, and how much stronger its edges then are.
TOP, BOTTOM, STRONGER = 0.12, 0.28, 2.0
# Fixed value: what a cut-off line is marked with in a request.
CUT_TAG = "[CẮT] "


def skip_reasons(luma: Column, sharpness: Column, blank: float = BLANK, blurry: float = BLURRY) -> Column:
    return F.when(luma < blank, "blank").when(sharpness < blurry, "blurry")


def news_bands(energy: Column, top: float = TOP, bottom: float = BOTTOM, stronger: float = STRONGER) -> Column:
    """``array<struct(first, last)>``: the rows of a picture to read, from the edge energy of each row.

    The strip at the top, the one at the bottom, or both, where their mean energy is
    ``stronger`` times that of the rows between them; the whole picture where neither is.
    """
    n = F.size(energy)
    until, since = F.greatest(F.lit(1), F.floor(n * top)), F.least(n - 1, F.floor(n * F.lit(1.0 - bottom)))
    mean = lambda a, b: F.aggregate(F.slice(energy, (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int")), F.lit(0.0), lambda s, x: s + x) / F.nullif(F.greatest(b - a, F.lit(0)), F.lit(0))
    between = mean(until, since) + 1e-6
    rows = lambda a, b: F.struct(a.cast("int").alias("first"), (b - 1).cast("int").alias("last"))
    strip = lambda a, b: F.when(mean(a, b) / between >= stronger, rows(a, b))
    strips = F.array_compact(F.array(strip(F.lit(0), until), strip(since, n)))
    return F.when(n > 0, F.when(F.size(strips) > 0, strips).otherwise(F.array(rows(F.lit(0), n))))


def shared_requests(ocr: DataFrame, key: str = "video_id", order: str = "frame_id") -> tuple[DataFrame, DataFrame]:
    """Consecutive frames with equal, non-empty lines make one request, that of the first: the rows with their ``run``, and the first rows."""
    lines = ocr.withColumn("_raw", F.transform("texts", lambda t: t["text"]))
    runs = S.equal_runs(lines, [key], [order], "_raw", F.size("_raw") > 0).drop("_raw")
    return runs, runs.where("leads")


def share_results(runs: DataFrame, results: DataFrame, key: str = "video_id") -> DataFrame:
    """Give every frame of a run the result of its first; the first one's lines, confidences and boxes go with it."""
    return runs.drop("texts").join(results.select(key, "run", *(c for c in results.columns if c not in runs.columns or c == "texts")), [key, "run"], "left")


# ---- corrected text ---------------------------------------------------------------------------------


def apply_correction(rows: DataFrame, tag: str = CUT_TAG) -> DataFrame:
    """``rows(raw array<string>, truncated array<boolean>, reply string)`` with ``lines`` and ``outcome``.

    A reply is a numbered list.  Unless its numbers are exactly 1 to n, all lines stay raw
    (``bad_format``).  If they are, its lines are placed by likeness, not by number: a slot
    that none is like stays raw (``unmatched``, if the reply does not have that line either),
    and so does a cut-off line that grew too much (``trunc``).
    """
    n = F.size("raw")
    rows = rows.withColumn("_m", X.numbered_lines(F.coalesce("reply", F.lit("")), tag)).withColumn("_ok", (n > 0) & X.numbers_complete(F.col("_m"), n))
    rows = rows.withColumn("_v", F.when(F.col("_ok"), F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.element_at("_m", i))))
    fold = lambda c: F.transform(c, lambda t: X.unaccented(t))
    rows = rows.withColumn("_slot", F.map_from_entries(F.transform(F.map_entries(metrics.matched_lines(fold(F.col("_v")), fold(F.col("raw")))), lambda e: F.struct(e["value"], e["key"]))))
    placed = F.transform("raw", lambda t, i: F.coalesce(F.get("_v", F.element_at("_slot", i)), t))
    rows = rows.withColumn("_p", placed)
    guarded = lambda p, i: X.growth_guard(F.get("raw", i), p, F.coalesce(F.get("truncated", i), F.lit(False)))
    rows = rows.withColumn("lines", F.when(F.col("_ok"), F.transform("_p", guarded)).otherwise(F.col("raw")))
    both = F.arrays_zip(F.col("raw"), F.col("_p"), F.col("lines"))
    count = lambda test: F.size(F.filter(both, test))
    unmatched = count(lambda x: (x["lines"] == x["raw"]) & ~F.array_contains("_v", x["lines"]))
    tagged = F.when(n == 0, "empty_input").when(~F.col("_ok"), "bad_format").otherwise(X.outcome(unmatched, count(lambda x: x["lines"] != x["_p"])))
    return rows.withColumn("outcome", tagged).drop("_m", "_ok", "_v", "_slot", "_p")


# ---- captions -------------------------------------------------------------------------------------------


def with_hints(keyframes: DataFrame, ocr: DataFrame | None, objects: DataFrame | None) -> DataFrame:
    """Keyframes with what other models saw; an index that was given must match some keyframe."""
    out = keyframes
    for df, value, name in ((ocr, F.col("texts"), "ocr_hints"), (objects, F.col("objects"), "object_hints")):
        if df is not None:
            out = R.must_meet(out, df.select(F.col("frame_id").alias("keyframe_id"), value.alias(name)), "keyframe_id")
    return out


def resume_captions(keyframes: DataFrame, done: DataFrame, caption: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Captions for all keyframes: those done before, and new ones for the rest."""
    fresh = caption(R.pending(keyframes, done, "keyframe_id")).select("keyframe_id", "caption", "error")
    old = done.select("keyframe_id", "caption", F.lit(None).cast("string").alias("error"))
    return R.resume(keyframes.select("video_id", "keyframe_id"), old, fresh, "keyframe_id", ["caption", "error"])


def write_policy(exists: bool, resume: bool, overwrite: bool) -> str:
    """What to do with a target: create, resume or overwrite; anything else is an error."""
    if resume and overwrite:
        raise InputError("resume and overwrite exclude each other")
    if not exists:
        return "create"
    if not (resume or overwrite):
        raise InputError("the target exists; resume or overwrite it")
    return "resume" if resume else "overwrite"
