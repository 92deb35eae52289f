"""Where models plug in: backends run in iterator functions, one instance a worker; an item's failure is a row, not the end."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as Late
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import BackendError, InputError, TransientBackendError
from ..functions import media, text
from ..operators import timeline
from . import stages


class ImageEmbedder(Protocol):
    dim: int

    def encode(self, paths: Sequence[str]) -> np.ndarray: ...


class Captioner(Protocol):
    def caption(self, requests: Sequence[dict]) -> list[str]: ...


class FakeEmbedder:
    """Unit vectors that hang on the path only."""

    def __init__(self, dim: int = 1152):
        self.dim = dim

    def encode(self, paths: Sequence[str]) -> np.ndarray:
        rows = [np.random.default_rng(int.from_bytes(hashlib.sha256(p.encode()).digest()[:8], "big")).standard_normal(self.dim) for p in paths]
        return np.array([r / np.linalg.norm(r) for r in rows], np.float32)


class FakeCaptioner:
    def caption(self, requests: Sequence[dict]) -> list[str]:
        return [f"a picture of {r['keyframe_id']}" for r in requests]


def with_retries(call: Callable, tries: int = 3, wait: float = 0.25):
    """Call again after a passing failure, waiting twice as long each time."""
    for n in range(tries):
        try:
            return call()
        except TransientBackendError:
            if n + 1 == tries:
                raise
            time.sleep(wait * 2**n)


def embed(frames: DataFrame, make: Callable[[], ImageEmbedder], size: int = 64, key: str = "keyframe_id", path: str = "image_path") -> DataFrame:
    """``key, embedding`` of every frame."""
    if size < 1:
        raise InputError("a batch has one frame at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend = make()
        for batch in batches:
            for i in range(0, batch.num_rows, size):
                part = batch.slice(i, size)
                x = backend.encode(part.column(1).to_pylist())
                if x.shape != (part.num_rows, backend.dim):
                    raise BackendError(f"shape {x.shape} for {part.num_rows} frames")
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(x.astype(np.float32)), pa.list_(pa.float32()))], [key, "embedding"])

    return frames.select(key, path).mapInArrow(run, f"{key} string, embedding array<float>")


def caption(frames: DataFrame, make: Callable[[], Captioner], size: int = 8, key: str = "keyframe_id") -> DataFrame:
    """``video_id, key, caption, error``: either is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend = make()
        for batch in batches:
            rows, captions, errors = batch.to_pylist(), [], []
            for i in range(0, len(rows), size):
                part = rows[i : i + size]
                try:
                    got = with_retries(lambda part=part: backend.caption(part))
                    if len(got) != len(part):
                        raise BackendError(f"{len(got)} captions for {len(part)} frames")
                    captions += got
                    errors += [None] * len(part)
                except BackendError as e:
                    captions += [None] * len(part)
                    errors += [str(e) or type(e).__name__] * len(part)
            cols = [pa.array([r["video_id"] for r in rows], pa.string()), pa.array([r[key] for r in rows], pa.string()), pa.array(captions, pa.string()), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["video_id", key, "caption", "error"])

    return frames.mapInArrow(run, f"video_id string, {key} string, caption string, error string")


# ---- one call a row ---------------------------------------------------------------------------------


class Detector(Protocol):
    def detect(self, path: str) -> list[tuple[str, float, list[float]]]: ...  # label, confidence, box


class Recogniser(Protocol):
    def read(self, path: str) -> tuple[tuple[int, int], list[tuple[list[float], str, float, str, float]]]: ...  # size; box, text, probability, other text, its probability


class Corrector(Protocol):
    def send(self, path: str, prompt: str) -> tuple[int, str]: ...  # status, reply


class Reader(Protocol):
    def read(self, path: str) -> str: ...


class ShotModel(Protocol):
    def changes(self, path: str) -> list[float]: ...  # for each frame, how likely a shot ends there


class SpeechModel(Protocol):
    def speech(self, path: str) -> list[tuple[int, int, str]]: ...  # start and end in ms, text


class AudioSource(Protocol):
    def audio(self, path: str, rate: int) -> bytes: ...  # one channel


def each(rows: DataFrame, make: Callable, call: Callable, inputs: Sequence[str], output: str, kind: str, empty=None) -> DataFrame:
    """``rows`` with ``output``, the result of ``call(backend, *inputs)`` for each, and ``error``.  One backend serves a task; where a
    call fails the output is ``empty`` and the error is named."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend = make()
        for batch in batches:
            values, errors = [], []
            for args in zip(*(batch.column(c).to_pylist() for c in inputs), strict=True):
                try:
                    values.append(with_retries(lambda args=args: call(backend, *args)))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  (a model may raise anything)
                    values.append(empty)
                    errors.append(str(e) or type(e).__name__)
            arrow = pa.array(values, type=arrow_kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, arrow, pa.array(errors, pa.string())], [*batch.schema.names, output, "error"])

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    arrow_kind = to_arrow_type(_parse_datatype_string(kind))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, `{output}` {kind}, error string")


# Least confidence, overlap from which the less confident of two boxes of a label goes, most objects of a picture.
CONFIDENT, OVERLAP, MOST_OBJECTS = 0.25, 0.45, 300


def suppressed(found: list[tuple[str, float, list[float]]], confident: float = CONFIDENT, overlap: float = OVERLAP, most: int = MOST_OBJECTS) -> list[dict]:
    """Objects in order of confidence without those that overlap a better one of their label; four digits of confidence, one of boxes."""
    kept: list[tuple[str, float, list[float]]] = []
    area = lambda b: max(0.0, b[2] - b[0]) * max(0.0, b[3] - b[1])

    def shared(a: list[float], b: list[float]) -> float:
        both = area([max(a[0], b[0]), max(a[1], b[1]), min(a[2], b[2]), min(a[3], b[3])])
        return both / max(area(a) + area(b) - both, 1e-9)

    for label, confidence, box in sorted((x for x in found if x[1] >= confident), key=lambda x: -x[1]):
        if len(kept) == most:
            break
        if all(label != k[0] or shared(box, k[2]) <= overlap for k in kept):
            kept.append((label, confidence, box))
    return [{"label": a, "confidence": round(c, 4), "bbox": [round(float(v), 1) for v in b]} for a, c, b in kept]


def detect(frames: DataFrame, make: Callable[[], Detector], path: str = "image_path", **limits) -> DataFrame:
    """``frames`` with ``objects``; a picture whose detection fails has none."""
    return each(frames, make, lambda backend, p: suppressed(backend.detect(p), **limits), [path], "objects", "array<struct<label:string,confidence:double,bbox:array<double>>>", [])


# Fixed value: how far a crop reaches beyond its box, in pixels.
CROP = 3


def recognise(frames: DataFrame, make: Callable[[], Recogniser], least: float, path: str = "image_path", ascii_only: bool = False) -> DataFrame:
    """``frames`` with two arrays of ``text, confidence, box``: ``texts``, arbitrated line by line, and ``origin``, those of the
    other recogniser alone.  Boxes are widened by CROP and cut to the picture; empty ones go."""

    def call(backend: Recogniser, p: str) -> list[dict]:
        (w, h), found = backend.read(p)
        rows = []
        for box, a, pa_, b, pb in found:
            x1, y1, x2, y2 = (int(v) for v in box)
            x1, y1, x2, y2 = max(0, x1 - CROP), max(0, y1 - CROP), min(w, x2 + CROP), min(h, y2 + CROP)
            if x2 > x1 and y2 > y1:
                rows.append({"a": a, "pa": float(pa_), "b": b, "pb": float(pb), "box": [x1, y1, x2, y2]})
        return rows

    raw = each(frames, make, call, [path], "_raw", "array<struct<a:string,pa:double,b:string,pb:double,box:array<int>>>", [])

    def lines(pick: Callable[[Column], Column]) -> Column:
        one = F.transform("_raw", lambda x: F.struct(pick(x).alias("l"), x["box"].alias("box")))
        return F.transform(F.filter(one, lambda x: x["l"].isNotNull()), lambda x: F.struct(x["l"]["text"].alias("text"), x["l"]["confidence"].alias("confidence"), x["box"].alias("box")))

    both = lines(lambda x: text.arbitrate(x["a"], x["pa"], x["b"], x["pb"], least, ascii_only))
    other = lines(lambda x: text.arbitrate(x["b"], x["pb"], x["b"], x["pb"], least, ascii_only))
    return raw.withColumns({"texts": both, "origin": other}).drop("_raw")


# Tries while the service is busy, seconds waited the first time and more each time, seconds of one request.
TRIES, WAIT, LIMIT = 8, 1.5, 90.0


def request(backend: Corrector, path: str, prompt: str, tries: int = TRIES, wait: float = WAIT, limit: float = LIMIT) -> tuple[str | None, str | None]:
    """Reply and, where there is none, why: ``hang_timeout`` or ``http_`` and the status.  Only a busy service (429) is asked again."""
    status, reply = 0, ""
    for n in range(tries):
        pool = ThreadPoolExecutor(1)
        try:
            status, reply = pool.submit(backend.send, path, prompt).result(timeout=limit)
        except Late:
            return None, "hang_timeout"
        finally:
            pool.shutdown(wait=False)  # a request that hangs is left behind
        if status != 429:
            break
        time.sleep(wait * (n + 1))
    return (reply, None) if status == 200 else (None, f"http_{status}")


def correct(frames: DataFrame, make: Callable[[], Corrector], path: str = "image_path", tries: int = TRIES, wait: float = WAIT, limit: float = LIMIT) -> DataFrame:
    """``frames(raw, truncated, ...)`` with ``lines`` and ``outcome``: the reply put in place, or the raw lines and why there is none."""

    def call(backend: Corrector, p: str, prompt: str | None) -> tuple:
        return dict(zip(("reply", "failure"), request(backend, p, prompt, tries, wait, limit) if prompt else ("", None), strict=True))

    prompt = text.numbered_prompt(F.col("raw"), F.transform("raw", lambda t, i: F.coalesce(F.get("truncated", i), F.lit(False))), stages.CUT_TAG)
    asked = each(frames.withColumn("_prompt", prompt), make, call, [path, "_prompt"], "_got", "struct<reply:string,failure:string>")
    asked = asked.withColumns({"reply": F.col("_got.reply"), "_why": F.coalesce("_got.failure", F.col("error"))}).drop("_got", "_prompt", "error")
    placed = stages.apply_correction(asked)
    failed = F.col("_why").isNotNull() & (F.size("raw") > 0)
    return placed.withColumns({"lines": F.when(failed, F.col("raw")).otherwise(F.col("lines")), "outcome": F.when(failed, F.col("_why")).otherwise(F.col("outcome"))}).drop("_why", "reply")


def read_texts(frames: DataFrame, make: Callable[[], Reader], path: str = "image_path") -> DataFrame:
    """``frames`` with the ``text`` that a model reads, trimmed."""
    return each(frames, make, lambda backend, p: (backend.read(p) or "").strip(), [path], "text", "string")


def find_shots(videos: DataFrame, make: Callable[[], ShotModel], threshold: float = 0.5, path: str = "path") -> DataFrame:
    """``video_id, shot_id, start_frame, end_frame, fps`` of ``videos(video_id, fps, path)``: a shot ends at a frame whose change exceeds ``threshold``."""
    scored = each(videos, make, lambda backend, p: [float(x) for x in backend.changes(p)], [path], "_c", "array<double>").where("error is null")
    frames = scored.select("video_id", "fps", F.posexplode("_c").alias("frame_idx", "score"))
    cut = timeline.scenes(frames, "video_id", "frame_idx", "score", threshold)
    rows = cut.join(scored.select("video_id", "fps"), "video_id")
    return rows.select("video_id", media.shot_id(F.col("video_id"), F.col("scene") - 1).alias("shot_id"), F.col("start").cast("bigint").alias("start_frame"), F.col("end").cast("bigint").alias("end_frame"), "fps")


def find_speech(videos: DataFrame, make: Callable[[], SpeechModel], path: str = "path") -> DataFrame:
    """``video_id, seg_id, start_ms, end_ms, text`` of the speech in ``videos``, numbered by start; blank texts go."""
    got = each(videos, make, lambda backend, p: [{"start_ms": a, "end_ms": b, "text": t.strip()} for a, b, t in backend.speech(p)], [path], "_s", "array<struct<start_ms:bigint,end_ms:bigint,text:string>>").where("error is null")
    said = F.array_sort(F.filter("_s", lambda x: x["text"] != ""))
    rows = got.select("video_id", F.posexplode(said).alias("n", "x"))
    return rows.select("video_id", media.shot_id(F.col("video_id"), F.col("n")).alias("seg_id"), "x.start_ms", "x.end_ms", "x.text")


# Fixed value: samples a second of the sound that speech models take.
RATE = 16_000


def audio(videos: DataFrame, make: Callable[[], AudioSource], rate: int = RATE, path: str = "path") -> DataFrame:
    """``videos`` with their sound, one channel at ``rate``."""
    return each(videos, make, lambda backend, p: backend.audio(p, rate), [path], "audio", "binary")
