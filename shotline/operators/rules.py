"""Data-quality rules: each gives its violations as rows, or raises on the first ones."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import QualityError
from ..functions import text as X
from ..functions import vectors as V


#: Folders whose listing one check reads.
MOST_FOLDERS = 10_000


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """``key, rule`` for each rule that a row does not fulfil; null counts as not."""
    broken = F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()))
    return df.select(F.col(key).cast("string").alias("key"), F.explode(F.array_compact(broken)).alias("rule"))


def repeated(df: DataFrame, key: str, rule: str = "unique_key") -> DataFrame:
    return df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n")).where("n > 1").select("key", F.lit(rule).alias("rule"))


def check(found: DataFrame) -> None:
    """Raise with the first five violations, if there are any."""
    rows = found.orderBy("key", "rule").limit(5).collect()
    if rows:
        raise QualityError("; ".join(f"{r['key']}: {r['rule']}" for r in rows))


def ocr_rules() -> dict[str, Column]:
    t = F.col("texts")
    return {
        "frame_id": F.trim("frame_id") != "",
        "texts": t.isNotNull(),
        "text": F.forall(t, lambda x: F.trim(x["text"]) != ""),
        "confidence": F.forall(t, lambda x: x["confidence"].between(0, 1)),
        "box": F.forall(t, lambda x: x["box"].isNull() | (F.size(x["box"]) == 4) & (F.get(x["box"], 0) <= F.get(x["box"], 2)) & (F.get(x["box"], 1) <= F.get(x["box"], 3))),
    }


def detection_rules() -> dict[str, Column]:
    o = F.col("objects")
    return {
        "frame_id": F.trim("frame_id") != "",
        "label": F.forall(o, lambda x: F.trim(x["label"]) != ""),
        "confidence": F.forall(o, lambda x: x["confidence"].between(0, 1)),
        "bbox": F.forall(o, lambda x: x["bbox"].isNull() | (F.size(x["bbox"]) == 4) & (F.get(x["bbox"], 0) <= F.get(x["bbox"], 2)) & (F.get(x["bbox"], 1) <= F.get(x["bbox"], 3))),
    }


def embedding_rules(dim: int, vector: str = "embedding") -> dict[str, Column]:
    v = F.col(vector)
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return {"dim": F.size(v) == dim, "finite": finite, "unit_norm": V.is_unit(v)}


def keyframe_rules() -> dict[str, Column]:
    return {"video_id": X.valid_identifier(F.col("video_id")), "keyframe_id": X.valid_identifier(F.col("keyframe_id")), "image_path": F.trim("image_path") != ""}


def recap_rules() -> dict[str, Column]:
    c = F.col("corrected_ocr")
    return {
        "video_id": X.valid_identifier(F.col("video_id")),
        "keyframe_id": X.valid_identifier(F.col("keyframe_id")),
        "caption": F.trim("caption") != "",
        "corrected_ocr": c.isNotNull() & F.forall(c, lambda x: F.trim(x) != "") & (F.size(F.array_distinct(c)) == F.size(c)),
    }


def one_video(df: DataFrame) -> None:
    ids = [r[0] for r in df.select("video_id").distinct().limit(2).collect()]
    if len(ids) != 1:
        raise QualityError(f"one video is asked for, not {len(ids) or 'none'}")


def readable(df: DataFrame, path: str = "image_path") -> DataFrame:
    """Rows of ``df`` whose picture is there and not empty; the listing is one scan of the folders that the paths are in."""
    folders = [r[0] for r in df.select(F.regexp_replace(path, "/[^/]*$", "").alias("f")).distinct().limit(MOST_FOLDERS + 1).collect()]
    if not folders:
        raise QualityError("there are no keyframes")
    if len(folders) > MOST_FOLDERS:
        raise QualityError(f"more than {MOST_FOLDERS} folders; check them in parts")
    there = df.sparkSession.read.format("binaryFile").load(folders).where("length > 0").select(F.regexp_replace("path", "^file:/*", "/").alias("_there"))
    return df.join(there, F.regexp_replace(path, "^file:/*", "/") == F.col("_there"), "left_semi")


def hint_rules(field: str, keys: set[str], optional: set[str] = frozenset()) -> dict[str, Column]:
    """Rules of raw JSON records ``value``: an object with exactly ``frame_id`` and ``field``, whose items have exactly ``keys``, some of
    which may be missing."""
    items = F.from_json(F.get_json_object("value", f"$.{field}"), "array<string>")
    shapes = [keys, keys - set(optional)] if optional else [keys]
    ok = lambda x: functools.reduce(lambda a, b: a | b, (closed_json(x, s) for s in shapes))
    return {"keys": closed_json(F.col("value"), {"frame_id", field}), "frame_id": F.trim(F.get_json_object("value", "$.frame_id")) != "", field: items.isNotNull() & F.forall(items, ok)}


def closed_json(c: Column, keys: set[str]) -> Column:
    """Whether a JSON object has exactly these keys."""
    return F.coalesce(F.array_sort(F.json_object_keys(c)) == F.array(*map(F.lit, sorted(keys))), F.lit(False))


def equal_counts(a: DataFrame, b: DataFrame, what: str = "rows") -> None:
    x, y = a.count(), b.count()
    if x != y:
        raise QualityError(f"{x} and {y} {what}")
