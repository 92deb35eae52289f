"""Time, identity and report rules of media rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def served_ms(frame: Column, fps: Column) -> Column:
    """Milliseconds of a frame, half to even."""
    return F.rint(frame / fps * 1000).cast("bigint")


def mapped_ms(frame: Column, fps: Column) -> Column:
    """Milliseconds of a frame, cut off."""
    return (frame / fps * 1000).cast("bigint")


def keyframe_ms(frame: Column, fps: Column) -> Column:
    return mapped_ms(frame, F.greatest(fps, F.lit(1.0)))


def seconds_ms(seconds: Column) -> Column:
    return F.rint(seconds * 1000).cast("bigint")


def shot_seconds(start: Column, end: Column, fps: Column) -> Column:
    return (end - start) / F.greatest(fps, F.lit(1.0))


def shot_frames(start: Column, end: Column) -> Column:
    return end - start + 1


def shot_id(video: Column, number: Column) -> Column:
    return F.format_string("%s_%06d", video, number)


def keyframe_id(shot: Column, number: Column) -> Column:
    return F.format_string("%s_kf%04d", shot, number)


def normalised_shot_id(raw: Column) -> Column:
    """Whole numbers become S and four digits; anything else stays."""
    return F.when(raw.rlike(r"^\d+$"), F.concat(F.lit("S"), F.lpad(raw, 4, "0"))).otherwise(raw)


def absolute_path(root: str, path: Column) -> Column:
    return F.when(path.startswith("/"), path).otherwise(F.concat_ws("/", F.lit(root.rstrip("/")), path))


def relative_path(root: str, path: Column) -> Column:
    root = root.rstrip("/") + "/"
    return F.when(path.startswith(root), F.substring(path, len(root) + 1, 1 << 30)).otherwise(path)


def region(x: Column, y: Column) -> Column:
    """The third of the picture, like ``left-top``, that a point in [0, 1) lies in."""
    third = lambda v: F.floor(F.least(F.greatest(v, F.lit(0.0)), F.lit(0.999999)) * 3).cast("int") + 1
    return F.concat_ws("-", F.element_at(F.array(*map(F.lit, ("left", "center", "right"))), third(x)), F.element_at(F.array(*map(F.lit, ("top", "middle", "bottom"))), third(y)))


def confident(items: Column, least: float) -> Column:
    """The array's elements whose confidence is enough."""
    return F.filter(items, lambda t: t["confidence"] >= least)


def joined_text(texts: Column, least: float) -> Column:
    """Texts of the lines that are confident enough, in array order."""
    return F.array_join(F.transform(confident(texts, least), lambda t: t["text"]), " ")


def label_confidence(objects: Column, least: float) -> Column:
    """``map<label, highest confidence>`` of the objects that are confident enough, without a shuffle."""
    good = confident(objects, least)
    labels = F.array_distinct(F.transform(good, lambda o: o["label"]))
    top = lambda name: F.array_max(F.transform(F.filter(good, lambda o: o["label"] == name), lambda o: o["confidence"]))
    return F.map_from_entries(F.transform(labels, lambda name: F.struct(name, top(name))))


def truncated_mask(texts: Column, width: Column, edge: int = 10) -> Column:
    """Which lines touch the picture's left or right edge; null without boxes."""
    cut = F.transform(texts, lambda t: (F.get(t["box"], 0) <= edge) | (F.get(t["box"], 2) >= width - edge))
    return F.when(F.get(texts, 0)["box"].isNotNull(), cut)


def rounded_objects(objects: Column) -> Column:
    return F.transform(objects, lambda o: F.struct(o["label"].alias("label"), F.bround(o["confidence"], 4).alias("confidence"), F.transform(o["bbox"], lambda v: F.bround(v, 1)).alias("bbox")))


def hints_json(objects: Column) -> Column:
    return F.to_json(F.transform(objects, lambda o: F.struct(o["label"].alias("label"), F.bround(o["confidence"], 4).alias("confidence"))))
