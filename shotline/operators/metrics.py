"""Keyframe and recognition metrics."""

from __future__ import annotations

import difflib
import os
from decimal import ROUND_CEILING, ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors as V
from ..functions.text import norm


def diversity(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, n, diversity``: 1 less the mean cosine of all pairs, 0 at least, 1 for a single row.

    The sum over pairs is (|sum of unit vectors|^2 - n) / 2, so no pair is ever made: the
    vectors' places are summed per key, with partial sums on the map side.
    """
    unit = rows.select(key, F.posexplode(V.normalised(F.col(vector))).alias("p", "x"))
    sums = unit.groupBy(key, "p").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"), F.count("*").alias("n"))
    total = sums.groupBy(key).agg(F.sum(F.col("s") * F.col("s")).alias("s2"), F.sum("q").alias("q"), F.max("n").alias("n"))
    mean = (F.col("s2") - F.col("q")) / (F.col("n") * (F.col("n") - 1))
    return total.select(key, "n", F.when(F.col("n") <= 1, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - mean)).alias("diversity"))


def coverage(keyframes: DataFrame, videos: DataFrame, key: str, at: str, total: str, fps: str, seconds: float = 1.0) -> DataFrame:
    """``key, covered, coverage``: the share of frames within half a window, ``int(seconds * fps) // 2``, of a keyframe.

    Windows are merged as intervals in order; frames are never expanded.
    """
    half = F.floor(F.floor(F.lit(seconds) * F.col(fps)) / 2)
    lo, hi = F.greatest(F.lit(0), F.col(at) - half), F.least(F.col(total) - 1, F.col(at) + half)
    spans = keyframes.select(key, at).join(videos.select(key, total, fps), key).select(key, lo.alias("lo"), hi.alias("hi")).where("lo <= hi")
    before = F.max("hi").over(Window.partitionBy(key).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1))
    new = spans.select(key, F.greatest(F.lit(0), F.col("hi") - F.greatest(F.coalesce(before + 1, F.col("lo")), F.col("lo")) + 1).alias("n"))
    covered = new.groupBy(key).agg(F.sum("n").alias("covered"))
    return videos.select(key, total).join(covered, key, "left").select(key, F.coalesce("covered", F.lit(0)).cast("bigint").alias("covered"), (F.coalesce("covered", F.lit(0)) / F.greatest(F.col(total), F.lit(1))).alias("coverage"))


#: Vectors of a side that one task holds, about; vectors of a side that are multiplied at once.
SIDE, STEP = 8_192, 512
#: By how much a product of matrices may be off a cosine summed in order, well above what it is.
SLACK = 1e-11


def _by_length(vectors: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows and their vectors in double precision, by the vectors' length; vectors that are null or hold a null are left out."""
    size = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    values = pc.list_flatten(vectors)
    of = pc.list_parent_indices(vectors).to_numpy(zero_copy_only=False)
    if values.null_count:
        holed = np.isin(of, of[values.is_null().to_numpy(zero_copy_only=False)])
        size = size.copy()
        size[of[holed]] = -1
    flat = values.to_numpy(zero_copy_only=False)
    out = {}
    for n in np.unique(size[size > 0]).tolist():
        out[n] = np.flatnonzero(size == n), flat[size[of] == n].astype(np.float64).reshape(-1, n)
    return out


def _reaches(x: np.ndarray, y: np.ndarray, least: float, digits: int) -> np.ndarray:
    """For pairs of rows whether their cosine reaches ``least``, as the column functions sum and round it."""
    total = lambda v: np.cumsum(v, axis=1)[:, -1]
    cos, at = np.unique(total(x * y) / (np.sqrt(total(x * x)) * np.sqrt(total(y * y))), return_inverse=True)
    return np.array([float(Decimal(repr(c)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) >= least for c in cos.tolist()], bool)[at]


def met(x: np.ndarray, y: np.ndarray, least: float, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of ``x`` have a row of ``y`` whose cosine, rounded, reaches ``least``, and which of ``y`` one of ``x``.

    A row is compared until it has met one.  What has no direction meets none; a vector with a
    component that is not finite has no cosine below any other, so it meets all.
    """
    odd_x, odd_y = ~np.isfinite(x).all(axis=1), ~np.isfinite(y).all(axis=1)
    hit_x, hit_y = odd_x & bool(len(y)) | odd_y.any(), odd_y & bool(len(x)) | odd_x.any()
    length_x, length_y = (np.sqrt(np.einsum("ij,ij->i", v, v)) for v in (x, y))
    rows, cols = np.flatnonzero(~odd_x & (length_x > 0)), np.flatnonzero(~odd_y & (length_y > 0))
    a, b = x[rows] / length_x[rows, None], y[cols] / length_y[cols, None]
    # The least value that is not rounded below ``least``.
    edge = float(Decimal(repr(float(least))).quantize(Decimal(1).scaleb(-digits), ROUND_CEILING) - Decimal(5).scaleb(-digits - 1))

    def scan(p: np.ndarray, q: np.ndarray, exact_p: np.ndarray, exact_q: np.ndarray, done_p: np.ndarray, done_q: np.ndarray) -> None:
        for c in range(0, len(q), STEP):
            left = np.flatnonzero(~done_p)
            if not len(left):
                return
            some = q[c : c + STEP].T
            for r in range(0, len(left), STEP):
                at = left[r : r + STEP]
                product = (p[at] @ some).ravel()
                near = np.flatnonzero(product >= edge - SLACK)
                if len(near):
                    i, j = np.divmod(near, some.shape[1])
                    i, j, sure = at[i], j + c, product[near] >= edge + SLACK
                    if not sure.all():
                        sure[~sure] = _reaches(exact_p[i[~sure]], exact_q[j[~sure]], least, digits)
                    done_p[i[sure]], done_q[j[sure]] = True, True

    done_a, done_b = hit_x[rows], hit_y[cols]
    scan(a, b, x[rows], y[cols], done_a, done_b)
    # A row that met none was compared with all; the others may have stopped before a column that met none.
    left, stopped = np.flatnonzero(~done_b), np.flatnonzero(done_a)
    done = done_b[left]
    scan(b[left], a[stopped], y[cols[left]], x[rows[stopped]], done, np.zeros(len(stopped), bool))
    done_b[left] = done
    hit_x[rows], hit_y[cols] = done_a, done_b
    return hit_x, hit_y


def precision_recall(pred: DataFrame, truth: DataFrame, key: str, id: str, vector: str, threshold: float = 0.8, digits: int = 9) -> DataFrame:
    """Per key: the share of predictions near some truth, of truths near some prediction, and F1; an empty side gives zeros.  Nearest neighbours, not one to one.

    Each vector is compared, by products of matrices, until one near it was met.  Both sides of
    a key are dealt into parts of SIDE vectors, and a task compares two parts: that bounds its
    memory, and what leaves it is the vectors that met one.
    """
    n = pred.groupBy(key).agg(F.count("*").alias("np")).join(truth.groupBy(key).agg(F.count("*").alias("nt")), key, "full").select(key, F.coalesce("np", F.lit(0)).alias("np"), F.coalesce("nt", F.lit(0)).alias("nt"))
    count = lambda c: F.ceil(F.col(c) / F.lit(float(SIDE))).cast("int")
    parts = n.where("np > 0 and nt > 0").select(key, count("np").alias("_np"), count("nt").alias("_nt"))

    def dealt(df: DataFrame, is_pred: bool) -> DataFrame:
        own, other = ("_np", "_nt") if is_pred else ("_nt", "_np")
        mine = F.pmod(F.xxhash64(id, vector), F.col(own)).cast("int")
        place = lambda k: (mine * F.col("_nt") + k) if is_pred else (k * F.col("_nt") + mine)
        cells = F.transform(F.sequence(F.lit(0), F.col(other) - 1), place)
        return df.join(parts, key).select(key, F.explode(cells).alias("_cell"), F.col(id).alias("_id"), F.col(vector).alias("_v"), F.lit(is_pred).alias("_of_pred"))

    both = dealt(pred, True).unionByName(dealt(truth, False))

    def compare(cell: pa.Table) -> pa.Table:
        of_pred = cell["_of_pred"].to_numpy()
        vectors = _by_length(cell["_v"].combine_chunks())
        hits = []
        for rows, x in vectors.values():
            mine = of_pred[rows]
            hit = np.zeros(len(rows), bool)
            hit[mine], hit[~mine] = met(x[mine], x[~mine], threshold, digits)
            hits.append(rows[hit])
        return cell.select([key, "_id", "_of_pred"]).take(pa.array(np.concatenate(hits) if hits else np.empty(0, np.int64)))

    kinds = {f.name: f.dataType for f in both.schema.fields}
    schema = T.StructType([T.StructField(c, kinds[c]) for c in (key, "_id", "_of_pred")])
    # As many tasks as there are partitions, however few the bytes: a part's comparison is long.
    cells = both.repartition(int(pred.sparkSession.conf.get("spark.sql.shuffle.partitions")), key, "_cell")
    best = cells.groupBy(key, "_cell").applyInArrow(compare, schema).distinct().select(key, F.col("_of_pred").cast("int").alias("_of_pred"))
    hits = best.groupBy(key).agg(F.sum("_of_pred").alias("hp"), F.sum(1 - F.col("_of_pred")).alias("ht"))
    share = lambda h, total: F.coalesce(F.try_divide(F.col(h), F.col(total)), F.lit(0.0))
    both = n.join(hits, key, "left").select(key, share("hp", "np").alias("precision"), share("ht", "nt").alias("recall"))
    return both.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))


def nearest(rows: DataFrame, others: DataFrame, key: str, id: str, vector: str) -> DataFrame:
    """For each row its best cosine among the others of its key, or null."""
    o = others.select(key, F.col(vector).alias("_o"))
    return rows.join(o, key, "left").groupBy(key, id).agg(F.max(V.cosine(F.col(vector), F.col("_o"))).alias("best"))


def line_recall(lines: DataFrame, texts: DataFrame, key: str, least: int = 4) -> DataFrame:
    """``key, hits, total`` of the lines found in the text of their key, both in normal form; lines shorter than ``least`` don't count.

    A key's lines are gathered to one array, so its text is shuffled and folded once, not once a line.
    """
    n = lines.select(key, norm(F.col("line")).alias("_n")).where(F.length("_n") >= least).groupBy(key).agg(F.collect_list("_n").alias("_n"))
    both = n.join(texts.select(key, norm(F.col("text")).alias("_t")), key).where("_t is not null")
    counted = both.select(key, F.size(F.filter("_n", lambda x: F.contains(F.col("_t"), x))).alias("_hits"), F.size("_n").alias("_total"))
    return counted.groupBy(key).agg(F.sum("_hits").cast("bigint").alias("hits"), F.sum("_total").cast("bigint").alias("total"))


def repeats(lines: DataFrame, key: str, least: int = 10) -> DataFrame:
    """``key, most, looping``: how often the key's commonest line stands in it."""
    n = lines.groupBy(key, "line").agg(F.count("*").alias("n")).groupBy(key).agg(F.max("n").alias("most"))
    return n.withColumn("looping", F.col("most") >= least)


@F.pandas_udf(T.DoubleType())
def similarity_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of two texts."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="Float64")


def ratios(lines: list[str], slots: list[str], least: float = 0.45, autojunk: bool = True) -> np.ndarray:
    """The matrix of lines by slots with their similarity; -1 for nulls and for pairs that bounds of it show to be below ``least``."""
    out = np.full((len(lines), len(slots)), -1.0)
    for j, slot in enumerate(slots):
        if slot is None:
            continue
        m = difflib.SequenceMatcher(None, "", slot, autojunk)
        for i, line in enumerate(lines):
            if line == slot:
                out[i, j] = 1.0
            elif line is not None:
                m.set_seq1(line)
                if m.real_quick_ratio() >= least and m.quick_ratio() >= least:
                    out[i, j] = m.ratio()
    return out


def best_pairs(ratio: np.ndarray, least: float = 0.45) -> dict[int, int]:
    """Line to slot, one to one: the best pair of a free line and a free slot is taken until none reaches ``least``.
    Of equal pairs the one of the last line is taken, and of its slots the last."""
    free, out = ratio.copy(), {}
    while free.size:
        line, slot = divmod(free.size - 1 - int(free[::-1, ::-1].argmax()), free.shape[1])
        if free[line, slot] < least:
            break
        out[line] = slot
        free[line, :] = free[:, slot] = -1.0
    return out


def _surely_like(line: str, slot: str, least: float) -> bool:
    """Whether a text that both share shows that their similarity reaches ``least``: the longest common one counts whole, as below 200 characters none is junk."""
    shared = len(slot) if slot in line else len(line) if line in slot else len(os.path.commonprefix([line, slot]))
    return len(slot) < 200 and 2.0 * shared >= least * (len(line) + len(slot)) + 1e-9


def match_lines(lines: list[str], slots: list[str], least: float = 0.45) -> dict[int, int]:
    """``best_pairs`` of two lists of texts.

    Only equal texts have similarity 1, so they are paired first, from the last line and its last
    slot on; what is left is compared.
    """
    out, places = {}, {}
    for j, slot in enumerate(slots):
        if slot is not None and least <= 1:
            places.setdefault(slot, []).append(j)
    for i in range(len(lines) - 1, -1, -1):
        if places.get(lines[i]):
            out[i] = places[lines[i]].pop()
    taken = set(out.values())
    a = [i for i, line in enumerate(lines) if i not in out and line is not None]
    b = [j for j, slot in enumerate(slots) if j not in taken and slot is not None]
    if len(a) == len(b) == 1 and _surely_like(lines[a[0]], slots[b[0]], least):
        out[a[0]] = b[0]
    elif a and b:
        rest = best_pairs(ratios([lines[i] for i in a], [slots[j] for j in b], least), least)
        out |= {a[i]: b[j] for i, j in rest.items()}
    return out


@F.pandas_udf(T.MapType(T.IntegerType(), T.IntegerType()))
def matched_lines(lines: pd.Series, slots: pd.Series) -> pd.Series:
    """``match_lines`` on arrays of texts in folded form; a picture has few lines.

    Equal texts are each other's best match, so where both lists have the same distinct texts no other pair is compared.
    """

    def one(a, b) -> dict[int, int]:
        if a is None or b is None:
            return {}
        a, b = list(a), list(b)
        if len(set(a)) == len(a) and len(set(b)) == len(b) and set(a) == set(b) and None not in a:
            return {i: b.index(x) for i, x in enumerate(a)}
        return match_lines(a, b)

    return pd.Series([one(a, b) for a, b in zip(lines, slots, strict=True)])


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("ratio", T.DoubleType()), T.StructField("line", T.IntegerType()), T.StructField("slot", T.IntegerType())])))
def scored_texts(texts: pd.Series, slots: pd.Series) -> pd.Series:
    """The pairs of two arrays of long texts that reach 0.45: no character is taken for junk because it is frequent."""

    def one(a, b) -> list[dict]:
        r = ratios(list(a), list(b), autojunk=False)
        return [{"ratio": float(r[i, j]), "line": int(i), "slot": int(j)} for i, j in np.argwhere(r >= 0.45)]

    return pd.Series([one(a, b) for a, b in zip(texts, slots, strict=True)])


@F.pandas_udf(T.MapType(T.IntegerType(), T.IntegerType()))
def matched_scores(scored: pd.Series) -> pd.Series:
    """``best_pairs`` on arrays of ``ratio, line, slot``."""

    def one(rows) -> dict[int, int]:
        r = np.full((1 + max((x["line"] for x in rows), default=-1), 1 + max((x["slot"] for x in rows), default=-1)), -1.0)
        for x in rows:
            r[x["line"], x["slot"]] = x["ratio"]
        return best_pairs(r)

    return pd.Series([one(s) for s in scored])


def keyframe_statistics(shots: DataFrame, keyframes: DataFrame, timing: DataFrame, key: str = "video_id") -> DataFrame:
    """Per video: shots, keyframes, keyframes a shot, frames a second, rounded for the report."""
    n = shots.groupBy(key).agg(F.count("*").alias("num_shots")).join(keyframes.groupBy(key).agg(F.count("*").alias("total_keyframes")), key, "left").join(timing, key, "left")
    per = F.coalesce("total_keyframes", F.lit(0)) / F.greatest("num_shots", F.lit(1))
    return n.select(key, "num_shots", F.coalesce("total_keyframes", F.lit(0)).alias("total_keyframes"), F.bround(per, 2).alias("avg_keyframes_per_shot"), F.bround("seconds", 2).alias("processing_time_sec"), F.bround(F.coalesce(F.try_divide(F.col("frames"), F.col("seconds")), F.lit(0.0)), 1).alias("processing_fps"))


def shot_coverage(shots: DataFrame, keyframes: DataFrame, seconds: float = 1.0) -> DataFrame:
    """``video_id, shot_id, coverage`` of ``shots(video_id, shot_id, start_frame, end_frame, fps)``: frames are counted from the shot's start."""
    s = shots.select("video_id", "shot_id", "start_frame", "fps", (F.col("end_frame") - F.col("start_frame") + 1).alias("_total"), F.to_json(F.array("video_id", "shot_id")).alias("_shot"))
    at = keyframes.join(s.select("video_id", "shot_id", "_shot", "start_frame"), ["video_id", "shot_id"]).select("_shot", (F.col("frame_idx") - F.col("start_frame")).alias("_at"))
    got = coverage(at, s, "_shot", "_at", "_total", "fps", seconds)
    return s.join(got.select("_shot", "coverage"), "_shot").select("video_id", "shot_id", "coverage")


def statistics_row(pipeline: str, shots: DataFrame, keyframes: DataFrame, timing: DataFrame, quality: DataFrame | None = None, seconds: float = 1.0) -> DataFrame:
    """The report's row for each video, rounded half to even.

    ``shots(video_id, shot_id, start_frame, end_frame, fps)``, ``keyframes(video_id, shot_id,
    frame_idx, embedding)``, ``timing(video_id, seconds, frames, vram_gb, bytes)`` and, if
    there is a ground truth, ``quality(video_id, precision, recall, f1)``.  Coverage is the
    mean over the video's shots; a video without keyframes has no diversity.
    """
    n = shots.groupBy("video_id").agg(F.count("*").alias("_shots"))
    kf = keyframes.groupBy("video_id").agg(F.count("*").alias("_kf"))
    covered = shot_coverage(shots, keyframes, seconds).groupBy("video_id").agg(F.avg("coverage").alias("_coverage"))
    rows = n
    for other in (kf, covered, diversity(keyframes, "video_id", "embedding").select("video_id", F.col("diversity").alias("_diversity")), timing, quality):
        rows = rows if other is None else rows.join(other, "video_id", "left")
    value = lambda c, digits: F.bround(F.coalesce(c if not isinstance(c, str) else F.col(c), F.lit(0.0)).cast("double"), digits)
    truth = lambda c: value(c, 3) if quality is not None else F.lit(0.0)
    return rows.select(
        F.lit(pipeline).alias("Pipeline"), F.col("video_id").alias("Video"), F.coalesce("_kf", F.lit(0)).alias("#KF"), value(F.col("_kf") / F.greatest("_shots", F.lit(1)), 2).alias("KF/Shot"),
        value("seconds", 2).alias("Time(s)"), value(F.col("frames") / F.greatest("seconds", F.lit(1e-6)), 1).alias("FPS"), value("vram_gb", 2).alias("VRAM(GB)"), value(F.col("bytes") / (1 << 20), 2).alias("Storage(MB)"),
        value("_diversity", 3).alias("Diversity"), value("_coverage", 3).alias("Coverage"), truth("precision").alias("Precision"), truth("recall").alias("Recall"), truth("f1").alias("F1"),
    )


def share(hit: Column) -> Column:
    return F.avg(hit.cast("int"))
