"""The batch stages."""

import pytest
from pyspark.sql import functions as F

from shotline.errors import InputError, MissingRowsError
from shotline.plans import hooks, stages


def test_keyframes(spark, rows):
    v = [[1.0, 0.0], [1.0, 0.1], [0.0, 1.0], [0.0, 1.0]]
    f = spark.createDataFrame([("v", "s", i, 10.0 * (1 + 9 * (i == 2)), v[i]) for i in range(4)], "video_id string, shot_id string, frame_idx bigint, size double, embedding array<double>")
    assert rows(stages.extract_keyframes(f).select("keyframe_id", "frame_idx", "timestamp_ms")) == [("s_kf0001", 0, 0), ("s_kf0002", 2, 80)]
    assert [r[0] for r in stages.steepest_frames(0.3)(f).orderBy("frame_idx").select("frame_idx").collect()] == [0, 3]
    by_path = lambda df: df.drop("embedding").join(hooks.embed(df.select(F.col("frame_idx").cast("string").alias("keyframe_id"), F.lit("/x").alias("image_path")), lambda: hooks.FakeEmbedder(4)).withColumn("frame_idx", F.col("keyframe_id").cast("bigint")).drop("keyframe_id"), "frame_idx")
    assert stages.extract_keyframes(f, encode=by_path).count() == 1  # all frames have one path, so one vector
    good, bad = stages.playable(spark.createDataFrame([("a", 25.0), ("b", 0.0), ("c", None)], "video_id string, fps double"))
    assert (good.count(), bad.count()) == (1, 2)


def test_shared_requests(spark, rows):
    t = lambda *xs: [(x, 0.9) for x in xs]
    ocr = spark.createDataFrame([("v", "1", t("a")), ("v", "2", t("a")), ("v", "3", t()), ("v", "4", t()), ("v", "5", t("a"))], "video_id string, frame_id string, texts array<struct<text:string,confidence:double>>")
    runs, asked = stages.shared_requests(ocr)
    assert [r[0] for r in asked.orderBy("frame_id").select("frame_id").collect()] == ["1", "3", "4", "5"]
    got = stages.share_results(runs, asked.withColumn("fixed", F.concat(F.lit("r"), "frame_id")))
    assert rows(got.select("frame_id", "fixed")) == [("1", "r1"), ("2", "r1"), ("3", "r3"), ("4", "r4"), ("5", "r5")]


def test_corrections(spark):
    cases = [
        (["cho hoa", "tet"], [False, False], "1|chợ hoa\n2|tết", ["chợ hoa", "tết"], "ok"),
        # Numbers swapped: the lines are placed by what they say.
        (["cho hoa", "tet den roi"], None, "1|tết đến rồi\n2|chợ hoa", ["chợ hoa", "tết đến rồi"], "ok"),
        # A number missing, one too many, or one without a text: all lines stay raw.
        (["cho hoa", "tet"], None, "1|chợ hoa", ["cho hoa", "tet"], "bad_format"),
        (["cho hoa"], None, "1|chợ hoa\n2|tết", ["cho hoa"], "bad_format"),
        (["cho hoa", "tet"], None, "1|\n2|tết", ["cho hoa", "tet"], "bad_format"),
        (["a"], None, "nothing", ["a"], "bad_format"),
        (["a"], None, None, ["a"], "bad_format"),
        (["a"], None, "1|b\n99999999999|c", ["a"], "bad_format"),
        # A line that is like no slot leaves the slot raw.
        (["cho hoa", "tet"], None, "1|chợ hoa\n2|QWXZ", ["chợ hoa", "tet"], "ok_1unmatched"),
        # A cut-off line that grew is put back, and counted as such and as without a match; one that did not grow is neither.
        (["cho hoa", "tet den"], [False, True], "1|chợ hoa\n2|tết đến rồi mọi", ["chợ hoa", "tet den"], "ok_1unmatched_1trunc"),
        (["cho hoa", "tet den"], [False, True], "1|chợ hoa\n2|[CẮT] tết đến", ["chợ hoa", "tết đến"], "ok"),
        (["cho hoa", "tet den"], [False, False], "1|chợ hoa\n2|tết đến rồi mọi", ["chợ hoa", "tết đến rồi mọi"], "ok"),
        (["x", "x"], None, "2|x\n1|x\n1|x", ["x", "x"], "ok"),
        ([], [], "1|x", [], "empty_input"),
    ]
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "id int, raw array<string>, truncated array<boolean>, reply string")
    got = {r["id"]: (r["lines"], r["outcome"]) for r in stages.apply_correction(df).collect()}
    for i, c in enumerate(cases):
        assert got[i] == (c[3], c[4]), c


def test_captions(spark, rows):
    k = spark.createDataFrame([("v", "k1"), ("v", "k2")], "video_id string, keyframe_id string")
    done = spark.createDataFrame([("k1", "old")], "keyframe_id string, caption string")
    got = stages.resume_captions(k, done, lambda df: hooks.caption(df, hooks.FakeCaptioner))
    assert rows(got.select("keyframe_id", "caption")) == [("k1", "old"), ("k2", "a picture of k2")]
    ocr = spark.createDataFrame([("k1", ["x"])], "frame_id string, texts array<string>")
    assert stages.with_hints(k, ocr, None).where("ocr_hints is not null").count() == 1
    with pytest.raises(MissingRowsError):
        stages.with_hints(k, ocr.withColumn("frame_id", F.lit("zz")), None)


def test_bands_are_kept(spark):
    import numpy as np

    r = np.random.default_rng(0)
    rows = [[1.0] * 72 + [9.0] * 28, [1.0] * 100, [9.0] * 12 + [1.0] * 60 + [9.0] * 28, [9.0] * 12 + [1.0] * 88, [5.0], [], *(list(r.choice([1.0, 4.0], p=[0.7, 0.3]) * r.random(n)) for n in (2, 3, 9, 50, 101))]

    def want(e):
        h = len(e)
        if not h:
            return None
        top, low = max(1, int(h * 0.12)), min(h - 1, int(h * (1.0 - 0.28)))
        mean = lambda x: np.mean(x) if len(x) else np.nan
        mid = mean(e[top:low]) + 1e-6
        got = [b for b, part in (((0, top - 1), e[:top]), ((low, h - 1), e[low:])) if mean(part) / mid >= 2.0]
        return got or [(0, h - 1)]

    df = spark.createDataFrame([(i, [float(x) for x in e]) for i, e in enumerate(rows)], "i int, e array<double>")
    got = {x["i"]: x["b"] and [tuple(b) for b in x["b"]] for x in df.select("i", stages.news_bands(F.col("e")).alias("b")).collect()}
    assert got[0] == [(72, 99)] and got[1] == [(0, 99)] and got[2] == [(0, 11), (72, 99)] and got[3] == [(0, 11)]
    assert got == {i: want(e) for i, e in enumerate(rows)}


def test_policies(spark):
    assert [stages.write_policy(*a) for a in ((False, False, False), (True, True, False), (True, False, True))] == ["create", "resume", "overwrite"]
    for a in ((True, False, False), (False, True, True)):
        with pytest.raises(InputError):
            stages.write_policy(*a)
    assert [r[0] for r in spark.createDataFrame([(1.0, 99.0), (20.0, 10.0), (20.0, 60.0)], "l double, s double").select(stages.skip_reasons(F.col("l"), F.col("s"))).collect()] == ["blank", "blurry", None]
