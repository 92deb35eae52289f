"""Model hooks with fake backends."""

import time

import pytest
from pyspark.sql import functions as F

from shotline.errors import InputError, QualityError
from shotline.operators import metrics, rules
from shotline.plans import hooks, stages
from shotline.streaming import twins


@pytest.fixture
def frames(spark):
    return spark.createDataFrame([("v", f"k{i}", f"/{i}.jpg") for i in range(4)], "video_id string, keyframe_id string, image_path string")


def test_overlapping_objects_go():
    box = lambda x, w=10.0: [x, 0.0, x + w, 10.0]
    found = [("a", 0.9, box(0)), ("a", 0.95, box(2)), ("b", 0.8, box(0)), ("a", 0.5, box(8)), ("a", 0.2, box(100)), ("a", 0.123456789, box(50))]
    got = hooks.suppressed(found, 0.1)
    assert [(x["label"], x["confidence"], x["bbox"][0]) for x in got] == [("a", 0.95, 2.0), ("b", 0.8, 0.0), ("a", 0.5, 8.0), ("a", 0.2, 100.0), ("a", 0.1235, 50.0)]
    assert [x["confidence"] for x in hooks.suppressed(found)] == [0.95, 0.8, 0.5]  # 0.25 at least
    assert len(hooks.suppressed([("a", 0.9, box(20.0 * i)) for i in range(400)])) == 300


def test_detection(frames):
    class Fake:
        def detect(self, path):
            if path == "/2.jpg":
                raise RuntimeError("broken picture")
            return [("car", 0.87654321, [0.04, 1, 2, 3]), ("car", 0.1, [5, 5, 6, 6])]

    got = {r["keyframe_id"]: (r["objects"], r["error"]) for r in hooks.detect(frames, Fake).collect()}
    assert got["k2"] == ([], "broken picture")
    assert [tuple(x) for x in got["k0"][0]] == [("car", 0.8765, [0.0, 1.0, 2.0, 3.0])] and got["k0"][1] is None


def test_recognition(frames):
    class Fake:
        def read(self, path):
            return (100, 50), [([1, 2, 98, 20], " chợ hoa ", 0.91234567, "cho hoa", 0.8), ([10, 10, 20, 20], "???", 0.2, " LOGO ", 0.7), ([5, 5, 9, 9], "x", 0.2, "y", 0.3), ([104, 0, 110, 9], "out", 0.9, "out", 0.9), ([0, 0, 9, 9], "", 0.9, "", 0.9)]

    r = hooks.recognise(frames, Fake, 0.5).where("keyframe_id = 'k1'").first()
    assert [tuple(x) for x in r["texts"]] == [("chợ hoa", 0.9123, [0, 0, 100, 23]), ("LOGO", 0.7, [7, 7, 23, 23])]
    assert [tuple(x) for x in r["origin"]] == [("cho hoa", 0.8, [0, 0, 100, 23]), ("LOGO", 0.7, [7, 7, 23, 23])]
    plain = hooks.recognise(frames, Fake, 0.5, ascii_only=True).first()
    assert plain["texts"][0]["text"] == "cho hoa"


def test_requests_are_repeated_and_end():
    class Fake:
        def __init__(self, *answers):
            self.answers, self.calls = list(answers), 0

        def send(self, path, prompt):
            self.calls += 1
            if path == "hang":
                time.sleep(3)
            return self.answers.pop(0)

    busy = Fake((429, ""), (429, ""), (200, "1|x"))
    assert hooks.request(busy, "p", "q", wait=0.0) == ("1|x", None) and busy.calls == 3
    assert hooks.request(Fake(*[(429, "")] * 9), "p", "q", wait=0.0) == (None, "http_429")
    assert hooks.request(Fake((500, "")), "p", "q") == (None, "http_500")
    began = time.perf_counter()
    assert hooks.request(Fake((200, "")), "hang", "q", limit=0.05) == (None, "hang_timeout") and time.perf_counter() - began < 2


def test_correction_hook(spark):
    class Fake:
        def send(self, path, prompt):
            if path == "down":
                return 503, ""
            if path == "raise":
                raise RuntimeError("no route")
            assert prompt in ("1|cho hoa\n2|[CẮT] tet", "")
            return 200, "1|chợ hoa\n2|tết"

    rows = [(p, ["cho hoa", "tet"], [False, True]) for p in ("ok", "down", "raise")] + [("none", [], None)]
    df = spark.createDataFrame(rows, "image_path string, raw array<string>, truncated array<boolean>")
    got = {r["image_path"]: (r["lines"], r["outcome"]) for r in hooks.correct(df, Fake, wait=0.0).collect()}
    assert got == {"ok": (["chợ hoa", "tết"], "ok"), "down": (["cho hoa", "tet"], "http_503"), "raise": (["cho hoa", "tet"], "no route"), "none": ([], "empty_input")}


def test_other_models(spark, frames, rows):
    class Fake:
        def read(self, path):
            return f"  {path} "

        def changes(self, path):
            return [0.0, 0.9, 0.1, 0.2, 0.8]

        def speech(self, path):
            return [(2000, 3000, " b "), (0, 1000, "a"), (5000, 6000, " ")]

        def audio(self, path, rate):
            return bytes([rate // 1000])

    assert rows(hooks.read_texts(frames, Fake).select("text"))[0] == ("/0.jpg",)
    v = spark.createDataFrame([("v", 25.0, "v.mp4")], "video_id string, fps double, path string")
    assert rows(hooks.find_shots(v, Fake)) == [("v", "v_000000", 0, 1, 25.0), ("v", "v_000001", 2, 4, 25.0)]
    assert rows(hooks.find_speech(v, Fake)) == [("v", "v_000000", 0, 1000, "a"), ("v", "v_000001", 2000, 3000, "b")]
    assert hooks.audio(v, Fake).first()["audio"] == bytearray([16])


def test_strategies_and_datasets(spark, frames):
    f = spark.createDataFrame([("v", "s", i, float(i == 30), [1.0, i / 50.0]) for i in range(50)], "video_id string, shot_id string, frame_idx bigint, size double, embedding array<double>")
    seen = []
    encoders = {n: lambda df, n=n: seen.append((n, df.count())) or df for n in ("beit3", "mobilenet")}
    for name in ("pipeline_a", "pipeline_b", "pipeline_c", "pipeline_d"):
        assert stages.strategy(name, encoders)(f).count() >= 1
    assert [n for n, _ in seen] == ["beit3", "mobilenet"] * 2 and seen[0][1] == 50 and seen[2][1] < 5
    for bad in (("pipeline_x", encoders), ("pipeline_b", {"beit3": None})):
        with pytest.raises(InputError):
            stages.strategy(*bad)
    out = stages.dataset(frames, lambda df: hooks.embed(df, lambda: hooks.FakeEmbedder(8)), lambda df: hooks.caption(df, hooks.FakeCaptioner))
    assert {k: d.count() for k, d in out.items()} == {"embeddings": 4, "captions": 4}
    done = spark.createDataFrame([("k1", "old")], "keyframe_id string, caption string")
    assert stages.dataset(frames, None, lambda df: hooks.caption(df, hooks.FakeCaptioner), done)["captions"].where("caption = 'old'").count() == 1
    with pytest.raises(InputError):
        stages.dataset(frames)


def test_a_failing_run_is_restarted():
    left = [3]

    def run():
        left[0] -= 1
        if left[0]:
            raise OSError("lost")

    assert twins.restarted(run, wait=0) == 3
    with pytest.raises(OSError):
        left[0] = 99
        twins.restarted(run, 4, 0)
    assert left[0] == 95


def test_coverage_counts_from_the_shot(spark):
    shots = spark.createDataFrame([("v", "a", 100, 109, 4.0), ("v", "b", 110, 119, 4.0)], "video_id string, shot_id string, start_frame bigint, end_frame bigint, fps double")
    kf = spark.createDataFrame([("v", "a", 100, [1.0, 0.0])], "video_id string, shot_id string, frame_idx bigint, embedding array<double>")
    assert {r["shot_id"]: r["coverage"] for r in metrics.shot_coverage(shots, kf).collect()} == {"a": 0.3, "b": 0.0}
    timing = spark.createDataFrame([("v", 2.0, 30, 1.234, 3 << 20)], "video_id string, seconds double, frames bigint, vram_gb double, bytes bigint")
    truth = spark.createDataFrame([("v", 0.5, 0.25, 1 / 3)], "video_id string, precision double, recall double, f1 double")
    row = metrics.statistics_row("p", shots, kf, timing, truth).first().asDict()
    assert row == {"Pipeline": "p", "Video": "v", "#KF": 1, "KF/Shot": 0.5, "Time(s)": 2.0, "FPS": 15.0, "VRAM(GB)": 1.23, "Storage(MB)": 3.0, "Diversity": 1.0, "Coverage": 0.15, "Precision": 0.5, "Recall": 0.25, "F1": 0.333}


def test_hints_and_pictures(spark, tmp_path):
    lines = ['{"frame_id": "a", "texts": [{"text": "x", "confidence": 1}, {"text": "x", "confidence": 1, "bbox": [1]}]}', '{"frame_id": "b", "texts": [{"text": "x"}]}', '{"frame_id": " ", "texts": []}', '{"frame_id": "d", "texts": [], "more": 1}', '{"frame_id": "e", "texts": 1}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    got = sorted((r["key"], r["rule"]) for r in rules.violations(df, "i", rules.hint_rules("texts", {"text", "confidence", "bbox"}, {"bbox"})).collect())
    assert got == [("1", "texts"), ("2", "frame_id"), ("3", "keys"), ("4", "texts")]
    (tmp_path / "a.jpg").write_bytes(b"x")
    (tmp_path / "b.jpg").write_bytes(b"")
    paths = spark.createDataFrame([(str(tmp_path / n),) for n in ("a.jpg", "b.jpg", "c.jpg")], "image_path string")
    assert [r[0] for r in rules.readable(paths).collect()] == [str(tmp_path / "a.jpg")]
    with pytest.raises(QualityError):
        rules.readable(paths.limit(0))
