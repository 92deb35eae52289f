"""Sources and sinks as round trips, the ingest, the read service, hooks and streams."""

import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from shotline import schemas
from shotline.errors import InputError, QualityError, StoreNotReadyError, TargetExistsError, TransientBackendError
from shotline.plans import hooks, ingest, search
from shotline.sources import readers as I
from shotline.sources import writers as O
from shotline.streaming import twins


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_json_scans(spark, tmp_path, rows):
    recs = [{"video_id": "v", "seg_id": f"v_{i}", "start_ms": i, "end_ms": i + 1, "text": "lời thoại"} for i in range(2)]
    lines = put(tmp_path / "a.jsonl", "\n".join(map(json.dumps, recs)))
    want = [("v", "v_0", 0, 1, "lời thoại"), ("v", "v_1", 1, 2, "lời thoại")]
    assert rows(I.jsonl(spark, lines, schemas.SEGMENTS)) == want
    assert I.jsonl(spark, str(tmp_path / "none"), schemas.SEGMENTS, optional=True).count() == 0
    array = put(tmp_path / "b.json", json.dumps(recs))
    assert rows(I.json_array(spark, array, schemas.SEGMENTS)) == want
    assert rows(I.json_any(spark, [str(tmp_path / "no"), array], schemas.SEGMENTS)) == rows(I.json_any(spark, [lines], schemas.SEGMENTS)) == want
    broken = put(tmp_path / "c.json", "{oops")
    assert I.json_array(spark, broken, schemas.SEGMENTS, tolerant=True).count() == 0
    with pytest.raises(Exception, match="not an array"):
        I.json_array(spark, broken, schemas.SEGMENTS).collect()
    with pytest.raises(InputError):
        I.json_any(spark, [str(tmp_path / "no")], schemas.SEGMENTS)
    log = put(tmp_path / "d.jsonl", json.dumps(recs[0]) + "\n\n" + json.dumps(recs[0]) + "\n")
    assert rows(I.done_keys(spark, log, "video_id")) == [("v",)]
    assert rows(I.strict_jsonl(spark, lines, schemas.SEGMENTS, set(recs[0]))) == want
    for bad in (json.dumps(recs[0]) + "\n\n" + json.dumps(recs[1]), json.dumps(recs[0] | {"x": 1}), json.dumps(recs[0] | {"start_ms": "x"})):
        with pytest.raises(QualityError, match=f"bad record in e.jsonl, line {2 if chr(10) in bad else 1}:"):
            I.strict_jsonl(spark, put(tmp_path / "e.jsonl", bad), schemas.SEGMENTS, set(recs[0])).collect()
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "k string, n int, v string")
    assert rows(I.last_by_key(df, "k", "n")) == [("a", 2, "y")]
    assert rows(I.shots(spark, [put(tmp_path / "s.json", '[{"video_id": "v", "shot_id": "3", "start_frame": 0, "end_frame": 9}]')]).select("shot_id", "fps")) == [("S0003", 25.0)]


def test_other_scans(spark, tmp_path, rows):
    put(tmp_path / "m/K01_V001.csv", "n,pts_time,fps,frame_idx\n1,0.0,25.0,0\n2,3.6,25.0,90\n")
    assert rows(I.csv(spark, str(tmp_path / "m"), schemas.MAP_KEYFRAMES, "video_id").select("video_id", "n", "frame_idx")) == [("K01_V001", 1, 0), ("K01_V001", 2, 90)]
    (tmp_path / "e").mkdir()
    np.save(tmp_path / "e/v.npy", np.eye(2, 4, dtype=np.float32))
    put(tmp_path / "e/v_ids.json", '["a", "b"]')
    assert rows(I.matrices(spark, str(tmp_path / "e"), 4).select("name", "pos", "id", "embedding")) == [("v", 0, "a", [1.0, 0.0, 0.0, 0.0]), ("v", 1, "b", [0.0, 1.0, 0.0, 0.0])]
    put(tmp_path / "e/v_ids.json", '["a"]')
    with pytest.raises(Exception, match="differ in number"):
        I.matrices(spark, str(tmp_path / "e")).collect()
    (tmp_path / "e/v_ids.json").unlink()
    put(tmp_path / "e/w_ids.json", "[]")
    with pytest.raises(QualityError):
        I.matrices(spark, str(tmp_path / "e"))
    for v in ("K01_V010", "K01_V002", "other"):
        put(tmp_path / f"d/keyframes/{v}/001.jpg", "x")
    assert [r[0] for r in I.datasets(spark, str(tmp_path / "d")).collect()] == ["K01_V002", "K01_V010"]
    assert [r[0] for r in I.images(spark, str(tmp_path / "d")).collect()] == ["K01_V002_001", "K01_V010_001", "other_001"]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("K01_V001/7.png", "x")
    assert [r[0] for r in I.images_or_zip(spark, str(tmp_path / "z.zip"), str(tmp_path / "un")).collect()] == ["K01_V001_7"]
    put(tmp_path / "videos/a.mp4", "x")
    put(tmp_path / "videos/b.txt", "x")
    assert rows(I.videos(spark, str(tmp_path / "videos")).select("video_id")) == [("a",)]
    with pytest.raises(InputError):
        I.images_or_zip(spark, str(tmp_path / "videos"), "")


def test_config():
    assert I.Config.load({"top_k": 0, "root": None}, {"SHOTLINE_RATIO": "0.5"}) == I.Config(top_k=0, ratio=0.5)
    assert I.Config.dotenv("# c\nexport A='1'\n\nB=2=3") == {"A": "1", "B": "2=3"}
    with pytest.raises(InputError):
        I.Config.load({"x": 1})


def test_sinks(spark, tmp_path, rows):
    df = spark.createDataFrame([("v1", "a", None), ("v2", "b", "bad")], "video_id string, keyframe_id string, error string")
    t = lambda n: str(tmp_path / n)
    O.append_then_mark(df.drop("error"), t("log"), t("done"), "video_id")
    assert rows(I.markers(spark, t("done"))) == [("v1",), ("v2",)]
    O.drop_keys(spark, t("log"), t("done"), "video_id string, keyframe_id string", "video_id", ["v1"])
    assert rows(I.markers(spark, t("done"))) == [("v2",)] and spark.read.json(t("log")).count() == 1
    assert O.split_failures(df, t("good"), t("bad")) == 1 and I.exists(spark, t("bad"))
    assert O.split_failures(df.where("error is null"), t("good"), t("bad")) == 0 and not I.exists(spark, t("bad"))
    with pytest.raises(TargetExistsError):
        O.preflight(spark, [t("good"), t("new")], False)
    O.preflight(spark, [t("good")], True)
    O.replace(df, t("p"))
    O.replace(spark.read.parquet(t("p")).where("video_id = 'v1'"), t("p"))
    assert spark.read.parquet(t("p")).count() == 1
    vec = spark.createDataFrame([("m", "v1", "a", [1.0]), ("m", "v2", "b", [2.0])], "model string, video_id string, frame_id string, embedding array<float>")
    O.vectors(vec, t("vec"))
    O.vectors(vec.where("video_id = 'v2'").withColumn("frame_id", F.lit("c")), t("vec"))
    assert rows(spark.read.parquet(t("vec")).select("frame_id")) == [("a",), ("c",)]
    O.csv(df, t("csv"))
    O.csv(df, t("csv"))
    assert spark.read.option("header", True).csv(t("csv")).count() == 4
    O.per_key(df, t("per"))
    assert I.exists(spark, t("per/video_id=v1"))
    O.report(df, t("rep"), "worst")
    assert spark.read.text(t("rep")).first()[0] == "worst"
    assert O.bytes_stored(spark.createDataFrame([(bytearray(b"abc"),)], "content binary")) == 3


def test_replace_never_loses_the_table(spark, tmp_path, monkeypatch):
    path, one, two = str(tmp_path / "t"), spark.range(1), spark.range(2)
    O.replace(one, path)
    real, calls = O._rename, []

    def failing(at):
        def rename(fs, a, b):
            calls.append((str(a), str(b)))
            if len(calls) == at:
                raise OSError("gone")
            real(fs, a, b)

        return rename

    for at in (1, 2):  # the old table stays, or comes back
        calls.clear()
        monkeypatch.setattr(O, "_rename", failing(at))
        with pytest.raises(OSError):
            O.replace(two, path)
        assert spark.read.parquet(path).count() == 1
    calls.clear()
    monkeypatch.setattr(O, "_rename", lambda fs, a, b: calls.append(1) or (real(fs, a, b) if len(calls) == 1 else (_ for _ in ()).throw(KeyboardInterrupt())))
    with pytest.raises(KeyboardInterrupt):  # the program ends between the two steps, and cannot put the old one back
        O.replace(two, path)
    monkeypatch.setattr(O, "_rename", real)
    assert not I.exists(spark, path)
    store = O.Store(spark, str(tmp_path))
    assert store.has("t") and store.read("t").count() == 1
    O.replace(two, path)
    assert spark.read.parquet(path).count() == 2


def test_merges_touch_only_their_folders(spark, tmp_path, rows):
    import os

    store = O.Store(spark, str(tmp_path), ["frames"])
    d = lambda *r: spark.createDataFrame(r, "video_id string, keyframe_id string, x string")
    store.upsert("frames", d(*((f"v{i}", f"v{i}_1", "a") for i in range(40)), ("v1", "v1_1", "a")), "keyframe_id")
    stamp = lambda: {os.path.join(p, f): os.stat(os.path.join(p, f)).st_mtime_ns for p, _, fs in os.walk(tmp_path / "frames") for f in fs if f.endswith(".parquet")}
    before = stamp()
    store.upsert("frames", d(("v7", "v7_1", "b"), ("v7", "v7_2", "b"), ("v7", "v7_2", "c")), "keyframe_id")
    store.enrich("frames", d(("v7", "v7_1", "z"), ("v7", "v7_1", "y")), "keyframe_id", ["x"])
    store.insert_if_absent("frames", d(("v7", "v7_1", "no"), ("v7", "v7_3", "n")), "keyframe_id")
    assert len(set(before) - set(stamp())) == 1  # one folder's file is another
    assert store.read("frames").columns == ["video_id", "keyframe_id", "x"]
    assert rows(store.read("frames").where("video_id = 'v7'").select("keyframe_id", "x")) == [("v7_1", "z"), ("v7_2", "c"), ("v7_3", "n")]
    assert store.read("frames").count() == 42
    store.purge("v7", ["frames"])
    assert store.read("frames").count() == 39
    for i in range(40):
        store.purge(f"v{i}", ["frames"])
    assert store.read("frames").count() == 0 and store.read("frames").columns == ["video_id", "keyframe_id", "x"]
    store.upsert("frames", d(("v", "v_1", "a")), "keyframe_id")
    assert store.read("frames").count() == 1


def test_pictures(spark, tmp_path):
    df = spark.createDataFrame([("v1", "a.jpg", bytearray(b"abc")), ("v2", "b.jpg", bytearray(b"defg")), ("v2", "c.jpg", None)], "video_id string, name string, content binary")
    assert O.images(df, str(tmp_path / "pics")) == 7 and (tmp_path / "pics/v2/b.jpg").read_bytes() == b"defg"
    (tmp_path / "file").write_text("x")
    assert O.csv(df.drop("content"), str(tmp_path / "file/sum"), str(tmp_path / "other")) == str(tmp_path / "other")


def world(spark, store):
    d = spark.createDataFrame
    texts = lambda t: [(t, 0.9, None), ("low", 0.1, None)]
    ingest.ingest(
        store,
        shots=d([("v001", "v001_000000", 1500, 1655, 25.0), ("v001", "v001_000001", 0, 99, 25.0)], schemas.SHOTS_RAW),
        transcripts=d([("v001", "v001_000000", "lời thoại")], schemas.SHOT_TRANSCRIPTS),
        keyframes=d([("v001", "v001_000000", "v001_f0001", 1501, 60040, "a.jpg"), ("v001", "v001_000001", "v001_f0002", 5, 200, "b.jpg")], schemas.KEYFRAMES),
        segments=d([("v001", "s0", 0, 5000, "x"), ("v001", "s1", 4000, 9000, "y"), ("v001", "s2", 20000, 25000, "z"), ("v001", "s3", 0, 1, " ")], schemas.SEGMENTS),
        detections=d([("v001_f0001", [("person", 0.92, None), ("person", 0.5, None), ("car", 0.2, None)])], schemas.DETECTIONS),
        ocr=d([("v001_f0001", texts("chợ hoa tết"))], schemas.OCR),
        ocr_api=d([], schemas.OCR),
        recap=d([("v001", "v001_f0001", "một khu chợ", [])], schemas.RECAP),
        vectors={"beit3": d([("v001_f0001", [1.0, 0.0]), ("v001_f0002", [0.6, 0.8])], "id string, embedding array<float>")},
    )


def test_ingest_and_search(spark, tmp_path, rows):
    store = O.Store(spark, str(tmp_path))
    world(spark, store)
    world(spark, store)  # a second run changes nothing
    tables = {t: store.read(t) for t in search.TABLES}
    assert {t: df.count() for t, df in tables.items()} == {"frames": 2, "shots": 2, "transcript_segments": 3, "frame_text": 2, "vectors": 2}
    f = tables["frames"].where("keyframe_id = 'v001_f0001'").first()
    assert (f["objects"], f["ocr_text"], f["caption"], f["synced"]["elastic"], f["synced"]["milvus"]) == ({"person": 0.92}, "chợ hoa tết", "một khu chợ", True, True)
    assert tables["frame_text"].where("frame_id = 'v001_f0001'").select("object_tags", "transcript").first() == (["person"], "lời thoại")
    e = search.Engine(spark, tables, "/data")
    hit = e.search_vector("beit3", [1.0, 0.0], 5)
    assert hit.columns == list(search.HIT) and [r["keyframe_id"] for r in hit.collect()] == ["v001_f0001", "v001_f0002"]
    assert e.search_vector("beit3", [1.0, 0.0], video_ids=["other"]).count() == 0
    assert [e.search_vector("beit3", [1.0, 0.0], min_score=m).count() for m in (0.7, 1.5)] == [1, 0]
    with pytest.raises(InputError):
        e.search_vector("nope", [1.0])
    assert [r["keyframe_id"] for r in e.search_ocr("cho hoa").collect()] == ["v001_f0001"]
    assert [e.search_ocr("chợ hoa", frame_ids=ids).count() for ids in (["v001_f0001", "zz"], ["zz"], [], None)] == [1, 0, 0, 1]
    assert e.search_ocr("chợ hoa", video_ids=["v001"], frame_ids=["zz"]).count() == 0
    score = e.search_asr("thoại").first()["score"]
    assert [e.search_asr("thoại", min_score=score + d).count() for d in (-0.01, 0.01)] == [1, 0]
    assert e.search_ocr("hoat").count() == 1 and e.search_ocr("hoat", fuzzy=False).count() == 0
    assert e.search_all("khu").count() == e.search_all("thoại").count() == 1
    assert [e.search_object(["person"], min_score=m).count() for m in (0.9, 0.95)] == [1, 0]
    assert e.search_object(["car"]).count() == 0 and e.search_object(["person", "dog"]).first()["score"] == 0.92
    got = e.get_frames(["v001_f0002", "v001_f0001", "zz", "v001_f0002"]).collect()
    assert [(r["keyframe_id"], r["image_path"]) for r in got] == [("v001_f0002", "/data/b.jpg"), ("v001_f0001", "/data/a.jpg"), ("v001_f0002", "/data/b.jpg")]
    assert [(r["start_ms"], r["transcript"]) for r in e.get_shots("v001").collect()] == [(0, ""), (60000, "lời thoại")]
    assert [r["seg_id"] for r in e.get_transcript("v001", 3000, 6000).collect()] == ["s0", "s1"]
    assert search.fuse({"a": hit, "b": e.search_ocr("hoa")}).orderBy(F.desc("score")).first()["keyframe_id"] == "v001_f0001"
    with pytest.raises(StoreNotReadyError, match="vectors"):
        search.Engine(spark, {k: v for k, v in tables.items() if k != "vectors"})
    store.mark_step("v001", "ocr", "done", 315)
    store.mark_step("v001", "asr", "done")
    steps = store.read("ingest_status").first()["steps"]
    assert (steps["ocr"]["status"], steps["ocr"]["count"], steps["asr"]["count"]) == ("done", 315, None)
    store.purge("v001", search.TABLES)
    assert store.read("frames").count() == 0
    store.create("frames", schemas.FRAMES)
    store.drop("frames")
    assert not store.has("frames")


def test_map_frames(spark, rows):
    m = spark.createDataFrame([("v", 1, 0.0, 25.0, 0), ("v", 2, 3.6004, 25.0, 90)], "video_id string, n int, pts_time double, fps double, frame_idx bigint")
    shots = spark.createDataFrame([("v", "v_0", 10, 95)], "video_id string, shot_id string, start_frame bigint, end_frame bigint")
    assert rows(ingest.map_frames(m, shots).select("keyframe_id", "shot_id", "timestamp_ms")) == [("v_001", "", 0), ("v_002", "v_0", 3600)]


def test_hooks(spark):
    class Flaky:  # local, so that it travels to the workers by value
        def caption(self, requests):
            if any(r["keyframe_id"] == "k3" for r in requests):
                raise TransientBackendError("busy")
            return ["ok"] * len(requests)

    f = spark.createDataFrame([("v", f"k{i}", f"/{i}.jpg") for i in range(5)], "video_id string, keyframe_id string, image_path string")
    e = hooks.embed(f, lambda: hooks.FakeEmbedder(8), 2).collect()
    assert len(e) == 5 and all(abs(np.linalg.norm(r["embedding"]) - 1) < 1e-5 for r in e)
    c = {r["keyframe_id"]: (r["caption"], r["error"]) for r in hooks.caption(f, Flaky, 1).collect()}
    assert c["k3"] == (None, "busy") and c["k1"] == ("ok", None)
    assert hooks.caption(f, hooks.FakeCaptioner).where("error is null").count() == 5


def test_streams(spark, tmp_path, rows):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    schema = "k string, i long, at timestamp, v array<double>"
    first = spark.createDataFrame([("a", 1, "2024-01-01 00:00:00", [1.0, 0.0]), ("a", 2, "2024-01-01 00:00:01", [0.99, 0.0])], "k string, i long, at string, v array<double>")
    first.coalesce(1).write.mode("append").json(src)
    run = lambda: twins.drain(twins.keep_last(twins.files(spark, src, schema), "k", "i", "v", 0.9), out, ck)
    run()
    spark.createDataFrame([("a", 3, "2024-01-01 01:00:00", [0.0, 1.0]), ("a", 4, "2024-01-01 01:00:01", [0.0, 0.95])], "k string, i long, at string, v array<double>").coalesce(1).write.mode("append").json(src)
    run()
    assert rows(spark.read.parquet(out)) == [("a", 1), ("a", 3)] and twins.finished(spark, ck)
    twins.each_batch_once(twins.files(spark, src, schema, 1), str(tmp_path / "once"), str(tmp_path / "ck2"))
    assert spark.read.option("basePath", str(tmp_path / "once")).parquet(str(tmp_path / "once")).count() == 4
    s = twins.sessions(twins.files(spark, src, schema), "k", "at", "10 minutes", "1 minute")
    twins.drain(s, str(tmp_path / "s"), str(tmp_path / "ck3"))
    assert rows(spark.read.parquet(str(tmp_path / "s")).select("k", "n")) == [("a", 2)]
