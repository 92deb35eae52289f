"""Operators against short definitions in plain Python, and their plans."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shotline.errors import IncompleteError, InputError, MissingRowsError, QualityError
from shotline.operators import metrics, relational as R, rules, sequence as S, timeline as T

FEW = settings(max_examples=12, deadline=None)
spans = st.lists(st.tuples(st.integers(0, 60), st.integers(0, 20)), min_size=1, max_size=8)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@FEW
@given(spans, spans)
def test_interval_join(spark, a, b):
    shots = [("v", f"s{i}", x, x + n) for i, (x, n) in enumerate(a)]
    segs = [("v", f"g{i}", x, x + n, f"t{i}") for i, (x, n) in enumerate(b)]
    want = sorted((s[1], g[1]) for s in shots for g in segs if g[2] <= s[3] and g[3] >= s[2])
    l = spark.createDataFrame(shots, "video_id string, shot_id string, start_ms long, end_ms long")
    r = spark.createDataFrame(segs, "video_id string, seg_id string, start_ms long, end_ms long, text string")
    got = T.interval_join(l, r, "video_id", bucket_ms=7)
    assert sorted((x["shot_id"], x["r_seg_id"]) for x in got.collect()) == want
    assert "CartesianProduct" not in plan(got) and "NestedLoop" not in plan(got)
    texts = {x["shot_id"]: x["text"] for x in T.transcripts(l, r).collect()}
    assert texts == {s[1]: " ".join(g[4] for g in sorted(segs, key=lambda g: (g[2], g[1])) if (s[1], g[1]) in want) for s in shots if any(w[0] == s[1] for w in want)}


@FEW
@given(spans, st.lists(st.integers(0, 90), min_size=1, max_size=10))
def test_asof(spark, a, at):
    starts = {x: (f"s{x}", x + n) for x, n in a}
    shots = spark.createDataFrame([("v", s, x, e) for x, (s, e) in starts.items()], "video_id string, shot_id string, start_frame long, end_frame long")
    frames = spark.createDataFrame([("v", x, i) for i, x in enumerate(at)], "video_id string, frame_idx long, n int")
    got = {r["n"]: r["shot_id"] for r in T.asof_shot(frames, shots).collect()}
    for i, x in enumerate(at):
        before = [k for k in starts if k <= x]
        assert got[i] == (starts[max(before)][0] if before and x <= starts[max(before)][1] else "")


@FEW
@given(st.lists(st.lists(st.integers(-3, 3), min_size=2, max_size=2), min_size=1, max_size=12), st.sampled_from([-1.0, 0.0, 2.0]))
def test_keep_last(spark, vs, threshold):
    df = spark.createDataFrame([("k", i, [float(x) for x in v]) for i, v in enumerate(vs)], "k string, i int, v array<double>")
    last, want = None, []
    for v in vs:
        s = -1.0 if last is None else float(np.dot(last, v))
        want.append((s, s < threshold))
        last = v if s < threshold else last
    # The first row has the similarity -1 and so is kept under any threshold above it.
    if threshold > -1:
        got = [(r["similarity"], r["kept"]) for r in S.keep_last(df, ["k"], ["i"], "v", threshold).orderBy("i").collect()]
        assert got == want


@FEW
@given(st.lists(st.integers(0, 9), min_size=1, max_size=30))
def test_candidates(spark, values):
    df = spark.createDataFrame([("v", i, float(x)) for i, x in enumerate(values)], "k string, i long, size double")
    steep = [0.0] + [abs(b - a) / max(a, 1) for a, b in zip(values, values[1:])]
    smooth = [float(np.mean(steep[max(0, i - 1) : i + 2])) for i in range(len(steep))]
    k = max(1, int(len(values) * 0.2))
    s = df.withColumn("s", S.steepness("size", ["k"], ["i"])).withColumn("m", F.round(S.moving_average(F.col("s"), ["k"], ["i"]), 9))
    best = sorted(range(len(values)), key=lambda i: (round(smooth[i], 9), i), reverse=True)[:k]
    got = S.candidates(s, ["k"], "i", "m", 0.2)
    assert plan(got).count("Exchange hashpartitioning") == 1
    assert sorted(r["i"] for r in got.collect()) == sorted({0, *best})


def test_reuse_and_runs(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 3), ("a", 3, 255 << 8), ("a", 4, 0)], "k string, i long, h long")
    assert [r["anchor"] for r in S.reuse_similar(df, ["k"], ["i"], "h", 2).orderBy("i").collect()] == [1, 1, 3, 4]
    df = spark.createDataFrame([("a", 1, ["x"]), ("a", 2, ["x"]), ("a", 3, []), ("a", 4, []), ("a", 5, ["x"])], "k string, i long, t array<string>")
    assert [r["run"] for r in S.equal_runs(df, ["k"], ["i"], "t", F.size("t") > 0).orderBy("i").collect()] == [1, 1, 2, 3, 4]


def test_sessions_and_chunks(spark, rows):
    df = spark.createDataFrame([("v", 0, 10), ("v", 200, 300), ("v", 700, 800)], "k string, s long, e long")
    got = T.gap_sessions(df, "k", "s", "e", 300, 100)
    assert rows(got.select("start", "end", "n")) == [(-100, 400, 2), (600, 900, 1)]
    assert rows(T.limit_length(got.where("n = 2"), "k", 300).select("start", "end")) == [(-100, 200), (200, 400)]
    v = spark.createDataFrame([("v", 301), ("w", 0)], "k string, n long")
    assert rows(T.chunks(v, "k", "n")) == [("v", 0, 299), ("v", 300, 300)]


def test_filters(spark):
    df = spark.createDataFrame([("a", "v1"), ("b", "v2")], "keyframe_id string, video_id string")
    assert R.in_videos(df, []).count() == 2 and R.in_videos(df, ["v1"]).count() == 1
    assert R.in_frames(df, None).count() == 2 and R.in_frames(df, []).count() == 0 and R.in_frames(df, ["a", "z"]).count() == 1
    assert R.in_frames(df, ["a"] + [f"x{i}" for i in range(2000)]).count() == 1
    with pytest.raises(InputError):
        R.in_frames(df, ["x"] * 65_537)


def test_merges(spark, rows):
    old = spark.createDataFrame([(1, "a", {"x": 1.0}), (2, "b", {})], "id int, t string, m map<string,double>")
    new = spark.createDataFrame([(1, "", None), (2, None, {"y": 2.0}), (3, "c", None)], old.schema)
    assert [tuple(r) for r in R.enrich(old, new, "id", ["t", "m"]).orderBy("id").collect()] == [(1, "", {"x": 1.0}), (2, "b", {"y": 2.0})]
    pick = lambda df: rows(df.select("id", "t"))
    assert pick(R.insert_if_absent(old, new, "id")) == [(1, "a"), (2, "b"), (3, "c")]
    assert pick(R.upsert(old, new, "id")) == [(1, ""), (2, None), (3, "c")]
    assert pick(R.refresh(old, new.where("id = 2"), "id")) == [(1, "a"), (2, None)]
    twice = new.withColumn("o", F.lit(1)).union(new.withColumn("o", F.lit(2)).withColumn("t", F.lit("last")))
    assert R.enrich(old, twice, "id", ["t"], "o").count() == old.count()
    assert {r["t"] for r in R.upsert(old, twice, "id", "o").where("id in (1, 2, 3)").collect()} == {"last"}
    assert [r["t"] for r in R.insert_if_absent(old, twice, "id", "o").where("id = 3").collect()] == ["c"]
    assert pick(R.hydrate([2, 1, 9, 2], old, "id")) == [(1, "a"), (2, "b"), (2, "b")]
    assert [r["id"] for r in R.hydrate([2, 1, 9, 2], old, "id").collect()] == [2, 1, 2]
    with pytest.raises(MissingRowsError, match="3"):
        R.must_match(new, old, "id")
    with pytest.raises(MissingRowsError):
        R.must_meet(old, spark.createDataFrame([(7,)], "id int"), "id")
    with pytest.raises(IncompleteError):
        R.complete_or_raise(old, new, "id")
    assert R.complete_or_raise(old, new, "id", force=True) is old
    a = spark.createDataFrame([(0, "x"), (1, "y")], "p int, k string")
    assert R.same_sequence(a, a, "p", "k") and not R.same_sequence(a, a.limit(1), "p", "k")
    done, fresh = spark.createDataFrame([(1, "d")], "id int, r string"), spark.createDataFrame([(1, "f"), (2, "f")], "id int, r string")
    assert rows(R.resume(old.select("id"), done, fresh, "id", ["r"])) == [(1, "d"), (2, "f")]


def test_zip_lengths(spark):
    df = spark.createDataFrame([(["a"], [1.0, 2.0])], "i array<string>, v array<double>")
    with pytest.raises(Exception, match="differ in number"):
        df.select(R.positional_zip(F.col("i"), F.col("v"))).collect()


@FEW
@given(st.lists(st.integers(0, 30), max_size=6), st.integers(1, 31), st.sampled_from([0.2, 1.0, 2.0]))
def test_coverage(spark, at, total, seconds):
    kf = spark.createDataFrame([("v", x) for x in at if x < total], "v string, i long")
    videos = spark.createDataFrame([("v", total, 5.0)], "v string, n long, fps double")
    half = int(seconds * 5) // 2
    want = len({f for x in at if x < total for f in range(max(0, x - half), min(total - 1, x + half) + 1)})
    assert metrics.coverage(kf, videos, "v", "i", "n", "fps", seconds).first()["covered"] == want


def test_metrics(spark, rows):
    e = spark.createDataFrame([("a", 1, [1.0, 0.0]), ("a", 2, [0.0, 2.0]), ("b", 3, [1.0, 1.0])], "k string, i int, v array<double>")
    assert rows(metrics.diversity(e, "k", "v")) == [("a", 2, 1.0), ("b", 1, 1.0)]
    pr = metrics.precision_recall(e.where("k = 'a'"), e.where("i in (1, 3)"), "k", "i", "v", 0.8)
    assert rows(pr) == [("a", 0.5, 1.0, pytest.approx(2 / 3)), ("b", 0.0, 0.0, 0.0)]
    assert metrics.match_lines(["abc", "abd"], ["abd", "zzz"]) == {1: 0}
    assert metrics.match_lines(["a", "a"], ["a", "a"]) == {1: 1, 0: 0} and metrics.match_lines([], ["a"]) == metrics.match_lines([None], ["a"]) == {}
    lines = spark.createDataFrame([("f", "Chợ hoa"), ("f", "abc"), ("f", "không")], "k string, line string")
    assert rows(metrics.line_recall(lines, spark.createDataFrame([("f", "cho  HOA tet")], "k string, text string"), "k")) == [("f", 1, 2)]


def test_rules(spark, rows):
    ocr = spark.createDataFrame([("f1", [("a", 0.5, [0, 0, 5, 5])]), ("", [(" ", 1.5, [5, 0, 0, 5])]), ("f3", None)], "frame_id string, texts array<struct<text:string,confidence:double,box:array<int>>>")
    bad = rules.violations(ocr, "frame_id", rules.ocr_rules())
    assert rows(bad) == [("", "box"), ("", "confidence"), ("", "frame_id"), ("", "text"), ("f3", "box"), ("f3", "confidence"), ("f3", "text"), ("f3", "texts")]
    with pytest.raises(QualityError):
        rules.check(bad)
    e = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [float("nan"), 1.0]), ("c", [3.0])], "id string, embedding array<float>")
    assert rows(rules.violations(e, "id", rules.embedding_rules(2))) == [("b", "finite"), ("b", "unit_norm"), ("c", "dim"), ("c", "unit_norm")]
    r = spark.createDataFrame([("v", "k1", "hi", ["a", "a"]), ("v", "k2", " ", [])], "video_id string, keyframe_id string, caption string, corrected_ocr array<string>")
    assert rows(rules.violations(r, "keyframe_id", rules.recap_rules())) == [("k1", "corrected_ocr"), ("k2", "caption")]
    with pytest.raises(QualityError):
        rules.one_video(r.union(r.withColumn("video_id", F.lit("w"))))
    with pytest.raises(QualityError):
        rules.equal_counts(r, r.limit(1))


def test_precision_recall_of_many_pairs(spark, rows):
    """36 million pairs of a key, in parts: each vector for itself was too slow for that (some 36 microseconds a pair)."""
    import time

    import numpy as np

    r = np.random.default_rng(5)
    v = r.normal(size=(12_000, 24)).astype(np.float32)
    df = spark.createDataFrame([("k", i, x.tolist()) for i, x in enumerate(v)], "k string, i long, v array<float>").repartition(8).persist()
    df.count()
    u = v.astype(np.float64) / np.linalg.norm(v.astype(np.float64), axis=1)[:, None]
    near = np.round(u[::2] @ u[1::2].T, 9) >= 0.75
    p, q = near.any(axis=1).mean(), near.any(axis=0).mean()
    began, side = time.monotonic(), metrics.SIDE
    metrics.SIDE = 1_500
    try:
        got = rows(metrics.precision_recall(df.where("i % 2 = 0"), df.where("i % 2 = 1"), "k", "i", "v", 0.75))
    finally:
        metrics.SIDE = side
    assert 0.05 < p < 0.95 and got == [("k", pytest.approx(p), pytest.approx(q), pytest.approx(2 * p * q / (p + q)))]
    assert time.monotonic() - began < 60


def test_precision_recall_of_odd_vectors(spark, rows):
    odd = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [1.0]), (6, []), (7, [0.6, 0.8])]
    p = spark.createDataFrame([("a", *x) for x in odd] + [("n", 1, [float("nan"), 1.0]), ("n", 2, [0.0, 0.0])], "k string, i int, v array<double>")
    t = spark.createDataFrame([("a", 1, [0.0, 0.0]), ("a", 2, [0.6, 0.8]), ("a", 3, [1.0]), ("a", 4, [-1.0, 0.0]), ("n", 1, [0.0, 1.0])], "k string, i int, v array<double>")
    # Of a: 5 and 7 meet theirs, and 1 meets (0.6, 0.8) exactly at the threshold; of n: nothing is below what is no number.
    got = {r["k"]: (r["precision"], r["recall"]) for r in metrics.precision_recall(p, t, "k", "i", "v", 0.6).collect()}
    assert got == {"a": (pytest.approx(3 / 7), 0.5), "n": (0.5, 1.0)}
    just = metrics.precision_recall(p.where("k = 'a' and i = 1"), t.where("k = 'a' and i = 2"), "k", "i", "v", 0.600000001)
    assert rows(just) == [("a", 0.0, 0.0, 0.0)]


def test_equal_lines_are_not_compared(monkeypatch):
    """Of many lines only those are compared that have no equal slot; the pairs are those of the whole matrix."""
    import random

    r = random.Random(2)
    text = lambda: r.choice([None, "", "a", "ab", "abc", "abcd", "item 7 of 9", "item 7 of 9 and more", "x" * 210, "xy" * 120])
    for _ in range(4_000):
        a, b = ([text() for _ in range(r.randint(0, 5))] for _ in range(2))
        assert metrics.match_lines(a, b) == metrics.best_pairs(metrics.ratios(a, b)), (a, b)
    asked, ratios = [], metrics.ratios
    monkeypatch.setattr(metrics, "ratios", lambda a, b, *more: asked.append((a, b)) or ratios(a, b, *more))
    lines = [f"item {i} of 40" for i in range(40)]
    assert metrics.match_lines(["###", *lines[1:]], lines) == {i: i for i in range(1, 40)} and asked == [(["###"], lines[:1])]
