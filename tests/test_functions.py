"""Column functions on hand-made rows."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shotline.functions import media as M
from shotline.functions import text as X
from shotline.functions import vectors as V
from shotline.plans.search import allowed_edits, damerau


def one(spark, *cols):
    r = tuple(spark.range(1).select(*cols).first())
    return r[0] if len(r) == 1 else r


def test_folding(spark):
    s = F.lit("Đường Chợ hoa tết đẹp ÑÜ")
    assert one(spark, X.strip_diacritics(s)) == "Duong Cho hoa tet dep NU"
    assert one(spark, X.unaccented(s)) == "đuong cho hoa tet đep nu"
    assert one(spark, X.norm(F.lit("Tết, 2024!"))) == "tet2024"


def test_lines(spark):
    assert one(spark, X.letter_count(F.lit("a b c")), X.is_allcaps(F.lit("HẾT 1")), X.is_allcaps(F.lit("Hết")), X.is_allcaps(F.lit("123"))) == (3, True, False, False)
    assert one(spark, X.merge_digit_words(F.lit("gia l00 dong"), F.lit("x 100 y"))) == "gia 100 dong"
    assert one(spark, X.merge_digit_words(F.lit("a b"), F.lit("1"))) == "a b"
    assert one(spark, X.prefer_short_line(F.lit("TIN"), F.lit("TÍN")), X.prefer_short_line(F.lit("Tin"), F.lit("TÍN"))) == ("TÍN", None)
    assert one(spark, X.numbered_lines(F.lit("1| a |\nx\n2) b\n1. c"))) == {1: "c", 2: "b"}
    assert one(spark, X.numbered_lines(F.lit("1|[CUT] a"), "[CUT] ")) == {1: "a"}
    assert one(spark, X.numbers_complete(X.numbered_lines(F.lit("1|a\n2|b")), F.lit(2))) is True
    assert one(spark, X.growth_guard(F.lit("abcd"), F.lit("abcdefghijk"), F.lit(True))) == "abcd"
    assert one(spark, X.outcome(F.lit(2), F.lit(0))) == "ok_2unmatched"
    assert one(spark, X.distinct_trimmed(F.array(*map(F.lit, (" a", "b", "a ", " "))))) == ["a", "b"]
    assert one(spark, X.arbitrate(F.lit("xx"), F.lit(0.2), F.lit("yy"), F.lit(0.9), 0.75))["text"] == "yy"
    assert one(spark, X.arbitrate(F.lit("xx"), F.lit(0.2), F.lit("yy"), F.lit(0.1), 0.75)) is None


def test_paths(spark):
    assert one(spark, X.frame_id(F.lit("/d/K01_V001/003.jpg")), X.frame_id(F.lit("/d/K01_V001/K01_V001_7.jpg"))) == ("K01_V001_003", "K01_V001_7")
    assert one(spark, *(X.valid_identifier(F.lit(v)) for v in ("a", "..", "a/b", " ", None))) == (True, False, False, False, False)
    assert one(spark, M.absolute_path("/data/", F.lit("a.jpg")), M.absolute_path("/data", F.lit("/x")), M.relative_path("/data", F.lit("/data/a"))) == ("/data/a.jpg", "/x", "a")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(["v1", "v2", "v10", "V9", "v02b", "10", "9", "a"]), min_size=1, max_size=8))
def test_natural_order(spark, names):
    import re

    key = lambda s: [(0, int(t), "") if t.isdigit() else (1, 0, t) for t in re.findall(r"\d+|\D+", s.lower())]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(X.natural_key(F.col("n")), "n").collect()]
    assert [key(g) for g in got] == sorted(map(key, names))


def test_times(spark):
    f = F.lit
    assert one(spark, M.served_ms(f(1520), f(25.0)), M.served_ms(f(1656), f(25.0)), M.mapped_ms(f(1655), f(25.0))) == (60800, 66240, 66200)
    assert one(spark, M.served_ms(f(5), f(2000.0))) == 2  # half to even
    assert one(spark, M.keyframe_ms(f(10), f(0.5)), M.seconds_ms(f(1.0005))) == (10000, 1000)
    assert one(spark, M.region(f(0.0), f(1.0)), M.region(f(0.5), f(-1.0))) == ("left-bottom", "center-top")
    assert one(spark, M.shot_id(f("K1"), f(7)), M.keyframe_id(f("K1_000007"), f(1)), M.normalised_shot_id(f("12"))) == ("K1_000007", "K1_000007_kf0001", "S0012")


def test_nested(spark):
    df = spark.createDataFrame([([("person", 0.92, [1.0]), ("car", 0.3, [2.0]), ("person", 0.95, None), ("dog", 0.1, None)],)], "o array<struct<label:string,confidence:double,bbox:array<double>>>")
    assert df.select(M.label_confidence(F.col("o"), 0.3)).first()[0] == {"person": 0.95, "car": 0.3}
    t = spark.createDataFrame([([("a", 0.3, [5, 0, 50, 9]), ("b", 0.29, [20, 0, 95, 9])],), ([],), ([("c", 1.0, None)],)], "t array<struct<text:string,confidence:double,box:array<int>>>")
    assert [tuple(r) for r in t.select(M.joined_text(F.col("t"), 0.3), M.truncated_mask(F.col("t"), F.lit(100))).collect()] == [("a", [True, True]), ("", None), ("c", None)]


def test_vectors(spark):
    a, b = F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(4.0), F.lit(3.0))
    assert math.isclose(one(spark, V.cosine(a, b)), 0.96)
    assert one(spark, V.cosine(a, F.array(F.lit(0.0), F.lit(0.0)))) is None
    assert one(spark, V.is_unit(a), V.is_unit(V.normalised(a)), V.hamming(F.lit(5), F.lit(6))) == (False, True, 2)
    x = np.arange(1024.0)
    got = spark.createDataFrame([(x.tolist(),), (x.tolist()[::-1],), ([1.0],)], "p array<double>").select(V.phash("p")).collect()
    assert got[2][0] is None and bin((got[0][0] ^ got[1][0]) & (1 << 64) - 1).count("1") > 8


def test_edit_distance():
    assert [damerau(*p) for p in (("ca", "abc"), ("ab", "ba"), ("", "abc"), ("same", "same"), ("abcd", "acbd"))] == [2, 1, 3, 0, 1]
    assert [allowed_edits("a" * n) for n in (2, 3, 5, 6)] == [0, 1, 1, 2]
