"""Indexes give what a scan gives, and read only what they need."""

import os
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shotline.errors import InputError, StoreNotReadyError
from shotline.functions import text as X
from shotline.plans import ingest, search
from shotline.plans.index import TextIndex, VectorIndex, counted
from shotline.sources import writers as O
from test_engine import world

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no generated tables")


def test_words_are_counted(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate([["b", "a", "b", "c", "b"], ["x"], [], None, ["a"] * 300])], "i int, w array<string>")
    got = {r["i"]: r["c"] and {x["term"]: x["tf"] for x in r["c"]} for r in df.select("i", counted(F.col("w")).alias("c")).collect()}
    assert got == {0: {"a": 1, "b": 3, "c": 1}, 1: {"x": 1}, 2: None, 3: None, 4: {"a": 300}}


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    head = F.split_part("text", F.lit("\n"), F.lit(1))
    scan = search.TextSearch(docs, "doc_id", {"text": F.col("text"), "head": head})
    return scan, TextIndex.build(scan, str(tmp_path_factory.mktemp("index")))


@pytest.mark.parametrize("query", ["elle einung", "the and of the", "Reerha thore", "nothingofthekind", "...", "de la Élle"])
@pytest.mark.parametrize("more", [{}, {"fields": ["text"]}, {"fuzzy": True}, {"min_score": 0.5}, {"top_k": 3}, {"where": "source = 'src1'"}])
def test_index_is_scan(both, query, more):
    scan, index = both
    more = {k: F.expr(v) if k == "where" else v for k, v in more.items()}
    a, b = ([(r["doc_id"], r["lang"], r["score"]) for r in x.search(query, **{"top_k": 200, **more}).collect()] for x in (scan, index))
    assert a == b


def test_postings_hold_everything(both):
    scan, index = both
    rows = scan.docs.select("doc_id", X.tokens(F.coalesce("text", F.lit(""))).alias("t")).collect()
    want = {(r["doc_id"], w): (n, len(r["t"])) for r in rows for w, n in Counter(r["t"]).items()}
    assert {(r["key"], r["term"]): (r["tf"], r["length"]) for r in index.postings("text").collect()} == want
    df = Counter(w for _, w in want)
    assert {r["term"]: r["df"] for r in index.terms("text").collect()} == df
    n, mean = index.stats["text"]
    assert n == len(rows) and mean == pytest.approx(np.mean([len(r["t"]) for r in rows]))


def test_only_the_words_buckets_are_read(both):
    _, index = both
    p = index._of(index.postings("text"), ["elle"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*bucket#\d+ (IN|=|INSET)", p) and re.search(r"PushedFilters: \[.*(EqualTo\(term,elle\)|In\(term, \[elle\]\))", p) and "Exchange" not in p
    whole = index.search("elle")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in whole and "pythonUDF" not in whole
    with pytest.raises(InputError):
        index.search("x", 0)
    with pytest.raises(StoreNotReadyError):
        TextIndex(index.spark, index.path + "/none", index.docs)


def test_engine_with_indexes(spark, tmp_path):
    store = O.Store(spark, str(tmp_path))
    world(spark, store)
    tables = {t: store.read(t) for t in search.TABLES}
    plain, quick = search.Engine(spark, tables), search.Engine(spark, tables, indexes={**ingest.index_texts(store), **ingest.index_vectors(store, ["beit3"])})
    calls = [lambda e: e.search_ocr("chợ hoat"), lambda e: e.search_asr("thoại"), lambda e: e.search_all("khu lời"), lambda e: e.search_ocr("hoa", frame_ids=["zz"]), lambda e: e.search_ocr("hoa", video_ids=["v001"]), lambda e: e.search_vector("beit3", [1.0, 0.0], 5)]
    for call in calls:
        assert call(plain).collect() == call(quick).collect()


def test_vector_index_recall(spark, tmp_path):
    r = np.random.default_rng(4)
    centre = r.normal(size=(40, 24))
    x = (centre[r.integers(0, 40, 3000)] + 0.4 * r.normal(size=(3000, 24))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9000, None), (9001, [0.0] * 24)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    index = VectorIndex.build(table, str(tmp_path / "v"), "vec_id")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    hit = every = 0
    for q in range(0, 3000, 300):
        want = set(np.argsort(-(u @ u[q]))[:20].tolist())
        hit += len(want & {z["vec_id"] for z in index.search(x[q].tolist(), 20, key="vec_id").collect()})
        every += 20
    assert hit / every >= 0.9
    exact = search.vector_search(table, x[0].tolist(), 20, key="vec_id", digits=6).collect()
    assert exact == index.search(x[0].tolist(), 20, key="vec_id", digits=6, probes=10_000).select(*table.columns, "score").collect()
    p = index.search(x[0].tolist(), 20, key="vec_id")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*cell#\d+ IN", p)
    empty = VectorIndex.build(table.limit(0), str(tmp_path / "e"), "vec_id")
    assert empty.search([1.0], 5, key="vec_id").count() == 0


def test_postings_are_shuffled_in_blocks(both, tmp_path, monkeypatch):
    """A row for each folder and some thousand documents is shuffled, not one for each posting; many shares of a folder hold the same."""
    from shotline.plans import index as I

    scan, index = both
    words = scan.tokens.select(F.col("doc_id").alias("key"), F.col("_t_text").alias("words"))
    n, size = words.mapInArrow(I._postings, "bucket int, seed bigint, block binary").agg(F.count("*"), F.sum(F.length("block"))).first()
    postings = index.postings("text").count()
    assert n <= I.BUCKETS * words.rdd.getNumPartitions() and size < 16 * postings
    monkeypatch.setattr(I, "SHARE", 400)
    dealt = TextIndex.build(search.TextSearch(scan.docs.repartition(5), "doc_id", {"text": F.col("text")}), str(tmp_path / "dealt"))
    row = lambda r: tuple(r[c] for c in ("key", "term", "tf", "length"))
    assert sorted(map(row, dealt.postings("text").collect())) == sorted(map(row, index.postings("text").collect()))
    assert dealt.stats["text"] == index.stats["text"] and sorted(dealt.terms("text").collect()) == sorted(index.terms("text").collect())
