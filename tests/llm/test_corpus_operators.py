"""The corpus operators against brute force, round trips and held-out rows, and on awkward rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from shotline.llm import decontaminate, html, langid, minhash, neighbours, packing, pii, quality, registry, sharding, urls
from shotline.llm.graph import components

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, n string, w string, id string"


def docs(spark, texts, source="s"):
    """Documents with extra columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, "en", source, None if t is None else len(t), "x", "y", "z", "q") for i, t in texts], DOC)


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def text(n, seed):
    return " ".join(words(n, seed))


def edited(n, seed, changes, offset=0):
    w = words(n, seed)
    for k in range(changes):
        w[(offset + k * 17) % n] = f"new{seed}-{offset}-{k}"
    return " ".join(w)


def find(par, x):
    while par[x] != x:
        x = par[x]
    return x


def classes(ids, links):
    par = {i: i for i in ids}
    for a, b in links:
        a, b = find(par, a), find(par, b)
        par[max(a, b)] = min(a, b)
    return {i: find(par, i) for i in ids}


# ---- graph --------------------------------------------------------------------------------------


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 15), st.integers(0, 15)), max_size=20))
def test_components(spark, edges):
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    want = classes(range(16), edges)
    assert got == {i: c for i, c in want.items() if any(i in e and e[0] != e[1] for e in edges)}


def test_components_of_hubs(spark, monkeypatch):
    monkeypatch.setattr("shotline.llm.common.HOT", 0.01)
    edges = [(7, i) for i in range(100, 400)] + [(399, 500), (500, 2), (600, 601), (601, 602)] + [(i, 1000 + i) for i in range(2000, 2100)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    nodes = {x for e in edges for x in e}
    assert got == {i: c for i, c in classes(sorted(nodes), edges).items()}


def test_components_of_a_path(spark):
    got = components(spark.createDataFrame([(i, i + 1) for i in range(60)], "a bigint, b bigint")).collect()
    assert {r["component"] for r in got} == {0} and len(got) == 61


# ---- 9: MinHash ---------------------------------------------------------------------------------


def shingles(t):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_links(rows, percent):
    s = {i: shingles(t) for i, t in rows}
    return s, [(a, b) for a in s for b in s if a < b and s[a] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b])]


@pytest.mark.parametrize("percent", [80, 85])
def test_minhash_is_brute_force(spark, percent):
    rows = [(i, text(80, i)) for i in range(10)]
    rows += [(100 + k, edited(80, k % 3, k % 4, k)) for k in range(60)]  # near copies, on either side of the threshold
    rows += [(200, None), (201, ""), (202, " \n"), (203, "a b"), (204, "A  b"), (205, "a b c"), (206, text(80, 1).upper()), (207, text(80, 2)), (208, text(80, 2)), (209, text(6000, 5)), (210, edited(6000, 5, 3))]
    s, links = near_links(rows, percent)
    want = classes(s, links)
    got = minhash.near_duplicates(docs(spark, rows + [(207, text(80, 2))]), percent).collect()  # a repeated row
    assert len(got) == len(rows) + 1
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {i: (len(s[i]), want[i], want[i] == i) for i in s}


def test_minhash_edges(spark):
    assert minhash.near_duplicates(docs(spark, [])).count() == 0
    got = minhash.near_duplicates(docs(spark, [(None, "a b c d e f"), (7, "a b c d e f")])).collect()
    assert sorted((repr(r["doc_id"]), r["component_id"], r["kept"]) for r in got) == [("7", 7, True), ("None", None, True)]


def test_mixed_bands_lose_no_link(spark):
    # Many near copies of one text, most pairs of which are just below the threshold.
    rows = [(i, edited(120, 3, 3 + i % 3, i % 40)) for i in range(150)]
    s, links = near_links(rows, 85)
    want = classes(s, links)
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs(spark, rows), 85).collect()} == want


def test_rare_shingles_shared_by_many_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(minhash, "STAR", 3)
    test_mixed_bands_lose_no_link(spark)


def test_signatures_estimate_similarity():
    bands, n = minhash.banding(85)
    c = minhash.Circulant(bands, n)
    r = np.random.default_rng(0)
    a = r.integers(0, 2**63, 600, dtype=np.uint64)
    same = [np.mean(c.signature(a[:500]) == c.signature(np.concatenate([a[k:500], a[500 : 500 + k]]))) for k in (0, 20, 50, 100)]
    want = [(500 - k) / (500 + k) for k in (0, 20, 50, 100)]
    assert same[0] == 1 and all(abs(x - y) < 0.16 for x, y in zip(same, want))


# ---- 4: decontamination -----------------------------------------------------------------------------


def weighted(a, b):
    a, b = (Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) for w in (a, b))
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def test_decontamination_is_brute_force(spark):
    items = {k: words(20 + 7 * k, 50 + k) for k in range(6)}
    items[6] = ["x"] * 30
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()] + [(7, None), (8, ""), (9, "  ")], "item_id bigint, text string")
    own = {i: words(150, 900 + i) for i in range(12)}
    for i in range(6):
        own[i][40:40] = items[i]
    own[6][10:10] = [w if k != 20 else "changed" for k, w in enumerate(items[5])]
    own[7][10:10] = [w if k % 9 else "changed" for k, w in enumerate(items[4])]
    own[8][10:10] = ["x"] * 29
    own[9] = items[3]
    rows = [(i, "  " + "\n ".join(w).upper()) for i, w in own.items()] + [(20, None), (21, ""), (22, "short")]
    best = defaultdict(float)
    for i, t in rows:
        w = (t or "").lower().split()
        for k, b in items.items():
            for s in range(max(1, len(w) - len(b) + 1)):
                x = weighted(w[s : s + len(b)], b) if w else 0
                if x >= 0.8:
                    best[i, k] = max(best[i, k], x)
    got = decontaminate.contaminated(docs(spark, rows), bench)
    assert {(r["doc_id"], r["item_id"]): pytest.approx(r["similarity"]) for r in got.collect()} == best
    assert {(i, k) for i, k in best} >= {(i, i) for i in range(6)} and (7, 4) not in best
    kept = decontaminate.remove(docs(spark, rows), bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({i for i, _ in rows} - {i for i, _ in best})
    assert decontaminate.contaminated(docs(spark, rows), bench.limit(0)).count() == decontaminate.contaminated(docs(spark, []), bench).count() == 0


def prints(spark, values, key):
    """Fingerprints given as numbers."""
    words_ = lambda x: [(w - (1 << 64) * (w >> 63)) for w in (x >> 64 * k & (1 << 64) - 1 for k in range(decontaminate.WORDS))]
    return spark.createDataFrame([(i, 20, *words_(x)) for i, x in enumerate(values)], f"{key} bigint, size int, " + ", ".join(f"fp{k} bigint" for k in range(decontaminate.WORDS)))


def test_blocks_find_what_is_near_and_little_else(spark, monkeypatch):
    r = random.Random(3)
    own, other = ([r.getrandbits(decontaminate.BITS) for _ in range(200)] for _ in range(2))
    w, i = prints(spark, own, "win"), prints(spark, other, "item_id")
    met = decontaminate.blocks(w, ["win"]).select("win", "key").join(decontaminate.blocks(i, ["item_id"]).select("item_id", "key"), "key").select("win", "item_id").distinct().count()
    assert met < 0.01 * 200 * 200 and decontaminate.candidates(w, i).count() == 0

    def flipped(x, n):
        for b in r.sample(range(decontaminate.BITS), n):
            x ^= 1 << b
        return x

    # All within 15 bits by the pigeonhole principle, whatever the bits; at the mean distance of the least similarity practically all.
    for n, partitions, least in ((15, 1, 200), (39, decontaminate.PARTITIONS, 200), (39, 1, 0)):
        monkeypatch.setattr(decontaminate, "PARTITIONS", partitions)
        got = decontaminate.candidates(w, prints(spark, [flipped(x, n) for x in own], "item_id")).where("win = item_id").count()
        assert got >= least and (least or got < 200)


def test_candidates_come_from_fingerprints_only(spark, monkeypatch):
    bench = spark.createDataFrame([(k, " ".join(words(60, 50 + k))) for k in range(30)], "item_id bigint, text string")
    rows = []
    for k in range(30):
        w = words(60, 50 + k)
        w[30] = "changed"
        rows.append((k, " ".join(words(20, 200 + k) + w + words(20, 300 + k))))
    assert decontaminate.contaminated(docs(spark, rows), bench).count() == 30
    monkeypatch.setattr(decontaminate, "PARTITIONS", 1)
    monkeypatch.setattr(decontaminate, "BLOCK", 64)
    assert decontaminate.contaminated(docs(spark, rows), bench).count() < 30  # four blocks of 64 bits lead to few


def test_fingerprints_are_majorities(spark):
    rows = spark.createDataFrame([(g, h) for g, hs in ((1, [5, -3, 7]), (2, [-1]), (3, [2**62, -(2**63), 1, 9])) for h in hs], "win bigint, h bigint")
    hashed = rows.select("win", F.array("h", *(F.xxhash64("h", F.lit(k)) for k in range(1, decontaminate.WORDS))).alias("x")).collect()
    for r in decontaminate.fingerprints(rows, ["win"]).collect():
        own = [x["x"] for x in hashed if x["win"] == r["win"]]
        for k in range(decontaminate.WORDS):
            assert all((r[f"fp{k}"] >> b & 1) == (2 * sum(x[k] >> b & 1 for x in own) > len(own)) for b in range(64))


def test_decontamination_of_rows_without_ids(spark):
    item = " ".join(words(30, 9))
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    d = docs(spark, [(None, "a " + item), (None, "a " + item), (None, "b " + item), (None, text(40, 3)), (4, item), (4, text(50, 4)), (5, "x " * 60_000 + item)])
    got = decontaminate.contaminated(d, bench).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["4", "5", "None", "None"] and {r["start"] for r in got} == {0, 1, 60_000}
    kept = decontaminate.remove(d, bench)
    assert kept.columns == d.columns and sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == [("4", text(50, 4)), ("None", text(40, 3))]


def test_decontamination_runs_no_python(spark):
    df = decontaminate.contaminated(docs(spark, [(1, "a b c d e f")]), spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string"))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString()) and df.count() == 1


# ---- 2: sharding ------------------------------------------------------------------------------------


def test_shards_are_even_in_rows_and_mixture(spark):
    rows = [(i, text(i % 40, i) if i % 50 else None, "en", None if i % 31 == 0 else f"s{i % 3 if i % 2 else 0}", 0, "", "", "", "") for i in range(2400)]
    df = spark.createDataFrame(rows + rows[:24], DOC)
    got = sharding.interleave(df).join(df.select("doc_id", "source").distinct(), "doc_id").collect()
    assert len(got) == 2424
    shards = defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r)
    assert sorted(shards) == list(range(24)) and {len(x) for x in shards.values()} == {101}
    assert all(sorted(r["slot"] for r in x) == list(range(101)) for x in shards.values())
    total = Counter(r["source"] for r in got)
    for x in shards.values():
        assert all(abs(n - total[s] / 24) <= 2 for s, n in Counter(r["source"] for r in x).items())
    by_id = {r[0]: r[1] for r in rows}
    assert all(r["size"] == len((by_id[r["doc_id"]] or "").encode()) + 8 and r["text_crc32"] == zlib.crc32((by_id[r["doc_id"]] or "").encode()) for r in got)
    again = sharding.interleave(df.repartition(3)).select("doc_id", "shard").distinct()
    assert sorted(map(tuple, again.collect())) == sorted({(r["doc_id"], r["shard"]) for r in got})
    assert sharding.interleave(df.limit(0)).count() == 0


def test_shards_of_many_small_sources(spark):
    sizes = {**{f"one{k}": 1 for k in range(4000)}, **{f"two{k}": 2 for k in range(700)}, **{f"odd{k}": k for k in range(3, 60)}, "large": 4000}
    rows = [s for s, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, source string").withColumn("text", F.lit("x"))
    got = sharding.interleave(df).join(df, "doc_id").select("shard", "source").collect()
    parts = defaultdict(Counter)
    for r in got:
        parts[r["shard"]][r["source"]] += 1
    kinds = {"one": 4000, "two": 1400, "odd": sum(range(3, 60)), "large": 4000}
    assert max(map(lambda p: sum(p.values()), parts.values())) - min(map(lambda p: sum(p.values()), parts.values())) <= 1
    for p in parts.values():
        assert all(abs(n - sizes[s] / 24) <= max(2, 0.05 * sizes[s] / 24) for s, n in p.items())
        for kind, n in kinds.items():
            here = sum(c for s, c in p.items() if s.startswith(kind))
            assert abs(here - n / 24) <= 0.1 * n / 24 + 2, kind


def test_shards_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 10)
    monkeypatch.setattr(sharding, "CELL_ROWS", 20)
    df = docs(spark, [(None, "same")] * 700 + [(7, "same")] * 205 + [(None, None)] * 40)
    got = sharding.interleave(df).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert Counter((r["doc_id"], r["size"]) for r in got) == {(None, 12): 700, (7, 12): 205, (None, 8): 40}
    assert len(slots) == 24 and all(sorted(x) == list(range(len(x))) and len(x) in (39, 40) for x in slots.values())


def test_shards_as_files(spark, tmp_path):
    d = docs(spark, [(i, text(5, i)) for i in range(30)])
    sharding.write_shards(d, str(tmp_path / "s"), 4)
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().agg(F.min("count"), F.max("count")).first() == (7, 8)


# ---- 7: packing ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


def test_packing_round_trip(spark, tokenizer):
    rows = [(i, text(random.Random(i).choice([0, 3, 60, 300, 2500]), i)) for i in range(80)] + [(80, None), (81, "It's the dog's <|endoftext|> 'Re 世界 1²½\u200b"), (81, "It's the dog's <|endoftext|> 'Re 世界 1²½\u200b")]
    got = packing.pack(docs(spark, rows).coalesce(1), with_ids=True).collect()
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    assert sum(r["length"] for r in got) == sum(len(ids[i]) for i, _ in rows)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert r["ids"] == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        pieces[r["doc_id"]] += range(r["start"], r["start"] + r["length"])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert all(sorted(p) == sorted(list(range(len(ids[i]))) * (2 if i == 81 else 1)) for i, p in pieces.items())
    padded = 0
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
        padded += at & (at - 1) != 0
    assert padded <= 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab'éñÜß1²_-# \n\tŁǅ.,sreveSTmldĲ世\u0301Σ", max_size=25), max_size=4))
def test_encoder_is_the_tokenizer(tokenizer, texts):
    import public_tokenizers as P

    assert [x.tolist() for x in packing.encoder(P.path("word_bpe_49k.json")).many(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_step_groups_cost_alike(spark):
    r = random.Random(1)
    d = docs(spark, [(i, text(r.choice([3, 40, 150, 300, 700, 2500]), i)) for i in range(500)])
    got = packing.pack(d.coalesce(1)).select("sequence_id", "tier", "step_group").distinct().collect()
    cost, tokens, tiers = Counter(), Counter(), defaultdict(Counter)
    for x in got:
        cost[x["step_group"]] += x["tier"] ** 2
        tokens[x["step_group"]] += x["tier"]
        tiers[x["tier"]][x["step_group"]] += 1
    assert len(cost) >= 5 and len({x["sequence_id"] for x in got}) == len(got)
    assert max(cost.values()) - min(cost.values()) <= 4 / 3 * 2048**2 and max(tokens.values()) - min(tokens.values()) < 4096
    assert len(tiers) > 1 and all(max(n[g] for g in cost) - min(n[g] for g in cost) <= 1 for n in tiers.values())


def test_packing_nothing(spark):
    assert packing.pack(docs(spark, [])).count() == 0


# ---- 3 and 8: language and quality, on held-out rows ------------------------------------------------


def test_language_held_out(spark):
    got = langid_result(spark)
    truth = {r["doc_id"]: (r["lang"], r["n_chars"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in got if r["held_out"] and truth[r["doc_id"]][1] > 100]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]][0] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def langid_result(spark):
    return registry.op3_language(spark, SF).collect()


def test_language_edges(spark):
    train = docs(spark, [(1, "der die das und nicht"), (2, "ein und der"), (3, None), (4, "123")])
    names, protos = langid.learn(train)
    assert names == ["en"]
    got = langid.predict(docs(spark, [(1, None), (2, ""), (3, "12 !"), (4, "Der"), (5, "𝔄世"), (5, "𝔄世"), (None, "das")]), names, protos).collect()
    assert sorted((str(r["doc_id"]), r["lang_pred"]) for r in got) == [("1", "und"), ("2", "und"), ("3", "und"), ("4", "en"), ("5", "en"), ("5", "en"), ("None", "en")]
    names, protos = langid.learn(docs(spark, []))
    assert names == [] and langid.predict(docs(spark, [(1, "abc")]), names, protos).first()["lang_pred"] == "und"


def test_language_ties_and_limits(spark, monkeypatch):
    rows = [(i, "der die das und", lang) for i, lang in enumerate(["b", "a", "c"])]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    names, protos = langid.learn(d)
    assert names == ["a", "b", "c"] and {r["lang_pred"] for r in langid.predict(d, names, protos).collect()} == {"a"}
    p = langid.Profiles()
    assert np.allclose(protos[0], p.vector(rows[0][1]), atol=1e-5)
    assert langid.predict(d.limit(0), names, protos).count() == 0
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    with pytest.raises(ValueError):
        langid.learn(d)


def test_profiles_bind_and_bundle():
    p = langid.Profiles()
    a, b = p.vector("abc"), np.roll(p.letter(0), 2) * np.roll(p.letter(97), 1) * p.letter(98) + np.roll(p.letter(97), 2) * np.roll(p.letter(98), 1) * p.letter(99) + np.roll(p.letter(98), 2) * np.roll(p.letter(99), 1) * p.letter(0)
    assert np.allclose(a, b / np.linalg.norm(b)) and np.allclose(p.vector("ABC!"), a)


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in registry.op8_quality(spark, sf).collect() if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in got]) > 0.95 and {r["predicted"] for r in got} == {0, 1}


def test_quality_edges(spark):
    good, bad = [(i, text(200, i)) for i in range(30)], [(100 + i, "### " * 100 + text(5, i).upper()) for i in range(30)]
    labels = spark.createDataFrame([(i, 1, None) for i, _ in good] + [(i, 0, None) for i, _ in bad] + [(None, 1, 0), (5, None, 1)], "doc_id bigint, quality int, toxic int")
    model = quality.learn(docs(spark, good + bad), labels)
    d = docs(spark, [(1, None), (2, ""), (3, text(9000, 3)), (4, "$$$ " * 300), (4, "$$$ " * 300), (None, text(300, 4))])
    got = {r["doc_id"]: r["score"] for r in quality.score(d, model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and got[3] > 0.5 > got[4] and got[None] > 0.5
    kept = quality.keep_good(d, model)
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.collect()} >= {3, None} and 4 not in {r["doc_id"] for r in kept.collect()}
    assert quality.learn(docs(spark, good), labels) is None
    assert quality.score(d, None).agg(F.min("score")).first()[0] == 1.0


def test_quality_fit_is_bounded_and_repeatable(spark):
    long = " ".join(words(20_000, 1))
    rows = [(i, long if i % 2 else "### " * 9000) for i in range(40)] + [(1, "other text"), (1, "third text")] * 3
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    sizes = [len(b.column(2)[0].as_py()) // 4 // quality.FEATURES for b in quality._bags(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array([long])], ["doc_id", "text"])]))]
    assert sizes == [quality.BAG] and len(quality.passages(long)) > quality.BAG
    a, b = (quality.learn(docs(spark, r), labels) for r in (rows, rows[::-1]))
    assert all(np.array_equal(a.p[k], b.p[k]) for k in a.p)
    assert quality.score(docs(spark, []), a).count() == quality.keep_good(docs(spark, []), a).count() == 0


def test_quality_forward_is_attention_over_passages():
    m, t = quality.Model(hidden=3, attention=2), " ".join(words(300, 2))
    x = (quality.passages(t) - m.mean) / m.std
    h = np.tanh(x @ m.p["W"])
    e = np.exp((np.tanh(h @ m.p["V"]) / (1 + np.exp(-h @ m.p["U"]))) @ m.p["w"])
    want = 1 / (1 + np.exp(-((e / e.sum()) @ h @ m.p["c"] + m.p["d"][0])))
    assert len(x) == 3 and m.score([quality.passages(""), quality.passages(t)])[1] == pytest.approx(want)


def test_quality_gradient():
    m = quality.Model(hidden=3, attention=2)
    r = np.random.default_rng(0)
    bags = [r.normal(size=(k, quality.FEATURES)) for k in (1, 3, 2)]
    y = np.array([0.0, 1.0, 0.0])
    m.fit(bags, y, steps=30, size=4)
    before = -np.mean(y * np.log(m.score(bags)) + (1 - y) * np.log(1 - m.score(bags)))
    m.fit(bags, y, steps=60, size=4)
    assert -np.mean(y * np.log(m.score(bags)) + (1 - y) * np.log(1 - m.score(bags))) < max(before, 0.05)


# ---- 5: personal data --------------------------------------------------------------------------------

_REF = (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(d):
    return sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(reversed(d))) % 10 == 0


@settings(max_examples=300, deadline=None)
@given(st.one_of(*(st.text(alphabet=a, max_size=40) for a in ("a@.b-", "01.25", "0 -14", "+1 ()-.9", "a@.1+ 5-é"))))
def test_base_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    tests = (lambda s: True, lambda s: all(int(x) <= 255 for x in s.split(".")), lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s)), lambda s: 9 <= len(digits(s)) <= 15)
    assert pii.base_spans(t) == [[m.span() for m in p.finditer(t) if ok(m[0])] for p, ok in zip(_REF, tests)]


def test_field_adds_what_repeats(spark):
    rows = [(i, f"Call +1 ({203 + 11 * i}) 555-0{600 + i} or write anna{i}@mail.example.com from 10.0.{3 * i}.{i}.\nThe card 4111111111111111 of it.") for i in range(60)]
    rows += [(100, "Call +1 (437) 555-0689 now.\nThen again 555-0689 later on."), (101, "In 2024 there were 12 of them."), (102, None), (103, ""), (103, "")]
    d = docs(spark, rows)
    field = pii.learn(d)
    got = {r["doc_id"]: r for r in pii.detect(d, field).collect()}
    assert (got[0]["n_email"], got[0]["n_ip"], got[0]["n_card"], got[0]["n_phone"]) == (1, 1, 1, 1)
    assert "phone_like:" in got[100]["spans"] and got[100]["n_phone"] == 1
    assert got[101]["spans"] == got[102]["spans"] == got[103]["spans"] == ""
    assert got[102]["base_sha256"] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    out = {r["doc_id"]: r for r in pii.redact(d, field).collect()}
    assert "555-0" not in out[100]["text"] and "@" not in out[0]["text"] and out[101]["text"] == rows[61][1] and out[102]["text"] is None
    assert out[100]["n_chars"] == len(out[100]["text"]) and out[101]["n_chars"] == len(rows[61][1])
    assert pii.learn(docs(spark, [(1, "nothing")])) is None and pii.detect(docs(spark, [(1, "a@b.c")]), None).first()["n_email"] == 1


def test_field_restores_hidden_mentions(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(F.col("text").rlike("[0-9@]")).select("doc_id", "text", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2).alias("k")).collect()
    field = pii.learn(docs(spark, [(r["doc_id"], r["text"]) for r in rows if r["k"]]))
    other = [r["text"] for r in sorted(rows) if not r["k"]]
    (found, strange), (without, _) = pii.hidden_recall(other, field), pii.hidden_recall(other, field, skips=False)
    assert found > 0.8 and strange < 0.05 and without < 0.3
    assert all(field.skip[k, k] > 1 > field.skip[0, k] for k in range(1, pii.LABELS))  # learned: there is no constant


def test_names_without_digits_are_candidates():
    g = pii.Graph()
    t = "Write to jane.doe@mail.example. Or ask (Jane.Doe), not john.doe or jane."
    g.add(0, t, pii.base_spans(t))
    assert [t[a:b] for a, b in g.spans] == ["jane.doe@mail.example.", "(Jane.Doe),"] and g.skip == [(0, 1)]


def test_pii_of_nothing(spark):
    d = docs(spark, [])
    assert pii.learn(d) is None and pii.detect(d, None).count() == pii.redact(d, None).count() == 0
    same = docs(spark, [(1, f"no. {k}: 4111111111111111 of " + "12 " * 50_000) for k in range(3)] + [(None, "a@b.cd")])
    assert pii.learn(same) is not None and sorted(r["n_card"] for r in pii.detect(same, pii.learn(same)).collect()) == [0, 1, 1, 1]


def test_messages_agree_with_enumeration():
    g = pii.Graph()
    g.add(0, "a1 a1 b22 c333", [[], [], [], []])
    g.given[0] = 2
    f = pii.Field(len(g.features[0]))
    r = np.random.default_rng(1)
    f.unary[:], f.chain[:], f.skip[:] = (r.normal(0, 0.4, x.shape) for x in (f.unary, f.chain, f.skip))
    g.skip = []  # without skip edges the graph is a tree, on which the messages are exact
    x = np.array(g.features) @ f.unary
    import itertools

    p = np.zeros((4, pii.LABELS))
    for y in itertools.product(range(pii.LABELS), repeat=4):
        if y[0] == 2:
            p[range(4), y] += math.exp(sum(x[i, y[i]] for i in range(1, 4)) + sum(f.chain[y[a], y[b]] for a, b in g.chain))
    assert np.allclose(f.marginals(g), p / p.sum(axis=1, keepdims=True), atol=2e-3)


# ---- 6: neighbours ---------------------------------------------------------------------------------


def test_neighbours_are_brute_force(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(900, 24))
    for c in range(5):
        x[c * 40 : c * 40 + 40] = x[c * 40] + 0.22 * r.normal(size=(40, 24))  # cosines around the threshold
    x[300:420] = x[300] + 0.02 * r.normal(size=(120, 24))  # saturates the first lists
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, x[7].tolist()), (2001, (3 * x[7]).tolist()), (2002, None), (2003, [0.0] * 24), (2004, [float("nan")] * 24), (2005, [1.0, None]), (2006, []), (2007, [1.0, 2.0]), (None, x[0].tolist())]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<double>, label int, id string")
    ok = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if i is not None and (i < 2002 or i == 2007)}
    links = [(a, b) for a in ok for b in ok if a < b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= 0.9]
    degree = Counter(i for e in links for i in e)
    want = classes([i for i, _ in rows if i is not None], links)
    got = neighbours.near_duplicates(table).collect()
    assert len(got) == len(rows)
    found = sum(r["n_links"] for r in got) / (2 * len(links))
    assert found >= 0.99 and all(r["audited_recall"] >= 0.99 and r["n_links"] <= degree[r["vec_id"]] for r in got if r["vec_id"] is not None)
    same = np.mean([r["component_id"] == want[r["vec_id"]] for r in got if r["vec_id"] is not None])
    assert same >= 0.99 and all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)
    assert neighbours.near_duplicates(table.limit(0)).count() == 0


def test_rare_pairs_are_found(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(6000, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for k in range(300):  # a partner at a cosine of 0.9 to 0.93
        c, o = 0.9 + 0.03 * r.random() + 1e-6, r.normal(size=48)
        o -= o @ x[k] * x[k]
        x[1000 + k] = c * x[k] + (1 - c * c) ** 0.5 * o / np.linalg.norm(o)
    got = neighbours.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")).where("n_links > 0").collect()
    assert {(r["vec_id"], r["component_id"]) for r in got} >= {(i + s, i) for i in range(300) for s in (0, 1000)} and len(got) == 600


def test_neighbours_that_lists_miss_are_compared(spark, monkeypatch):
    # Lists of one place cannot hold the groups, and no doubling is left.
    r = np.random.default_rng(5)
    x = np.repeat(r.normal(size=(40, 24)), 25, axis=0) + 0.2 * r.normal(size=(1000, 24))
    for name, value in (("K", 1), ("ROUNDS", 1), ("DOUBLINGS", 0), ("WIDE_BLOCK", 300)):
        monkeypatch.setattr(neighbours, name, value, raising=False)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    links = [(int(a), int(b)) for a, b in np.argwhere(np.triu(u @ u.T >= 0.9, 1))]
    want, degree = classes(range(1000), links), Counter(i for e in links for i in e)
    got = neighbours.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")).collect()
    assert {r["vec_id"]: (r["component_id"], r["n_links"]) for r in got} == {i: (want[i], degree[i]) for i in range(1000)}


def test_audit_sees_small_groups_beside_a_large_one(spark):
    r = np.random.default_rng(8)
    x = r.normal(size=(720, 24))
    x[:400] = x[0] + 0.02 * r.normal(size=(400, 24))
    x[460:520] = x[400:460] + 0.02 * r.normal(size=(60, 24))  # pairs
    x /= np.linalg.norm(x, axis=1)[:, None]
    wide = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(x)], "id bigint, v binary")
    placed = lambda rows: spark.createDataFrame(rows, "node bigint, component bigint")
    large, pairs = [(i, 0) for i in range(400)], [(i, 400 + (i - 400) % 60) for i in range(400, 520)]
    assert neighbours._recall(wide, placed(large), 0.9) == 0
    assert neighbours._recall(wide, placed(large + pairs[:30] + pairs[60:90]), 0.9) == 0.5
    assert neighbours._recall(wide, placed(large + pairs), 0.9) == 1


def test_links_too_rare_for_the_audit(spark, monkeypatch):
    for name, value in (("K", 1), ("AUDIT", 8), ("MOST", 16)):
        monkeypatch.setattr(neighbours, name, value, raising=False)
    x = np.random.default_rng(4).normal(size=(300, 24))
    x[297:] = x[:3]
    x[297:] += 0.01
    got = neighbours.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")).collect()
    assert {r["vec_id"]: r["component_id"] for r in got if not r["kept"]} == {297: 0, 298: 1, 299: 2}


def test_seed_tables_grow_with_the_vectors():
    p = 1 - np.arccos(0.9) / np.pi
    for n in (100, 2_000, 200_000, 10_000_000):
        assert 1 - (1 - p ** neighbours._bits(n)) ** neighbours._tables(n, 0.9) >= neighbours.ODDS


# ---- 1: HTML -----------------------------------------------------------------------------------------


def test_html_of_the_tables(spark):
    import html as entities

    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        m = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)
        parts = [" ".join(entities.unescape(re.sub(r"<[^>]*(>|\Z)", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", m[1])] if m else []
        assert html.main_text(r["html"]) == "\n\n".join(x for x in parts if x)


def test_html_without_marks():
    long = "This is one of the paragraphs that are in the page, and it is as long as it has to be for the rules to take it as content without any doubt."
    page = f"""<html><head><title>No</title><style>p>a{{}}</style></head><body><div class="top-menu"><a href=/>Home</a></div><div id=x><h2>Head of it</h2><p>{long}</p>
    <p>Short &amp; sweet.</p><p>{long} <a href="/y">link</a></p><p>The end<br><br>of it</p></div><ul><li><a href=1>one</a><li><a href=2>two</a></ul>
    <div class=comments><p>{long}</p></div><form><p>{long}</p></form><div class="cookie-notice">{long}</div><aside>{long}</aside><footer>{long}</footer><script>"<p>{long}</p>"</script></body>"""
    assert html.main_text(page) == "\n\n".join(["Head of it", long, "Short & sweet.", long + " link", "The end", "of it"])


def stripped(page):
    """A page without its marks: every sectioning element is a div, and there are no classes."""
    page = re.sub(r"<(/?)(article|nav|footer|aside|header|main|section)\b", r"<\1div", page)
    return re.sub(r'\s(class|id|role)="[^"]*"', "", page)


def test_html_blocks_of_stripped_pages(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    both = only = truth = 0
    for page in pages:
        want, got = (set(html.main_text(x).split("\n\n")) - {""} for x in (page, stripped(page)))
        both, only, truth = both + len(want & got), only + len(got), truth + len(want)
    assert both / only > 0.99 and both / truth > 0.97


def test_html_hangs_on_stop_words(spark, monkeypatch):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    before = [(html.main_text(x), html.main_text(stripped(x))) for x in pages]
    monkeypatch.setattr(html, "STOP_WORDS", {})
    after = [(html.main_text(x), html.main_text(stripped(x))) for x in pages]
    marked, bare = (sum(a[k] != b[k] for a, b in zip(before, after)) for k in (0, 1))
    assert marked >= 5 and bare >= 200


def test_html_rules_hold_inside_an_article():
    long = "This is one of the paragraphs that are in the page, and it is as long as it has to be for the rules to take it as content without any doubt."
    page = f"""<article><h1><a href=/>A head</a></h1><p>{long}</p><ul><li><a href=/a>Other news of the day</a></li><li><a href=/b>More</a></li></ul><p><a href=/s>Share this with all of your friends</a></p>
    <p>Short.</p><div class=comments><p>{long}</p></div><div class="promo-box">{long}</div><p>{long}</p><p>© The Paper</p></article><div>{long}</div>"""
    assert html.main_text(page) == "\n\n".join(["A head", long, "Short.", long])


@pytest.mark.parametrize("name", ["hidden-gems", "story related", "share", "alert", "search results", "notice"])
def test_html_class_names_do_not_empty_a_page(name):
    long = "This is one of the paragraphs that are in the page, and it is as long as it has to be for the rules to take it as content without any doubt."
    assert html.main_text(f'<body><div class=menu><a href=/>Home</a></div><div class="{name}"><h1>Head</h1><p>{long}</p><p>{long}</p></div><footer>{long}</footer>') == f"Head\n\n{long}\n\n{long}"


def test_html_edges(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (1, "u", "", "x"), (2, "u", "<p", "x"), (3, "u", "<!-- a", "x"), (None, "u", "<article><p>a &lt; b &#233;</p>", "x"), (4, "u", "<article><p>" + "word the of " * 30000, "x")], "page_id bigint, url string, html string, text string")
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in html.extract(df).collect()}
    assert got[1, None] == got[1, "u"] == got[2, "u"] == got[3, "u"] == ("", 0)
    assert got[None, "u"] == ("a < b é", 7) and got[4, "u"][1] == 30000 * 12 - 1
    assert html.extract(df.limit(0)).count() == 0


# ---- 10: URLs --------------------------------------------------------------------------------------------


def split_url(u):
    rest = u.split("://", 1)[1] if u and "://" in u else ""
    host = re.split(r"[/?#]", rest)[0]
    lower = "".join(c.lower() if c.isascii() else c for c in host)
    return lower, re.split(r"[?#]", rest[len(host) :])[0]


def fitting_rule(host, path):
    fits = [r for _, r in urls.RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=len) if fits else None


def test_urls_follow_rules(spark):
    odd = [None, "", "no scheme", "http://", "http://X.Example.NET/en/", "http://example.net/en", "https://ÀB.org/fr/?q=://x", "a://b://c/de/#f", "http://net/", "http://net", "http://xnet/", "http://a.example.com/de/x?y", "http://a.example.com:80/de/", "ftp://h?x/y", "x" * 5000 + "://a.net/b", "http://org/fr/" + "y" * 5000]
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").union(spark.createDataFrame([(1000 + i, u) for i, u in enumerate(odd + odd)], "page_id bigint, url string")).withColumn("score", F.lit("x"))
    got = urls.judge_urls(pages).collect()
    assert len(got) == 50 + 2 * len(odd)
    url = {r["page_id"]: r["url"] for r in pages.collect()}
    verdict = {rule: v for v, rule in urls.RULES}
    for r in got:
        assert (r["host"], r["path"]) == split_url(url[r["page_id"]])
        assert r["rule"] == fitting_rule(r["host"], r["path"])
        assert r["verdict"] in ("allow", "block") and (r["rule"] is None or r["verdict"] == verdict[r["rule"]])
    assert urls.judge_urls(pages.limit(0)).count() == 0


def test_url_models_are_witten_bell(spark):
    counts = {"accepted": ["aab", "abb"], "rejected": ["bbb"]}
    rows = Counter()
    for label, texts in counts.items():
        for t in texts:
            p = "\x02" * urls.ORDER + t + "\x03"
            for i in range(len(p) - urls.ORDER):
                rows[p[i : i + urls.ORDER + 1], label] += 1
    grams = sorted({g for g, _ in rows})
    df = spark.createDataFrame([(g, rows[g, "accepted"], rows[g, "rejected"]) for g in grams], "gram string, accepted bigint, rejected bigint")

    def p(gram, label, k):
        if k < 0:
            return 1 / urls.ALPHABET
        g = gram[urls.ORDER - k :]
        own = Counter()
        for (x, lab), n in rows.items():
            if lab == label and x[urls.ORDER - k :][:-1] == g[:-1]:
                own[x[-1]] += n
        lower = p(gram, label, k - 1)
        return (own[g[-1]] + len(own) * lower) / (sum(own.values()) + len(own)) if own else lower

    got = {r["gram"]: r["llr"] for r in urls.gram_scores(df).collect()}
    assert got == {g: pytest.approx(math.log(p(g, "rejected", urls.ORDER)) - math.log(p(g, "accepted", urls.ORDER))) for g in grams}


def test_url_models_tell_classes_apart(spark):
    r = random.Random(5)
    good = [f"http://{r.choice(['news', 'wiki', 'docs'])}{r.randrange(99)}.site.aa/{r.randrange(999)}" for _ in range(300)]
    bad = [f"http://{r.choice(['casino', 'pills', 'bets'])}{r.randrange(99)}.site.bb/{r.randrange(999)}" for _ in range(300)]
    other = [f"http://{w}{r.randrange(99)}.site.cc/{r.randrange(999)}" for w in ("wiki", "casino") * 40]
    pages = spark.createDataFrame(list(enumerate(good + bad + other)), "page_id bigint, url string")
    got = {x["page_id"]: x["verdict"] for x in urls.judge_urls(pages, (("allow", "aa/"), ("block", "bb/"))).collect()}
    assert np.mean([got[600 + i] == ("block" if i % 2 else "allow") for i in range(80)]) > 0.9


# ---- pipeline ------------------------------------------------------------------------------------------


def test_pipeline_decisions(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    sizes, now = [d.count()], d
    for name, stage in corpus_pipeline.STAGES[:4]:
        now = stage(spark, now, SF)
        assert now.columns == d.columns, name
        sizes.append(now.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[3] == sizes[4] and sizes[4] > 100
    kept = {r["doc_id"]: r["text"] for r in now.collect()}
    model = quality.learn(d, spark.read.parquet(f"{SF}/labels.parquet").where(~quality.held_out()))
    good = {r["doc_id"] for r in quality.score(d, model).where(f"score >= {quality.CUT}").collect()}
    left = [(r["doc_id"], r["text"]) for r in d.collect() if r["doc_id"] in good]
    s, links = near_links(left, 80)
    firsts = {i for i, c in classes(s, links).items() if i == c}
    bench = [b["text"].lower().split() for b in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {" ".join(b) for b in bench}
    clean = {i for i, t in left if i in firsts and not any(h in " ".join(t.lower().split()) for h in held)}
    assert set(kept) <= firsts and set(kept) <= clean and len(clean - set(kept)) <= 2
    assert not any(any(pii.base_spans(t)) for t in kept.values())
    out = corpus_pipeline.run(spark, SF)
    assert {r[0] for r in out.select("doc_id").distinct().collect()} == set(kept)


def test_pipeline_output_is_token_sequences(spark, tokenizer, tmp_path):
    t = ["", " \n", None, text(300, 1), text(3000, 2), text(300, 1), "Write to anna@mail.example.com about " + text(60, 3)]
    rows = [(i, x, "en", "s", None, "a", None, "b", None) for i, x in enumerate(t)] + [(4, t[4], "en", "s", None, "a", None, "b", None)] * 2 + [(4, text(80, 4), None, None, 1, "", "", "", ""), (None, text(50, 5), None, None, None, None, None, None, None)]
    sf = str(tmp_path)
    spark.createDataFrame(rows, DOC).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, text(40, 9))], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    out = defaultdict(list)
    for r in corpus_pipeline.run(spark, sf).collect():
        out[r["doc_id"]].append((r["start"], r["ids"], r["doc_tokens"]))
    want = lambda x: [*tokenizer.encode(x or "", add_special_tokens=False).ids, 1]
    joined = lambda k: sum((ids for _, ids, _ in sorted(out[k])), [])
    assert set(out) == {0, 1, 2, 3, 4, 6, None}  # 5 repeats 3
    assert joined(3) == want(t[3]) and joined(2) == [1] and joined(None) == want(text(50, 5))
    assert joined(6) == want(t[6].replace("anna@mail.example.com", "<EMAIL>"))
    assert sorted(len(want(x)) for x in (t[4], text(80, 4))) == sorted({n for _, _, n in out[4]}) and len(joined(4)) == sum(len(want(x)) for x in (t[4], text(80, 4)))


def test_pipeline_of_nothing(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], DOC).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_registered():
    names = registry.queries()
    assert {re.match(r"op(\d+)_", n)[1] for n in names if n != "pipeline"} == {str(i) for i in range(1, 11)} and "pipeline" in names


# ---- the driver's memory ------------------------------------------------------------------------


def test_a_fit_holds_its_sample_once():
    import tracemalloc

    r = np.random.default_rng(2)
    bags = [r.random((32, quality.FEATURES), dtype=np.float32) + (k % 2) for k in range(300)]
    model, y = quality.Model(), np.arange(300) % 2.0
    tracemalloc.start()
    model.fit(bags, y, steps=2, size=8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < sum(b.nbytes for b in bags)
    whole = np.concatenate(bags).astype(np.float64)
    assert (model.mean[:-1] == whole.mean(axis=0)[:-1]).all() and (model.std[:-1] == whole.std(axis=0)[:-1] + 0.01).all()


def test_the_driver_gives_freed_memory_back(spark):
    from shotline.llm import common

    assert "Trim native heap" in common.give_back(spark)
