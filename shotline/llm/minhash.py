"""Near-duplicate documents by circulant MinHash."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, arrow_map, discard, give_back, join_hot, mix, rows_with_ids, settle, shingle_hashes, words_of
from .graph import components

#: The universe that shingles fall into; coordinates of a signature at most; odds that a pair at the threshold misses every band.
UNIVERSE, COORDINATES, MISS = 1 << 20, 140, 4e-5
#: Members that one task compares with a leader at most; a leader of more is dealt to several tasks.
STAR = 512


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows of a band: as many rows as the coordinates allow at the odds MISS."""
    for rows in range(8, 0, -1):
        bands = math.ceil(math.log(MISS) / math.log(1 - min(percent / 100, 0.999) ** rows))
        if bands * rows <= COORDINATES:
            return bands, rows
    return COORDINATES, 1


class Circulant:
    """Signatures from two permutations.

    The first permutation places a shingle (a mixed 64-bit hash) in the universe.
    The second one, ``pi``, is held once with its head repeated at the tail: the k-th
    coordinate takes ``pi`` shifted by k places, so a shingle's values in all
    coordinates are one slice of it and a signature is a column-wise minimum.
    """

    def __init__(self, bands: int, rows: int, seed: int = 20240601, universe: int = UNIVERSE):
        self.n, self.bands, self.rows, self.universe = bands * rows, bands, rows, universe
        pi = np.random.default_rng(seed).permutation(universe).astype(np.int32)
        self.slices = np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[: self.n]]), self.n)
        self.weights = np.random.default_rng(seed + 1).integers(1, 2**63, (bands, rows), dtype=np.uint64) | np.uint64(1)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        places = (mix(shingles) & np.uint64(self.universe - 1)).astype(np.int64)
        low = np.full(self.n, self.universe, np.int32)
        for i in range(0, len(places), 4096):
            np.minimum(low, self.slices[places[i : i + 4096]].min(axis=0), out=low)
        return low

    def band_keys(self, shingles: np.ndarray) -> np.ndarray:
        sig = self.signature(shingles).astype(np.uint64).reshape(self.bands, self.rows)
        return mix((sig * self.weights).sum(axis=1, dtype=np.uint64) + np.arange(self.bands, dtype=np.uint64)).view(np.int64)


def _sketch(bands: int, rows: int):
    return lambda batches: _sketched(batches, Circulant(bands, rows))


def _sketched(batches: Iterator[pa.RecordBatch], circulant: Circulant) -> Iterator[pa.RecordBatch]:
    cache = WordHashes()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        sizes, keys, high, low = [], [], [], []
        for i in range(len(texts)):
            text = texts[i].as_py() or ""
            s = shingle_hashes(words_of(text), cache)
            sizes.append(len(s))
            keys.append(circulant.band_keys(s) if len(s) else None)
            h = xxhash.xxh3_128_intdigest(text.encode("utf-8", "surrogatepass"))
            high.append((h >> 64) - (1 << 63))
            low.append((h & (1 << 64) - 1) - (1 << 63))
        yield pa.RecordBatch.from_arrays([ids, pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "h1", "h2", "n_shingles", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHashes()
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_hashes(words_of(t.as_py()), cache).tobytes() for t in batch.column(1)], pa.binary())], ["id", "shingles"])


def _star_links(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lead = None, np.empty(0, np.uint64)
        for batch in batches:
            a, salt, b, sets = (batch.column(i) for i in range(4))
            left, right = [], []
            for x, s, y, raw in zip(a.to_pylist(), salt.to_pylist(), b.to_pylist(), sets, strict=True):
                own = np.frombuffer(raw.as_buffer(), np.uint64)
                if y is None:
                    key, lead = (x, s), own.copy()
                    continue
                assert key == (x, s), "a leader's row comes first"
                if 100 * min(len(lead), len(own)) < percent * max(len(lead), len(own)):
                    continue
                both = len(np.intersect1d(lead, own, assume_unique=True))
                if both and 100 * both >= percent * (len(lead) + len(own) - both):
                    left.append(x)
                    right.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those ``pairs(a, b)`` whose full shingle sets reach the similarity.

    Every member's set travels once to its leader ``a``.  A leader of many members is
    dealt to several tasks, each of which gets the leader's set first and then streams
    the members, so no task holds a group.
    """
    size = pairs.groupBy("a").agg(F.count("*").alias("n")).select("a", F.ceil(F.col("n") / STAR).cast("int").alias("parts"))
    members = pairs.join(size, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("salt"), "b")
    members = members.join(sets, F.col("b") == F.col("id")).select("a", "salt", "b", "shingles")
    leaders = size.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
    leaders = leaders.join(sets, F.col("a") == F.col("id")).select("a", "salt", F.lit(None).cast("bigint").alias("b"), "shingles")
    rows = members.union(leaders).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return rows.transform(arrow_map, _star_links(percent), "a bigint, b bigint")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["id", "n", "t"])


def _rare_first(sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``classes(id, c)`` of different c that may reach the similarity, by prefix filtering.

    Shingles are ordered from rare to frequent.  If |A| <= |B| and the pair is similar
    enough, the two share one of A's first |A| - ceil(2p/(100+p) |A|) + 1 and B's first
    |B| - ceil(p/100 |B|) + 1 shingles.  Near copies below the similarity differ in rare
    shingles, so a large group of them makes few pairs, and no similar pair is lost.  Sets
    that hold one shingle meet in classes of like size, and STAR of them at most in a task.
    """
    flat = rows_with_ids(sets.withColumnRenamed("id", "doc_id"), classes.select(F.col("id").alias("doc_id")))
    flat = flat.dropDuplicates(["doc_id"]).transform(arrow_map, _tokens, "id bigint, n bigint, t array<bigint>").select("id", "n", F.explode("t").alias("t"))
    often = flat.groupBy("t").agg(F.count("*").alias("f"))
    ranked = flat.join(often, "t").withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("f", "t")))
    probe = F.col("n") - F.expr(f"(n * {percent} + 99) div 100") + 1
    index = F.col("n") - F.expr(f"(n * {2 * percent} + {99 + percent}) div {100 + percent}") + 1
    prefix = settle(ranked.where((F.col("f") > 1) & (F.col("rank") <= probe)).withColumn("first", F.col("rank") <= index).join(classes, "id").select("t", "id", "n", "c", "first", "rank"))
    # Sets of a pair differ in size by a factor of 100 / percent at most, so they are of one size class or of two that adjoin.
    step = math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1.0  # a little more, for rounding
    size_class = F.floor(F.log("n") / F.lit(step))
    prefix, total = prefix.withColumn("band", size_class), prefix.count()
    sides = prefix.select("t", "band", F.lit(1).alias("own")).union(prefix.where("first").select("t", F.col("band") + 1, F.lit(0)))
    parts = sides.groupBy("t", "band").agg(F.count("*").alias("rows"), F.ceil(F.sum("own") / STAR).cast("int").alias("parts")).where("parts > 0")
    b = join_hot(prefix, parts, ["t", "band"], total, "rows").select("t", "band", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), F.col("id").alias("b"), F.col("n").alias("nb"), F.col("c").alias("cb"), F.col("rank").alias("rb"))
    a = join_hot(prefix.where("first").withColumn("band", F.explode(F.array(F.col("band"), F.col("band") + 1))), parts, ["t", "band"], total, "rows")
    a = a.select("t", "band", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("id").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca"), F.col("rank").alias("ra"))
    # At the first shingle that two sets share, no more than those behind it can follow.
    reach = f"(100 + {percent}) * (1 + least(na - ra, nb - rb)) >= {percent} * (na + nb)"
    met = a.join(b, ["t", "band", "part"]).where(f"ca <> cb and (na < nb or na = nb and a < b) and 100 * na >= {percent} * nb and {reach}")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Near-duplicate classes of ``docs(doc_id, text)``.

    Two documents are linked if ``100 * |A & B| >= percent * |A | B|`` on their sets of
    five-word shingles.  Returns ``doc_id, n_shingles, component_id, kept`` for every row.

    1. One scan makes each text's set size, 128-bit text hash and band keys.
    2. Equal texts become one node, so copies never meet in a band.
    3. In each band the members are compared with the band's least node only, on full sets.
    4. Where members of a band are still in different components, all such documents are
       joined on their rarest shingles, which finds every similar pair among them, so no
       link found by banding is lost and no large group is expanded.

    Nulls and empty texts have no shingles and stand alone.  Rows of one doc_id are one
    document.  A row whose doc_id is null has a null component_id and is kept.  Other
    columns are not read.  An empty table gives an empty one.
    """
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = settle(src.transform(arrow_map, _sketch(*banding(percent)), "doc_id bigint, h1 bigint, h2 bigint, n_shingles bigint, bands array<bigint>"))
    whole = sketch.where("doc_id is not null and n_shingles > 0")
    nodes = settle(whole.groupBy("h1", "h2").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")))
    entries = nodes.select("id", "n", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.min(F.struct("id", "n")).alias("lead"), F.count("*").alias("k")).where("k > 1").select("key", "lead.id", "lead.n").toDF("key", "lead", "lead_n")
    met = settle(entries.join(shared, "key"))
    fits = f"id <> lead and 100 * least(n, lead_n) >= {percent} * greatest(n, lead_n)"
    pairs = settle(met.where(fits).select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct())
    sets = settle(rows_with_ids(src, met.select(F.col("id").alias("doc_id"))).transform(arrow_map, _sets, "id bigint, shingles binary"))
    stars = settle(confirm(pairs, sets, percent))
    first = components(stars)
    give_back(docs.sparkSession)
    own = met.join(first, met["id"] == first["node"], "left").select("key", "id", F.coalesce("component", "id").alias("c"))
    mixed = own.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    apart = settle(own.join(mixed, "key").select("id", "c").distinct())
    across = settle(_rare_first(sets, apart, percent).join(pairs, ["a", "b"], "left_anti"))
    give_back(docs.sparkSession)
    crossed = confirm(across, sets, percent)
    # Rows of one doc_id with different texts, if any, are one document.
    same_id = whole.join(nodes.select("h1", "h2", "id"), ["h1", "h2"]).where("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    final = components(settle(stars.union(crossed).union(same_id)))
    named = sketch.join(final, sketch["doc_id"] == final["node"], "left")
    out = settle(named.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
    discard(sketch, nodes, met, pairs, sets, stars, apart, across)
    give_back(docs.sparkSession)
    return out


def op9_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), percent=85)
