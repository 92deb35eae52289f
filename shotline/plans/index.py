"""Indexes as tables: postings in folders by term, vectors in folders by cell.  A search reads the folders it needs."""

from __future__ import annotations

import functools
import json
import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import InputError, StoreNotReadyError
from ..functions import text
from ..functions import vectors as V
from ..operators import relational as R
from ..sources.writers import exists
from .search import B, EXPANSIONS, K1, MOST_TEXT_HITS, MOST_VECTOR_HITS, TextSearch, allowed_edits, edit_distance

#: Folders of an index; words of the documents that a task writes of one folder, about, so that a task's memory does not grow with them.
BUCKETS, SHARE = 64, 2_000_000
#: Tasks that write one folder of vectors.
SPREAD = 4
#: Characters of a text for a word of it, about: how many words there are is known only later.
LETTERS = 6
#: Words that a task gathers before it makes their postings, and postings that it merges at once; rows that it hands back at once.
WORDS, ROWS = 4_000_000, 20_000
#: What an index on disk looks like; an index of another form is to be built again.
FORM = 2
#: Vectors that the centroids are fitted on at most; rounds of the fit; cells that a search reads, unless it says otherwise.
FIT, ROUNDS, PROBES, SEED = 20_000, 10, 8, 3


def counted(tokens: Column) -> Column:
    """``array<struct(term, tf)>`` of an array of words, by one sort of it."""
    bind = lambda c, f: F.get(F.transform(F.array(c), f), 0)  # noqa: E731  (evaluates ``c`` once)

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return bind(starts, lambda p: F.transform(p, lambda i, k: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(p, k + 1), F.size(s)) - i).alias("tf"))))

    return F.when(F.size(tokens) > 0, bind(F.array_sort(tokens), runs))


def _bucket(term: Column) -> Column:
    return F.pmod(F.crc32(F.encode(term, "UTF-8")), F.lit(BUCKETS)).cast("int")


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ``key, words`` the postings of WORDS words at a time: for each bucket a row with its ``block``, compressed columns of these."""

    def made(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        both = pa.Table.from_batches(held).combine_chunks()
        keys, words = (both[c].chunk(0) for c in ("key", "words"))
        length = pc.fill_null(pc.list_value_length(words), 0).to_numpy()
        coded = words.flatten().dictionary_encode()
        place = coded.indices.to_numpy().astype(np.int64) * len(both) + np.repeat(np.arange(len(both)), length)
        place, tf = np.unique(place, return_counts=True)
        code, doc = np.divmod(place, len(both))
        of_term = np.array([zlib.crc32(t.encode()) % BUCKETS for t in coded.dictionary.to_pylist()], np.int32)
        order = np.argsort(of_term[code], kind="stable")
        code, doc, tf = code[order], doc[order], tf[order].astype(np.int32)
        buckets, starts = np.unique(of_term[code], return_index=True)
        blocks = []
        for a, b in zip(starts, [*starts[1:], len(code)], strict=True):
            terms, at = np.unique(code[a:b], return_inverse=True)
            term = pa.DictionaryArray.from_arrays(pa.array(at, pa.int32()), coded.dictionary.take(pa.array(terms)))
            columns = [term, keys.take(pa.array(doc[a:b])), pa.array(tf[a:b]), pa.array(length[doc[a:b]], pa.int32())]
            block, sink = pa.RecordBatch.from_arrays(columns, ["term", "key", "tf", "length"]), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, block.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(block)
            blocks.append(sink.getvalue().to_pybytes())
        # All blocks of these documents go to the same share of their folders; the others' to other ones.
        seed = zlib.crc32(repr(keys[0].as_py()).encode())
        return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array([seed] * len(buckets), pa.int64()), pa.array(blocks, pa.binary())], ["bucket", "seed", "block"])

    held, n = [], 0
    for batch in batches:
        # Slices, for a batch is bounded by its rows and not by its words.
        for a in range(0, batch.num_rows, 1_000):
            part = batch.slice(a, 1_000)
            held.append(part)
            n += len(part.column("words").flatten())
            if n >= WORDS:
                yield made(held)
                held, n = [], 0
    if n:
        yield made(held)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ``bucket, block`` in order of buckets a row for each word, or one for each WORDS postings of a bucket, with arrays of its documents' keys, its times in them, and their lengths."""

    def made(bucket: int, held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        every = pa.concat_tables(held).unify_dictionaries().combine_chunks()
        coded = every["term"].chunk(0)
        order = np.argsort(coded.indices.to_numpy(), kind="stable")
        code = coded.indices.to_numpy()[order]
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        for a in range(0, len(starts), ROWS):
            some = starts[a : a + ROWS]
            end = int(starts[a + ROWS]) if a + ROWS < len(starts) else len(code)
            rows = every.take(pa.array(order[some[0] : end])).combine_chunks()
            offsets = pa.array(np.append(some, end) - some[0], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, rows[c].chunk(0)) for c in ("key", "tf", "length")]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), bucket, np.int32)), coded.dictionary.take(pa.array(code[some])), *lists], ["bucket", "term", "keys", "tfs", "lengths"])

    held, at, n = [], None, 0
    for batch in batches:
        for bucket, block in zip(batch.column("bucket").to_pylist(), batch.column("block"), strict=True):
            if held and (bucket != at or n >= WORDS):
                yield from made(at, held)
                held, n = [], 0
            held.append(pa.ipc.open_stream(block.as_buffer()).read_all())
            at, n = bucket, n + len(held[-1])
    if held:
        yield from made(at, held)


class TextIndex:
    """BM25 from postings on disk, with the scores of ``TextSearch``.

    ``postings`` (term, key, tf, length) and ``terms`` (term, df, cf) lie in a folder for each
    field and bucket of terms; a query reads the buckets of its words only, and in them the
    row groups that may hold these.  On disk a word's postings are arrays; they are shuffled as
    compressed blocks of a folder's share of some thousand documents.
    """

    def __init__(self, spark: SparkSession, path: str, docs: DataFrame, digits: int = 6, analyzer=text.tokens):
        if not exists(spark, f"{path}/stats"):
            raise StoreNotReadyError(f"no index at {path}")
        self.spark, self.path, self.docs, self.digits, self.analyzer = spark, path.rstrip("/"), docs, digits, analyzer
        meta = json.loads(spark.read.text(f"{path}/stats").first()[0])
        if meta.get("form") != FORM:
            raise StoreNotReadyError(f"the index at {path} is of another form; build it again")
        self.key, self.stats = meta["key"], {f: (n, mean) for f, (n, mean) in meta["fields"].items()}

    @classmethod
    def build(cls, source: TextSearch, path: str, mode: str = "overwrite") -> TextIndex:
        """Write the index of ``source``; its statistics last, so that an unfinished one is not taken for an index."""
        spark, key = source.docs.sparkSession, source.key
        sizes, mean = source.docs.agg(F.count("*").alias("n"), *(F.sum(F.length(c)).alias(f) for f, c in source.fields.items())).first(), {}
        kind = source.docs.schema[key].dataType.simpleString()
        for name in source.fields:
            words = source.tokens.select(F.col(key).alias("key"), F.col(f"_t_{name}").alias("words"))
            spread = math.ceil((sizes[name] or 0) / LETTERS / (BUCKETS * SHARE)) or 1
            deal = [F.col("bucket"), F.pmod("seed", F.lit(spread))]
            # A small index takes as few tasks as it may.
            rows = words.mapInArrow(_postings, "bucket int, seed bigint, block binary").repartition(*([BUCKETS * spread] if spread > 1 else []), *deal).sortWithinPartitions("bucket")
            rows = rows.select("bucket", "block").mapInArrow(_merged, f"bucket int, term string, keys array<{kind}>, tfs array<int>, lengths array<int>").select("term", "keys", "tfs", "lengths", "bucket")
            rows.sortWithinPartitions("bucket", "term").write.mode(mode).partitionBy("bucket").parquet(f"{path}/postings/field={name}")
            back = spark.read.schema(rows.schema).parquet(f"{path}/postings/field={name}")
            terms = back.groupBy("bucket", "term").agg(F.sum(F.size("keys")).alias("df"), F.sum(F.aggregate("tfs", F.lit(0).cast("bigint"), lambda n, x: n + x)).alias("cf"))
            terms.repartition("bucket").sortWithinPartitions("term").write.mode(mode).partitionBy("bucket").parquet(f"{path}/terms/field={name}")
            # The documents' lengths are the words' frequencies, so texts are cut into words once.
            every = spark.read.schema("cf bigint").parquet(f"{path}/terms/field={name}").agg(F.sum("cf")).first()[0]
            mean[name] = (every or 0) / max(1, sizes["n"])
        stats = json.dumps({"form": FORM, "key": key, "fields": {f: [sizes["n"], mean[f]] for f in source.fields}})
        spark.createDataFrame([(stats,)], "value string").coalesce(1).write.mode(mode).text(f"{path}/stats")
        return cls(spark, path, source.docs, source.digits, source.analyzer)

    def _read(self, kind: str, field: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}/field={field}")

    def postings(self, field: str) -> DataFrame:
        kind = self.docs.schema[self.key].dataType.simpleString()
        blocks = self._read("postings", field, f"term string, keys array<{kind}>, tfs array<int>, lengths array<int>, bucket int")
        each = F.explode(F.arrays_zip(F.col("keys").alias("key"), F.col("tfs").alias("tf"), F.col("lengths").alias("length"))).alias("x")
        return blocks.select("bucket", "term", each).select("x.key", "x.length", "term", "x.tf", "bucket")

    def terms(self, field: str) -> DataFrame:
        return self._read("terms", field, "term string, df bigint, cf bigint, bucket int")

    def _of(self, rows: DataFrame, words: Sequence[str]) -> DataFrame:
        """Rows of these words: the folders by a literal list, the words in them by pushed filters."""
        picked = self.spark.createDataFrame([(w,) for w in words], "term string").select(_bucket(F.col("term")).alias("b")).distinct().collect()
        return rows.where(F.col("bucket").isin([r["b"] for r in picked]) & F.col("term").isin(list(words)))

    def _words(self, field: str, asked: list[str], fuzzy: bool) -> tuple[dict[str, list[tuple[str, float]]], dict[str, int]]:
        """For each query word the index's words that stand for it, with their boosts; and their document frequencies."""
        if not fuzzy:
            found = {r["term"]: r["df"] for r in self._of(self.terms(field), asked).select("term", "df").collect()}
            return {q: [(q, 1.0)] for q in asked if q in found}, found
        most = F.explode(F.array(*(F.struct(F.lit(q).alias("q"), F.lit(allowed_edits(q)).alias("most")) for q in asked)))
        near = self.terms(field).select("term", "df", most.alias("a")).select("term", "df", "a.q", "a.most").where(F.abs(F.length("term") - F.length("q")) <= F.col("most"))
        near = near.where(F.levenshtein("term", "q") <= 2 * F.col("most")).withColumn("d", edit_distance("term", "q")).where("d <= most")
        rank = F.row_number().over(Window.partitionBy("q").orderBy("d", "term"))
        rows = near.withColumn("r", rank).where(F.col("r") <= EXPANSIONS).collect()
        groups: dict[str, list[tuple[str, float]]] = {}
        for r in rows:
            groups.setdefault(r["q"], []).append((r["term"], 1 - r["d"] / min(len(r["term"]), len(r["q"]))))
        return groups, {r["term"]: r["df"] for r in rows}

    def _scores(self, field: str, asked: list[str], fuzzy: bool) -> DataFrame | None:
        """``key, score`` of the field."""
        groups, df_of = self._words(field, asked, fuzzy)
        if not groups:
            return None
        n, mean = self.stats[field]
        weight: dict[str, float] = {}
        for group in groups.values():
            df = max(df_of[w] for w, _ in group)  # words that stand for one share the largest frequency
            for w, boost in group:
                weight[w] = weight.get(w, 0.0) + boost * math.log(1 + (n - df + 0.5) / (df + 0.5))
        weights = F.map_from_arrays(F.array(*map(F.lit, weight)), F.array(*map(F.lit, weight.values())))
        tf, longer = F.col("tf").cast("double"), K1 * (1 - B + B * F.col("length") / (mean or 1.0))
        part = F.element_at(weights, F.col("term")) * tf / (tf + longer)
        return self._of(self.postings(field), sorted(weight)).groupBy("key").agg(F.sum(part).alias("score"))

    def search(self, query: str, top_k: int = 100, *, fields: Sequence[str] | None = None, where: Column | None = None, among: DataFrame | None = None, min_score: float | None = None, fuzzy: bool = False) -> DataFrame:
        """As ``TextSearch.search``.  The cut comes before the documents' columns are fetched; a filter is joined before the cut."""
        if not 0 < top_k <= MOST_TEXT_HITS:
            raise InputError(f"top_k is 1 to {MOST_TEXT_HITS}")
        asked = sorted(set(self.spark.range(1).select(self.analyzer(F.lit(query)).alias("t")).first()["t"]))
        scores = [s for f in fields or list(self.stats) if asked and (s := self._scores(f, asked, fuzzy)) is not None]
        if not scores:
            return self.docs.withColumn("score", F.lit(0.0)).where(F.lit(False))
        hits = scores[0] if len(scores) == 1 else functools.reduce(DataFrame.union, scores).groupBy("key").agg(F.max("score").alias("score"))
        if where is not None:
            among = (self.docs if among is None else among).where(where)
        if among is not None:
            hits = hits.join(among.select(F.col(self.key).alias("key")), "key", "left_semi")
        hits = hits.select("key", F.round("score", self.digits).alias("score")).where("score > 0")
        best = R.top_k(hits, top_k, "score", "key", min_score)
        # MOST_TEXT_HITS bounds what is broadcast.
        return self.docs.join(F.broadcast(best), self.docs[self.key] == F.col("key")).drop("key").orderBy(F.desc("score"), self.key)


class VectorIndex:
    """Cells of near vectors, a folder for each; a search reads the cells whose centroids are nearest to the query.

    Centroids are fitted on FIT vectors at most, drawn by hash; all vectors are in the index.
    With as many probes as there are cells the result is exact.
    """

    def __init__(self, spark: SparkSession, path: str):
        if not exists(spark, f"{path}/centroids"):
            raise StoreNotReadyError(f"no index at {path}")
        self.spark, self.path = spark, path.rstrip("/")
        rows = sorted(map(tuple, spark.read.parquet(f"{path}/centroids").collect()))
        self.centroids = np.array([c for _, c, _ in rows], np.float32)
        self.schema = rows[0][2]

    @classmethod
    def build(cls, table: DataFrame, path: str, key: str, embedding: str = "embedding", cells: int | None = None) -> VectorIndex:
        """Write the index of ``table``; rows whose vector has no length (or is null) are in none of its cells."""
        spark, count = table.sparkSession, table.count()
        cells = cells or max(1, min(4096, round(math.sqrt(count))))
        unit = table.withColumn("_unit", V.normalised(F.col(embedding))).where(F.col("_unit").isNotNull())
        sample = [r[0] for r in unit.orderBy(F.xxhash64(F.lit(SEED), key)).limit(FIT).select("_unit").collect()]
        x = np.array(sample, np.float32) if sample else np.zeros((0, 1), np.float32)
        centroids = x[np.random.default_rng(SEED).choice(len(x), min(cells, len(x)), replace=False)] if len(x) else np.zeros((1, 1), np.float32)
        for _ in range(ROUNDS if len(x) else 0):
            own = (x @ centroids.T).argmax(axis=1)
            sums = np.zeros_like(centroids)
            np.add.at(sums, own, x)
            norm = np.linalg.norm(sums, axis=1, keepdims=True)
            centroids = np.where(norm > 0, sums / np.maximum(norm, 1e-9), centroids)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.schema.get_field_index("_unit")
                cell = (np.array(batch.column(at).to_pylist(), np.float32) @ centroids.T).argmax(axis=1).astype(np.int32) if batch.num_rows else np.empty(0, np.int32)
                cols = [c for i, c in enumerate(batch.columns) if i != at]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(cell)], [*(n for n in batch.schema.names if n != "_unit"), "cell"])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields) + ", cell int"
        placed = unit.mapInArrow(assign, schema)
        placed.repartition("cell", F.pmod(F.xxhash64(key), F.lit(SPREAD))).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/cells")
        spark.createDataFrame([(i, c.tolist(), schema) for i, c in enumerate(centroids)], "cell int, centroid array<float>, schema string").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
        return cls(spark, path)

    def search(self, vector: Sequence[float], top_k: int = 100, *, key: str, embedding: str = "embedding", probes: int = PROBES, where: Column | None = None, min_score: float | None = None, digits: int | None = None) -> DataFrame:
        """As ``vector_search``, within the ``probes`` nearest cells."""
        if not 0 < top_k <= MOST_VECTOR_HITS:
            raise InputError(f"top_k is 1 to {MOST_VECTOR_HITS}")
        q = np.asarray(vector, np.float32)
        near = np.argsort(-(self.centroids @ q))[:probes].tolist() if self.centroids.shape[1] == len(q) else []
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/cells").where(F.col("cell").isin(near)).drop("cell")
        score = V.cosine(F.col(embedding), V.literal(vector))
        rows = rows if where is None else rows.where(where)
        return R.top_k(rows.withColumn("score", F.round(score, digits) if digits else score).where("score is not null"), top_k, "score", key, min_score)
