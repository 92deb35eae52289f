"""Retrieval: exact vector search, BM25 and fuzzy text search, label search, hydration."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InputError, StoreNotReadyError
from ..functions import media, text
from ..functions import vectors as V
from ..operators import relational as R
from ..operators import timeline
from ..schemas import DIMS

K1, B = 1.2, 0.75
# Words that one fuzzy word stands for at most, and hits that a search returns at most.
EXPANSIONS, MOST_VECTOR_HITS, MOST_TEXT_HITS = 50, 16_384, 10_000


def damerau(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance."""
    last: dict[str, int] = {}
    big = len(a) + len(b)
    d = [[big] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    for i, x in enumerate(a, 1):
        column = 0
        for j, y in enumerate(b, 1):
            row, swap = last.get(y, 0), column
            if x == y:
                column = j
            d[i + 1][j + 1] = min(d[i][j] + (x != y), d[i + 1][j] + 1, d[i][j + 1] + 1, d[row][swap] + (i - row - 1) + 1 + (j - swap - 1))
        last[x] = i
    return d[-1][-1]


@F.pandas_udf(T.IntegerType())
def edit_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([damerau(x, y) for x, y in zip(a, b, strict=True)])


def _times(tokens: Column, word: Column) -> Column:
    return F.size(F.filter(tokens, lambda x: x == word)).cast("double")


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 3 else 1 if len(term) < 6 else 2


class TextSearch:
    """BM25 over the fields of ``docs``; a query's words are alternatives, and a filter never changes a score."""

    def __init__(self, docs: DataFrame, key: str, fields: dict[str, Column], analyzer=text.tokens, digits: int = 6):
        self.docs, self.key, self.fields, self.analyzer, self.digits = docs, key, fields, analyzer, digits
        self.tokens = docs.withColumns({f"_t_{name}": analyzer(F.coalesce(c, F.lit(""))) for name, c in fields.items()})

    def terms(self, query: str) -> list[str]:
        row = self.docs.sparkSession.range(1).select(self.analyzer(F.lit(query)).alias("t")).first()
        return sorted(set(row["t"]))

    def _expanded(self, name: str, terms: list[str]) -> tuple[dict[str, list[tuple[str, float]]], dict[str, int]]:
        """For each query word the vocabulary's words within its allowed edits, with their boosts, the nearest first;
        and the words' document frequencies.  One pass over the documents for all query words."""
        vocabulary = self.tokens.select(F.explode(F.array_distinct(f"_t_{name}")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        asked = F.explode(F.array(*(F.struct(F.lit(q).alias("q"), F.lit(allowed_edits(q)).alias("most")) for q in terms)))
        # A transposition is two edits for the built-in distance, which so leaves few words for the exact one.
        near = vocabulary.withColumn("a", asked).select("term", "df", "a.q", "a.most").where(F.abs(F.length("term") - F.length("q")) <= F.col("most"))
        near = near.where(F.levenshtein("term", "q") <= 2 * F.col("most")).withColumn("d", edit_distance("term", "q")).where("d <= most")
        rank = F.row_number().over(Window.partitionBy("q").orderBy("d", "term"))
        rows = near.withColumn("r", rank).where(F.col("r") <= EXPANSIONS).orderBy("q", "r").collect()
        groups: dict[str, list[tuple[str, float]]] = {q: [] for q in terms}
        for r in rows:
            groups[r["q"]].append((r["term"], 1 - r["d"] / min(len(r["term"]), len(r["q"]))))
        return groups, {r["term"]: r["df"] for r in rows}

    def field_score(self, hits: DataFrame, name: str, terms: list[str], fuzzy: bool = False) -> tuple[DataFrame, Column | None]:
        """``hits`` with the field's matching words, and its BM25 as an expression on them; the corpus's
        statistics come from aggregates over all documents, whatever ``hits`` was filtered to."""
        t, length, words = F.col(f"_h_{name}"), F.col(f"_l_{name}"), F.col(f"_t_{name}")
        groups, seen = self._expanded(name, terms) if fuzzy else ({q: [(q, 1.0)] for q in terms}, {})
        flat = sorted({w for g in groups.values() for w, _ in g})
        if not flat:
            return hits, None
        counts = [] if fuzzy else [F.count_if(F.array_contains(words, w)) for w in flat]
        n, mean, *df_of = self.tokens.agg(F.count("*"), F.avg(F.size(words)), *counts).first()
        seen = seen or dict(zip(flat, df_of, strict=True))
        # One pass over a document's words leaves the few that score.
        hits = hits.withColumns({f"_h_{name}": F.filter(words, lambda x: x.isin(flat)), f"_l_{name}": F.size(words).cast("double")})
        weight = dict.fromkeys(flat, 0.0)
        for group in groups.values():
            # A fuzzy word's expansions share the largest frequency among them.
            df = max((seen[w] for w, _ in group), default=0)
            for w, boost in group:
                weight[w] += boost * math.log(1 + (n - df + 0.5) / (df + 0.5))
        weights = F.map_from_arrays(F.array(*map(F.lit, weight)), F.array(*map(F.lit, weight.values())))
        longer = K1 * (1 - B + B * length / (mean or 1.0))
        part = lambda w: F.element_at(weights, w) * _times(t, w) / (_times(t, w) + longer)
        return hits, F.aggregate(F.array_distinct(t), F.lit(0.0), lambda s, w: s + part(w))

    def search(self, query: str, top_k: int = 100, *, fields: Sequence[str] | None = None, where: Column | None = None, among: DataFrame | None = None, min_score: float | None = None, fuzzy: bool = False) -> DataFrame:
        """The best documents with ``score``: the best of the fields' scores, above 0.  ``where``, or the keys of ``among``, leave the others out."""
        if not 0 < top_k <= MOST_TEXT_HITS:
            raise InputError(f"top_k is 1 to {MOST_TEXT_HITS}")
        terms = self.terms(query)
        hits, scores = self.tokens if where is None else self.tokens.where(where), []
        if among is not None:
            hits = hits.join(among.select(self.key), self.key, "left_semi").select(*hits.columns)
        for f in (fields or list(self.fields)) if terms else []:
            hits, score = self.field_score(hits, f, terms, fuzzy)
            scores += [] if score is None else [score]
        if not scores:
            return self.docs.withColumn("score", F.lit(0.0)).where(F.lit(False))
        best = F.greatest(*scores) if len(scores) > 1 else scores[0]
        any_hit = functools.reduce(lambda a, b: a | b, (F.size(f"_h_{f}") > 0 for f in fields or list(self.fields) if f"_h_{f}" in hits.columns))
        hits = hits.where(any_hit).select(*self.docs.columns, F.round(best, self.digits).alias("score"))
        # Below the cut, so that the score is not worked out a second time for a filter.
        return R.top_k(hits, top_k, "score", self.key, min_score).where("score > 0")

    def postings(self, name: str) -> DataFrame:
        """``term, key, tf``: the inverted index of a field, to be written as a table."""
        return self.tokens.select(self.key, F.explode(f"_t_{name}").alias("term")).groupBy("term", self.key).agg(F.count("*").alias("tf"))

    def statistics(self, name: str) -> DataFrame:
        """``term, df`` of a field."""
        return self.postings(name).groupBy("term").agg(F.count("*").alias("df"))


def vector_search(table: DataFrame, vector: Sequence[float], top_k: int = 100, *, key: str, embedding: str = "embedding", min_score: float | None = None, digits: int | None = None) -> DataFrame:
    """The nearest rows by exact cosine; ``min_score`` applies before the cut.  The query is a literal: one scan, no shuffle but the top k of each task."""
    if not 0 < top_k <= MOST_VECTOR_HITS:
        raise InputError(f"top_k is 1 to {MOST_VECTOR_HITS}")
    score = V.cosine(F.col(embedding), V.literal(vector))
    return R.top_k(table.withColumn("score", F.round(score, digits) if digits else score).where("score is not null"), top_k, "score", key, min_score)


def object_search(frames: DataFrame, labels: Sequence[str], top_k: int = 100, *, key: str = "keyframe_id", objects: str = "objects", min_score: float | None = None, exact: bool = False) -> DataFrame:
    """Frames that have one of the labels, scored by their most confident one.

    The cut to ``top_k`` comes before the scoring, by key, and ``min_score`` after it, as
    the service does; ``exact`` scores first.
    """
    score = F.array_max(F.transform(F.filter(F.array(*map(F.lit, labels)), lambda n: F.map_contains_key(objects, n)), lambda n: F.element_at(objects, n)))
    hits = frames.where(F.arrays_overlap(F.map_keys(objects), F.array(*map(F.lit, labels))))
    if not exact:
        hits = hits.orderBy(key).limit(top_k)
    hits = hits.withColumn("score", score)
    hits = hits if min_score is None else hits.where(F.col("score") >= min_score)
    hits = hits.orderBy(F.desc("score"), key)
    return hits.limit(top_k) if exact else hits


# The columns of a hit, the tables of the service, and the fields that each kind of text search reads.
HIT = ("keyframe_id", "video_id", "shot_id", "frame_idx", "timestamp_ms", "score")
TABLES = ("frames", "shots", "transcript_segments", "frame_text", "vectors")


TEXTS = {"ocr": {"ocr_text": "ocr_text", "ocr_api": "ocr_api"}, "asr": {"transcript": "transcript"}, "all": {"content_all": "concat_ws(' ', ocr_text, ocr_api, caption, transcript)"}}


class Engine:
    """The read service over the served tables: ``frames, shots, transcript_segments, frame_text, vectors``."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame] | None = None, root: str = "/", indexes: dict | None = None):
        """``indexes``: a ``TextIndex`` for each of ``TEXTS`` and a ``VectorIndex`` for each model, where there are; what has none is scanned."""
        self.spark, self.root, self.indexes = spark, root, indexes or {}
        missing = [t for t in TABLES if not (t in tables if tables is not None else spark.catalog.tableExists(t))]
        if missing:
            raise StoreNotReadyError(f"no table {', '.join(missing)}")
        self.tables = tables if tables is not None else {t: spark.table(t) for t in TABLES}

    def _hits(self, df: DataFrame) -> DataFrame:
        return df.select(*HIT)

    def search_vector(self, model: str, vector: Sequence[float], top_k: int = 100, video_ids=None, min_score: float | None = None) -> DataFrame:
        if model not in DIMS:
            raise InputError(f"no model {model}")
        if model in self.indexes and not video_ids:
            return self._hits(self.indexes[model].search(vector, top_k, key="keyframe_id", min_score=min_score))
        table = R.in_videos(self.tables["vectors"].where(F.col("model") == model), video_ids).withColumnRenamed("frame_id", "keyframe_id")
        return self._hits(vector_search(table, vector, top_k, key="keyframe_id", min_score=min_score))

    def _docs(self) -> DataFrame:
        return self.tables["frame_text"].withColumnRenamed("frame_id", "keyframe_id")

    def _text(self, name: str, query: str, top_k: int, video_ids, frame_ids, min_score, fuzzy) -> DataFrame:
        docs, among = self._docs(), None
        if video_ids or frame_ids is not None:
            among = R.in_frames(R.in_videos(docs, video_ids), frame_ids)
        source = self.indexes.get(name) or TextSearch(docs, "keyframe_id", {f: F.expr(e) for f, e in TEXTS[name].items()})
        return self._hits(source.search(query, top_k, among=among, min_score=min_score, fuzzy=fuzzy))

    def search_ocr(self, query: str, top_k: int = 100, video_ids=None, frame_ids=None, min_score=None, fuzzy: bool = True) -> DataFrame:
        return self._text("ocr", query, top_k, video_ids, frame_ids, min_score, fuzzy)

    def search_asr(self, query: str, top_k: int = 100, video_ids=None, frame_ids=None, min_score=None, fuzzy: bool = True) -> DataFrame:
        return self._text("asr", query, top_k, video_ids, frame_ids, min_score, fuzzy)

    def search_all(self, query: str, top_k: int = 100, video_ids=None, frame_ids=None, min_score=None, fuzzy: bool = True) -> DataFrame:
        return self._text("all", query, top_k, video_ids, frame_ids, min_score, fuzzy)

    def search_object(self, labels: Sequence[str], top_k: int = 100, video_ids=None, frame_ids=None, min_score=None, exact: bool = False) -> DataFrame:
        frames = R.in_frames(R.in_videos(self.tables["frames"], video_ids), frame_ids)
        return self._hits(object_search(frames, labels, top_k, min_score=min_score, exact=exact))

    def get_frames(self, ids: Sequence[str]) -> DataFrame:
        return R.hydrate(ids, self.tables["frames"], "keyframe_id").withColumn("image_path", media.absolute_path(self.root, F.col("image_path")))

    def get_shots(self, video_id: str) -> DataFrame:
        return self.tables["shots"].where(F.col("video_id") == video_id).orderBy("start_ms", "shot_id")

    def get_transcript(self, video_id: str, start_ms: int, end_ms: int) -> DataFrame:
        rows = self.tables["transcript_segments"].where(F.col("video_id") == video_id)
        return rows.where(timeline.overlaps(F.col("start_ms"), F.col("end_ms"), start_ms, end_ms)).orderBy("start_ms", "seg_id")


def fuse(hits: dict[str, DataFrame], key: str = "keyframe_id", k: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of several hit lists: an addition, for scores that cannot be compared."""
    ranked = [df.select(key, F.row_number().over(Window.orderBy(F.desc("score"), key)).alias("r")) for df in hits.values()]
    return functools.reduce(DataFrame.unionByName, ranked).groupBy(key).agg(F.sum(1 / (F.col("r") + k)).alias("score"))
