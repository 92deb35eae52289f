"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

DIM, N, SEED = 1024, 3, 11
#: Training documents of a language, about: a hash picks this share of those that may be learned from.
SAMPLE = 600
UNKNOWN = "und"
#: Languages whose prototypes the driver and the workers hold at most; more are an error.
MOST_LANGUAGES = 20_000


class Profiles:
    """Text vectors: each letter has a random vector of +1 and -1; an n-gram binds (multiplies)
    its letters' vectors, each rotated by its distance from the end; a text bundles (adds) its n-grams."""

    def __init__(self, dim: int = DIM, n: int = N, seed: int = SEED, most: int = 60_000):
        self.dim, self.n, self.seed, self.most = dim, n, seed, most
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.grams = np.empty((1024, dim), np.int8)
        self.is_letter = np.fromiter((chr(i).isalpha() for i in range(0x10000)), bool, 0x10000)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = np.random.default_rng([self.seed, code]).integers(0, 2, self.dim, dtype=np.int8) * 2 - 1
        return self.letters[code]

    def _row(self, key: int) -> int:
        k = len(self.rows)
        if k == len(self.grams):
            self.grams = np.concatenate([self.grams, np.empty_like(self.grams)])
        v = np.ones(self.dim, np.int8)
        for j in range(self.n):
            v *= np.roll(self.letter(key >> 21 * j & 0x1FFFFF), j)
        self.grams[k] = v
        self.rows[key] = k
        return k

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """N-gram keys and counts over lower-cased letters; anything else is a gap between words.  None without letters."""
        if not text:
            return None
        x = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        low = x < 0x10000
        ok = self.is_letter[np.where(low, x, 0)] & low
        if not low.all():
            ok |= np.fromiter((c >= 0x10000 and chr(c).isalpha() for c in x), bool, len(x))
        if not ok.any():
            return None
        x = np.concatenate([[0], np.where(ok, x, 0), [0]])
        x = x[np.concatenate([[True], (x[1:] != 0) | (x[:-1] != 0)])]
        key = np.zeros(len(x) - self.n + 1, np.int64)
        for j in range(self.n):
            key = key << 21 | x[j : j + len(key)]
        return np.unique(key, return_counts=True)

    def vector(self, text: str | None) -> np.ndarray | None:
        """The unit vector of a text, or None if it has no letters."""
        got = self.counts(text)
        if got is None:
            return None
        if len(self.rows) > self.most:
            self.rows.clear()
        rows = self.rows
        at = [rows[k] if k in rows else self._row(k) for k in got[0].tolist()]
        out = np.zeros(self.dim, np.float32)
        weights = got[1].astype(np.float32)
        for i in range(0, len(at), 4096):
            out += weights[i : i + 4096] @ self.grams[at[i : i + 4096]].astype(np.float32)
        norm = np.linalg.norm(out)
        return out / norm if norm else out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each language of the partition; whole numbers, so that the sum doesn't hang on its order."""
    profiles, total = Profiles(), {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            v = profiles.vector(text.as_py())
            if v is not None:
                total[lang] = total.get(lang, 0) + np.rint(v * 1e6).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))], ["lang", "v"])


def learn(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Prototypes of the languages of ``docs(doc_id, text, lang)``: names, and unit vectors.

    About ``sample`` documents a language are used, picked by a hash of doc_id (a null one
    is not picked; rows of one doc_id are picked together).  Nulls, texts without letters
    and an empty table teach nothing.  More than MOST_LANGUAGES languages raise an error.
    """
    rows = docs.where("lang is not null and text is not null").select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    share = rows.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(sample)) / F.count("*")).alias("share"))
    known = share.count()
    if known > MOST_LANGUAGES:
        raise ValueError(f"{known} languages; {MOST_LANGUAGES} at most can be held")
    picked = rows.join(F.broadcast(share), "lang").where((F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 20)) <= F.col("share") * (1 << 20)))
    sums = picked.select("lang", "text").transform(arrow_map, _sums, "lang string, v array<bigint>").select("lang", F.posexplode("v")).groupBy("lang", "pos").agg(F.sum("col").alias("v"))
    got: dict[str, np.ndarray] = {}
    for lang, pos, v in sums.collect():
        got.setdefault(lang, np.zeros(DIM))[pos] = v
    names = sorted(got)
    if not names:
        return [], np.zeros((0, DIM), np.float32)
    protos = np.array([got[x] / max(np.linalg.norm(got[x]), 1e-9) for x in names])
    return names, protos.astype(np.float32)


def _predict(names: list[str], protos: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles()
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(1):
                v = profiles.vector(text.as_py())
                if v is None or not names:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosines = protos @ v
                k = int(np.argmax(cosines))
                langs.append(names[k])
                scores.append(float(min(1.0, max(0.0, cosines[k]))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, names: list[str], protos: np.ndarray) -> DataFrame:
    """``doc_id, lang_pred, score`` for each row of ``docs(doc_id, text)``: the language whose
    prototype has the largest cosine with the whole text, and that cosine (0 at least).

    Of equally near languages the first in alphabetical order counts.  Without letters (null
    and empty texts too), or without anything learned, the language is ``und`` and the score
    0.  Texts may be of any length; repeated rows are predicted alike, an empty table gives
    an empty one; other columns, whatever their names, are not read.
    """
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.transform(arrow_map, _predict(names, protos), "doc_id bigint, lang_pred string, score double")


def op3_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = lambda: F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    names, protos = learn(docs.where(~held()))
    return predict(docs, names, protos).select("doc_id", held().alias("held_out"), "lang_pred", "score")
