"""Document quality by attention-based multiple-instance learning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, give_back

#: Words of a passage; labelled documents that a fit uses at most, and passages of one; documents with a score below CUT are rejected.
PASSAGE, SAMPLE, BAG, CUT, SEED = 128, 3_000, 32, 0.3, 5
_CLASSES = 16


def _byte_classes() -> np.ndarray:
    out = np.full(256, 15, np.int64)  # other ASCII marks
    out[128:] = 14
    for k, chars in enumerate((b" \t\x0b\x0c", b"\r\n", b"aeiou", b"bcdfghjklmnpqrstvwxyz", b"AEIOU", b"BCDFGHJKLMNPQRSTVWXYZ", b"0123456789", b".", b",;:", b"!?", b"'\"", b"-_/", b"#$%&*", b"|<>{}[]()")):
        out[list(chars)] = k
    return out


_LUT = _byte_classes()
FEATURES = _CLASSES * _CLASSES + 5


def passages(text: str | None) -> np.ndarray:
    """A row of features for each passage of PASSAGE words of the whole text: frequencies of pairs of
    byte classes, shares of distinct and of repeated words, mean word length, and size."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = max(1, -(-len(words) // PASSAGE))
    out = np.zeros((n, FEATURES), np.float32)
    if not words:
        return out
    x = _LUT[np.frombuffer(raw, np.uint8)]
    inside = x > 1
    starts = inside & ~np.concatenate([[False], inside[:-1]])
    # The bytes that end words are those that split() has: space and 0x09-0x0d.
    at = np.minimum(np.maximum(np.cumsum(starts) - 1, 0) // PASSAGE, n - 1)
    pairs = np.bincount(at[:-1] * 256 + x[:-1] * 16 + x[1:], minlength=n * 256).reshape(n, 256) if len(x) > 1 else np.zeros((n, 256))
    out[:, :256] = np.sqrt(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1))
    for i in range(n):
        part = words[i * PASSAGE : (i + 1) * PASSAGE]
        m = len(part)
        out[i, 256:] = len(set(part)) / m, sum(a == b for a, b in zip(part, part[1:], strict=False)) / m, min(sum(map(len, part)) / m / 10, 5), np.log1p(m) / 5, 1
    return out


class Model:
    """h = tanh(W x); attention a = softmax(w (tanh(V h) * sigmoid(U h))); score = sigmoid(c . sum(a h) + d)."""

    def __init__(self, hidden: int = 24, attention: int = 12, seed: int = SEED):
        r = np.random.default_rng(seed)
        self.mean, self.std = np.zeros(FEATURES), np.ones(FEATURES)
        self.p = {"W": r.normal(0, FEATURES**-0.5, (FEATURES, hidden)), "V": r.normal(0, hidden**-0.5, (hidden, attention)), "U": r.normal(0, hidden**-0.5, (hidden, attention)), "w": r.normal(0, 0.1, attention), "c": r.normal(0, 0.1, hidden), "d": np.zeros(1)}

    def _forward(self, x: np.ndarray, bag: np.ndarray, starts: np.ndarray):
        p = self.p
        h = np.tanh(x @ p["W"])
        v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-h @ p["U"]))
        e = (v * u) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        return h, v, u, a, z, 1 / (1 + np.exp(-(z @ p["c"] + p["d"][0])))

    def fit(self, bags: list[np.ndarray], y: np.ndarray, steps: int = 400, size: int = 128, rate: float = 0.01, decay: float = 1e-4) -> None:
        # In double precision stand only a few columns, or the bags of a step, at a time.
        for j in range(0, FEATURES, 32):
            part = np.concatenate([b[:, j : j + 32] for b in bags]).astype(np.float64)
            self.mean[j : j + 32], self.std[j : j + 32] = part.mean(axis=0), part.std(axis=0) + 0.01
        self.mean[-1], self.std[-1] = 0, 1
        r, p = np.random.default_rng(SEED), self.p
        m, s = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        classes = [np.flatnonzero(y == c) for c in (0, 1)]
        for t in range(1, steps + 1):
            # Half of each step from each class: the score is then not drawn to the larger one.
            pick = np.concatenate([r.choice(c, size // 2) for c in classes])
            x, starts = (np.concatenate([bags[i] for i in pick]) - self.mean) / self.std, np.cumsum([0] + [len(bags[i]) for i in pick[:-1]])
            bag = np.repeat(np.arange(len(pick)), [len(bags[i]) for i in pick])
            h, v, u, a, z, out = self._forward(x, bag, starts)
            d = (out - y[pick]) / len(pick)
            dz = d[:, None] * p["c"]
            da = (dz[bag] * h).sum(axis=1)
            de = a * (da - np.add.reduceat(a * da, starts)[bag])
            dv, du = de[:, None] * p["w"] * u * (1 - v**2), de[:, None] * p["w"] * v * u * (1 - u)
            dh = a[:, None] * dz[bag] + dv @ p["V"].T + du @ p["U"].T
            g = {"c": z.T @ d, "d": np.array([d.sum()]), "w": (v * u).T @ de, "V": h.T @ dv, "U": h.T @ du, "W": x.T @ (dh * (1 - h**2))}
            for k in p:
                g[k] = g[k] + decay * p[k]
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.empty(0)
        sizes = [len(b) for b in bags]
        x = (np.concatenate(bags) - self.mean) / self.std
        return self._forward(x, np.repeat(np.arange(len(bags)), sizes), np.cumsum([0, *sizes[:-1]]))[-1]


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For a fit, BAG passages of each text at most, drawn by the text's hash."""
    for batch in batches:
        hashes, bags = [], []
        for t in batch.column(1):
            text = t.as_py()
            h, x = xxhash.xxh64_intdigest((text or "").encode("utf-8", "surrogatepass")) >> 1, passages(text)
            if len(x) > BAG:
                x = x[np.sort(np.random.default_rng(h).choice(len(x), BAG, replace=False))]
            hashes.append(h)
            bags.append(x.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.int64()), pa.array(bags, pa.binary())], ["doc_id", "h", "x"])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on ``labels(doc_id, quality)``: at most ``sample`` labelled documents, picked by hash, and BAG passages of each.

    So the driver gets 100 MB at most.  Null ids and labels are passed over; of several
    labels of one document the largest counts, of several texts the one of the least hash.
    None if the labels do not have both classes.
    """
    rows = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    rows = rows.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample)
    quality = {d: q for d, q in rows.collect()}
    ids = docs.sparkSession.createDataFrame([(d,) for d in quality], "doc_id bigint")
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bags = src.join(F.broadcast(ids), "doc_id", "left_semi").transform(arrow_map, _bags, "doc_id bigint, h bigint, x binary")
    got = bags.groupBy("doc_id").agg(F.min(F.struct("h", "x")).alias("b")).select("doc_id", "b.x").toArrow()
    got = sorted(zip(got["doc_id"].to_pylist(), (x.as_buffer() for x in got["x"]), strict=True), key=lambda r: r[0])
    y = np.array([float(quality[d] > 0) for d, _ in got])
    model = None
    if (y == 0).any() and (y == 1).any():
        model = Model()
        model.fit([np.frombuffer(x, np.float32).reshape(-1, FEATURES) for _, x in got], y)
    del got
    give_back(docs.sparkSession)
    return model


def _scored(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for i in range(0, batch.num_rows, 256):
                bags = [passages(t.as_py()) for t in batch.column(1)[i : i + 256]]
                scores += model.score(bags).tolist() if model else [1.0] * len(bags)
            yield pa.RecordBatch.from_arrays([pa.array(scores, pa.float64()), *batch.columns[2:]], ["score", *batch.schema.names[2:]])

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, score`` for each row of ``docs(doc_id, text)``: how likely the label is 1, from the whole text.

    A null or empty text is one passage without words; texts may be of any length.  Without
    a model every score is 1.  Repeated rows are scored alike, an empty table gives an empty
    one; other columns, whatever their names, are not read.
    """
    src = docs.select(F.lit(None).cast("int").alias("unused"), F.col("text").cast("string").alias("text"), F.col("doc_id").cast("bigint").alias("doc_id"))
    return src.transform(arrow_map, _scored(model), "score double, doc_id bigint").select("doc_id", "score")


def keep_good(docs: DataFrame, model: Model | None, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``cut``, all columns as they are."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                scores = model.score([passages(t.as_py()) for t in part.column(at)]) if model else np.ones(part.num_rows)
                yield part.filter(pa.array(scores >= cut))

    return docs.transform(arrow_map, run, docs.schema)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op8_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
