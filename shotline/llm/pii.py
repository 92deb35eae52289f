"""Personal data: base patterns, and a skip-chain conditional random field that adds other mentions of what they find."""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

KINDS = ("email", "ip", "card", "phone")
#: Labels of a token: 0 is none, then KINDS.
LABELS = 1 + len(KINDS)
#: Documents with digits or @ that a fit uses at most, and characters around these that it takes of one; probability from which
#: a token is added; characters between two tokens that are still neighbours; message rounds.
SAMPLE, MOST_CHARS, SURE, NEAR, ROUNDS, SEED = 2_000, 8_192, 0.6, 3, 30, 7
#: Least characters of an address's local part, and digits, that count as the same name or number elsewhere.
NAME, TAIL = 4, 7

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_MARKED = re.compile(r"[0-9@]+")
_SPACES = " \n\t\r\x0b\x0c"
_RUN = re.compile(r"[^ \n\t\r\x0b\x0c]+")
_EDGE = ".,;:!?()[]{}<>\"'"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """For each of KINDS, the pattern's leftmost matches that pass its test, in time linear in the text."""
    emails, lo, at = [], 0, text.find("@")
    while at >= 0:
        # No @ is in a local part: a match exists if one stands before this @ and a domain behind it.
        start = at
        while start > lo and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            emails.append((start, m.end()))
            lo = m.end()
        at = text.find("@", max(at + 1, lo))
    ips, cards, phones = [], [], []
    if _DIGITS.search(text):
        ips = [m.span() for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))] if "." in text else []
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
        if "+" in text:
            phones = [m.span() for m in _PHONE.finditer(text) if 9 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15]
    return [emails, ips, cards, phones]


def _plain(word: str) -> str:
    return "".join(c for c in word.lower() if c.isalnum())


class Graph:
    """The candidate tokens of some documents, their base labels (-1: open) and their edges.

    A candidate is a run without white space that has a digit or an @, or that repeats the
    local part of one of its document's addresses; any other token is fixed to no label,
    and its influence is a constant of its neighbour's features.  Chain edges join
    neighbours; skip edges join a token to the next one in the document that has the same
    letters and digits, the same name before an @, or the same last TAIL digits.
    """

    def __init__(self):
        self.docs, self.spans, self.features, self.given = [], [], [], []
        self.chain, self.skip = [], []

    def add(self, doc: int, text: str, base: list[list[tuple[int, int]]]) -> None:
        tokens, last = [], 0
        for m in _MARKED.finditer(text):
            if m.start() < last:
                continue
            start = max(last, 1 + max(text.rfind(c, last, m.start()) for c in _SPACES))
            end = m.end()
            while end < len(text) and text[end] not in _SPACES:
                end += 1
            tokens.append((start, end))
            last = end
        names = {x for a, b in base[0] if len(x := text[a : text.index("@", a)].lower()) >= NAME}
        if names:
            tokens = sorted({*tokens, *(m.span() for m in _RUN.finditer(text) if m[0].strip(_EDGE).lower() in names)})
        if not tokens:
            return
        label, whole = [-1] * len(tokens), {}
        for kind in range(len(KINDS)):
            k = 0
            for a, b in base[kind]:
                while k < len(tokens) and tokens[k][1] <= a:
                    k += 1
                j = k
                while j < len(tokens) and tokens[j][0] < b:
                    if label[j] < 0:
                        label[j] = kind + 1
                    j += 1
                if j - k > 1:  # a number in several tokens: its last one stands for it
                    whole[j - 1] = "".join(_DIGITS.findall(text[a:b]))
        first, seen = len(self.docs), {}
        for k, (a, b) in enumerate(tokens):
            word, n = text[a:b], first + k
            digits = "".join(_DIGITS.findall(word))
            near = k > 0 and a - tokens[k - 1][1] <= NEAR
            after = k + 1 < len(tokens) and tokens[k + 1][0] - b <= NEAR
            self.docs.append(doc)
            self.spans.append((a, b))
            self.given.append(label[k])
            self.features.append(_shape(word, digits, near, after))
            if near:
                self.chain.append((n - 1, n))
            keys, name = {"w" + _plain(word)}, word.partition("@")[0].strip(_EDGE).lower()
            if len(name) >= NAME and ("@" in word or name in names):
                keys.add("n" + name)
            keys |= {"d" + x[-TAIL:] for x in (digits, whole.get(k, "")) if len(x) >= TAIL}
            self.skip += sorted({(seen[key], n) for key in keys if key in seen and (n - 1 != seen[key] or not near)})
            seen.update(dict.fromkeys(keys, n))


def _shape(word: str, digits: str, near: bool, after: bool) -> list[float]:
    n, m = len(word), len(digits)
    return [
        1.0, "@" in word, word.count("@") > 1, "." in word.rpartition("@")[2], word[0] == "+", word[0] == "(", ")" in word, "-" in word,
        word.count(".") == 3, word.count(".") not in (0, 3), m == n, m == 0, m == 1, m == 2, m == 3, m == 4, m in (5, 6), 7 <= m <= 12, m >= 13,
        any(c.isalpha() for c in word), m / n > 0.6, n > 12, near, after,
    ]


class Field:
    """Weights of the field, and loopy message passing over a graph."""

    def __init__(self, n_features: int):
        self.unary, self.chain, self.skip = np.zeros((n_features, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))

    def fit(self, g: Graph, truth: list[int], weight: list[float], steps: int = 400, rate: float = 0.1, decay: float = 1e-4) -> None:
        """Weighted maximum pseudo-likelihood: each token's label in turn is hidden and has to be told from its features and
        the labels around it.  All three matrices are learned, none is set."""
        x, y, u = np.array(g.features, float), np.array(truth), np.array(weight, float)[:, None]
        one = np.eye(LABELS)[y]
        chain, skip = (np.array(e, int).reshape(-1, 2) for e in (g.chain, g.skip))
        params = (self.unary, self.chain, self.skip)
        m, s = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for t in range(1, steps + 1):
            z = x @ self.unary
            for e, w in ((chain, self.chain), (skip, self.skip)):
                np.add.at(z, e[:, 1], w[y[e[:, 0]]])
                np.add.at(z, e[:, 0], w.T[y[e[:, 1]]])
            p = np.exp(z - z.max(axis=1, keepdims=True))
            d = (p / p.sum(axis=1, keepdims=True) - one) * u / u.sum()
            grads = [x.T @ d, *(one[e[:, 0]].T @ d[e[:, 1]] + d[e[:, 0]].T @ one[e[:, 1]] for e in (chain, skip))]
            for k, (p, grad) in enumerate(zip(params, grads, strict=True)):
                grad = grad + decay * p
                m[k], s[k] = 0.9 * m[k] + 0.1 * grad, 0.999 * s[k] + 0.001 * grad**2
                p -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
        self.skip[:] = (self.skip + self.skip.T) / 2  # which of two mentions comes first tells nothing

    def marginals(self, g: Graph, skips: bool = True) -> np.ndarray:
        """P(label) of every token, with the base labels given."""
        given, skip = np.array(g.given), g.skip if skips else []
        unary = np.array(g.features, float) @ self.unary
        unary[given >= 0] = -60.0
        unary[given >= 0, given[given >= 0]] = 0.0
        edges = np.array(g.chain + skip, int).reshape(-1, 2)
        weights = np.concatenate([np.repeat(self.chain[None], len(g.chain), axis=0), np.repeat(self.skip[None], len(skip), axis=0)])
        src, dst = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        weights = np.concatenate([weights, weights.transpose(0, 2, 1)])
        n, back = len(edges), np.roll(np.arange(2 * len(edges)), len(edges))
        messages = np.zeros((2 * n, LABELS))
        belief = unary.copy()
        for _ in range(ROUNDS if n else 0):
            z = (belief[src] - messages[back])[:, :, None] + weights
            top = z.max(axis=1, keepdims=True)
            new = top[:, 0] + np.log(np.exp(z - top).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - messages).max()
            messages = 0.5 * messages + 0.5 * new
            belief = unary.copy()
            np.add.at(belief, dst, messages)
            if change < 1e-3:
                break
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def other_mention(kind: str, found: str, r: random.Random) -> str:
    """What was found, written so that its base pattern does not match."""
    digits = "".join(_DIGITS.findall(found))
    if kind == "email":
        name, _, host = found.partition("@")
        return r.choice([f"{name}@{host.partition('.')[0]}", f"{name} at {host.partition('.')[0]}"])
    if kind == "ip":
        return found.replace(".", r.choice("-_:"))
    if kind == "card":
        return r.choice([digits[-8:], "/".join(digits[i : i + 4] for i in range(0, len(digits), 4)), digits[:4] + "." + digits[4:]])
    return r.choice([digits[-TAIL:], f"{digits[-7:-4]}-{digits[-4:]}", f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}", digits[-10:]])


def with_hidden(texts: list[str], seed: int = SEED) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Each text with further lines: another mention of something that it has, and one of something that another text has.
    Gives the new text and the places of these lines with their label: the kind for the first, 0 for the second."""
    r = random.Random(seed)
    found = [[(kind, t[a:b]) for kind, spans in zip(KINDS, base_spans(t), strict=True) for a, b in spans] for t in texts]
    pool, out = [x for f in found for x in f], []
    for text, own in zip(texts, found, strict=True):
        lines = [(KINDS.index(kind) + 1, other_mention(kind, what, r)) for kind, what in ([r.choice(own)] if own else [])]
        strange = [x for x in r.sample(pool, min(3, len(pool))) if x not in own and x[1][-TAIL:] not in text]
        lines += [(0, other_mention(*x, r)) for x in strange[:1]]
        r.shuffle(lines)
        places = []
        for label, line in lines:
            text += "\n"
            places.append((len(text), len(text) + len(line), label))
            text += line
        out.append((text, places))
    return out


def fit(texts: list[str]) -> Field | None:
    """A field for ``texts``: the base patterns label what they find, and hidden mentions are what it has to restore.

    An open token is taken for no personal data, unless it repeats something found: then it
    is not learned from.  So that no shape alone decides, mentions of what the document has
    not are among the examples as well.
    """
    g, truth, weight, rows = Graph(), [], [], with_hidden(texts)
    for k, (text, places) in enumerate(rows):
        size = len(g.docs)
        g.add(k, text, base_spans(text))
        for n in range(size, len(g.docs)):
            hidden = next((label for a, b, label in places if a <= g.spans[n][0] < b), None)
            truth.append(max(g.given[n], 0) if hidden is None else hidden)
            weight.append(0.0 if hidden is not None and g.given[n] > 0 else 1.0 if hidden is None else -1.0)
    if not truth:
        return None
    unsure = {a if g.given[a] < 0 else b for a, b in g.skip if (g.given[a] > 0) != (g.given[b] > 0)}
    for n in unsure:
        if weight[n] > 0:
            weight[n] = 0.0
    # Hidden mentions weigh as much as all else together, however many other tokens there are.
    each = max(1.0, sum(w for w in weight if w > 0) / max(1, sum(w < 0 for w in weight)))
    field = Field(len(g.features[0]))
    field.fit(g, truth, [each if w < 0 else w for w in weight])
    return field


def learn(docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    """Fit on at most ``sample`` documents that have a digit or an @, picked by hash, and at most MOST_CHARS characters of each.

    Rows without a doc_id are not learned from; of several rows of one, the text of the
    least hash is.  None if nothing can be learned.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@]"))
    ids = rows.select("doc_id").distinct().orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample)
    parts = rows.join(F.broadcast(ids), "doc_id", "left_semi").transform(arrow_map, _windows, "doc_id bigint, h bigint, text string")
    texts = parts.groupBy("doc_id").agg(F.min(F.struct("h", "text")).alias("x")).select("doc_id", "x.text").collect()
    return fit([text for _, text in sorted(map(tuple, texts))])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For a fit, only what stands around candidate tokens; of a text with much of it, pieces drawn by hash."""
    for batch in batches:
        hashes, texts = [], []
        for value in batch.column(1):
            text, pieces = value.as_py(), []
            for m in _MARKED.finditer(text):
                low = pieces[-1][1] if pieces else 0
                if m.start() < low:
                    continue
                start, end = max(low, 1 + max(text.rfind(c, low, m.start()) for c in _SPACES)), m.end()
                while end < len(text) and text[end] not in _SPACES:
                    end += 1
                if pieces and start - low <= 2 * NEAR and end - pieces[-1][0] <= MOST_CHARS // 32:
                    pieces[-1][1] = end
                else:
                    pieces.append([start, end])
            parts, size, keep = [text[a:b] for a, b in pieces], 0, []
            for k in sorted(range(len(parts)), key=lambda k: xxhash.xxh64_intdigest(parts[k].encode("utf-8", "surrogatepass"), k)):  # noqa: B023
                size += len(parts[k])
                if size > MOST_CHARS:
                    break
                keep.append(k)
            texts.append("\n".join(parts[k] for k in sorted(keep)))
            hashes.append(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "h", "text"])


def find(texts: list[str], field: Field | None, skips: bool = True) -> list[list[list[tuple[int, int]]]]:
    """For each text the spans of KINDS, base ones, and then those that the field adds for each of KINDS."""
    out, g = [], Graph()
    for k, text in enumerate(texts):
        base = base_spans(text)
        out.append([*base, *([] for _ in KINDS)])
        if field:
            g.add(k, text, base)
    if field and g.docs:
        p = field.marginals(g, skips)
        best = p.argmax(axis=1)
        for n in np.flatnonzero((np.array(g.given) < 0) & (best > 0) & (p.max(axis=1) >= SURE)):
            added = out[g.docs[n]][len(KINDS) + best[n] - 1]
            a, b = g.spans[n]
            if added and a - added[-1][1] <= NEAR and not texts[g.docs[n]][added[-1][1] : a].strip():
                a = added.pop()[0]
            added.append((a, b))
    return out


def hidden_recall(texts: list[str], field: Field, skips: bool = True, seed: int = SEED + 1) -> tuple[float, float]:
    """Share of hidden mentions that the field restores with their kind, and of strange ones that it takes for personal data."""
    rows = with_hidden(texts, seed)
    hit, every = [0, 0], [0, 0]
    for (text, places), got in zip(rows, find([t for t, _ in rows], field, skips), strict=True):
        taken = [a for spans in got[: len(KINDS)] for a in spans]
        for a, b, label in places:
            if any(x < b and a < y for x, y in taken):
                continue  # a base pattern has it after all
            every[label == 0] += 1
            hit[label == 0] += any(x < b and a < y for spans in (got[len(KINDS) + label - 1 :][:1] if label else got[len(KINDS) :]) for x, y in spans)
    return hit[0] / max(1, every[0]), hit[1] / max(1, every[1])


NAMES = (*KINDS, *(f"{k}_like" for k in KINDS))


def _spans_text(spans, names) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, found in zip(names, spans, strict=False) for a, b in sorted(found))


def _detect(field: Field | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for i in range(0, len(ids), 512):
                found = find([x.as_py() or "" for x in texts[i : i + 512]], field)
                base = [_spans_text(x[:4], KINDS) for x in found]
                cols = [pa.array(ids[i : i + 512], pa.int64()), *(pa.array([len(x[k]) for x in found], pa.int64()) for k in range(4))]
                cols += [pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()), pa.array([_spans_text(x, NAMES) for x in found], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return run


def detect(docs: DataFrame, field: Field | None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for each row of ``docs(doc_id, text)``.

    Counts and the hash are those of the base spans.  ``spans`` has all: base ones, then
    those that the field adds, whose kinds end in ``_like``.  Null and empty texts have
    none.  Whole texts are read, however long; repeated rows give repeated rows, an empty
    table an empty one; other columns, whatever their names, are not read.
    """
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.transform(arrow_map, _detect(field), "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def blank_out(text: str, spans) -> str:
    """``text`` with each span, or run of overlapping ones, replaced by its kind in angle brackets."""
    parts, at = [], 0
    todo = sorted((a, -b, k) for k, found in zip((*KINDS, *KINDS), spans, strict=True) for a, b in found)
    for a, b, kind in todo:
        if a >= at:
            parts += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, -b)
    return "".join(parts) + text[at:]


def redact(docs: DataFrame, field: Field | None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced and, if there is one, ``n_chars`` made to fit; all other columns as they are."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = [x.as_py() for x in part.column(at)]
                new = [None if t is None else blank_out(t, s) if any(s) else t for t, s in zip(texts, find([t or "" for t in texts], field), strict=True)]
                cols = list(part.columns)
                cols[at] = pa.array(new, part.schema.field(at).type)
                if "n_chars" in names:
                    k = names.index("n_chars")
                    old = cols[k].to_pylist()
                    cols[k] = pa.array([o if n == t else len(n) for o, n, t in zip(old, new, texts, strict=True)], part.schema.field(k).type)
                yield pa.RecordBatch.from_arrays(cols, schema=part.schema)

    return docs.transform(arrow_map, run, docs.schema)


def op5_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return detect(docs, learn(docs))
