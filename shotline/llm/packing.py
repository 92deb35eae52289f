"""Fixed-length training sequences from whole documents, by hierarchical multi-length packing."""

from __future__ import annotations

import functools
import os
import re
import unicodedata
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

#: Context sizes, each a power of two: a full window of any tier has no padding.
TIERS = (256, 512, 1024, 2048)
#: Tokens packed together; what doesn't fill a window goes on to the next block.
BLOCK = 1 << 21
#: A step group takes windows of about so many tokens.
STEP_TOKENS = 1 << 16
END_ID = 1
#: Pieces that are handed on at once, without and with their ids.
OUT_ROWS, OUT_IDS = 20_000, 1_000

#: Texts that the word memo may handle: Latin letters, no control or rare characters.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\u012f\u0131-\u024f]*")
#: The tokenizer's contractions, where no mark stands before them.
_CONTRACTION = re.compile(r"(?<![^\s\w])(?<!_)'(s|t|re|ve|m|ll|d)")


class Encoder:
    """Token ids of texts.

    The vocabulary has word ends, so a word's ids don't hang on its neighbours.  The words
    of many texts are found and hashed together in arrays (64 bits from a random value for
    each character), and only words not met before go to the tokenizer.  Texts outside
    plain Latin go to it whole.
    """

    _MULTIPLIER = 0x9E3779B97F4A7C15

    def __init__(self, path: str, most_words: int = 600_000):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer, self.most_words = Tokenizer.from_file(path), most_words
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        #: 0 space, 1 letter, 2 number (a word by itself), 3 any other mark; 0x01 stands for a contraction's apostrophe.
        self.kinds = np.full(0x3000, 3, np.int8)
        for i in range(0x3000):
            c = chr(i)
            self.kinds[i] = 1 if c.isalpha() or i == 1 else 2 if unicodedata.category(c)[0] == "N" else 0 if c.isspace() else 3
        self.values = np.random.default_rng(3).integers(1, 2**63, 0x3000, dtype=np.uint64)
        self.powers = self.inverses = np.empty(0, np.uint64)
        self._forget()

    def _forget(self) -> None:
        # Known hashes in order, and for each the place of its ids; arrays, for a worker's memory is short.
        self.known, self.place = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.starts, self.sizes, self.flat, self.used, self.words = np.empty(1 << 16, np.int32), np.empty(1 << 16, np.int32), np.empty(1 << 18, np.uint32), 0, 0

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        assert len(ends) == len(words), "each word ends with an id that ends words"
        k, n = self.words, len(words)
        while k + n > len(self.starts):
            self.starts, self.sizes = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.sizes, 2 * len(self.sizes))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        first = np.concatenate([[0], ends[:-1]])
        self.starts[k : k + n], self.sizes[k : k + n] = first + self.used, ends - first
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.words += n
        at = np.searchsorted(self.known, hashes)
        self.known, self.place = np.insert(self.known, at, hashes), np.insert(self.place, at, np.arange(k, k + n, dtype=np.int32))

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        if not len(self.known):
            return np.full(len(keys), -1, np.int32)
        at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        return np.where(self.known[at] == keys, self.place[at], -1)

    def _hashes(self, x: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if len(self.powers) < len(x):
            r = self._MULTIPLIER
            self.powers = np.cumprod(np.full(len(x) * 2, r, np.uint64))
            self.inverses = np.cumprod(np.full(len(x) * 2, pow(r, -1, 1 << 64), np.uint64))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.values[x] * self.powers[: len(x)])])
        return (total[starts + sizes] - total[starts]) * self.inverses[starts] + sizes.astype(np.uint64)

    def many(self, texts: list[str | None]) -> list[np.ndarray]:
        out, at, parts = [np.empty(0, np.uint32)] * len(texts), [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            if "<|" in text or not _PLAIN.fullmatch(text) or not unicodedata.is_normalized("NFC", text):
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                continue
            text = text.lower()
            at.append(i)
            parts.append(_CONTRACTION.sub(" \x01\\1 ", text) if "'" in text else text)
        if not at:
            return out
        joined = "\n".join(parts) + "\n"
        x = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = self.kinds[x]
        edge = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]) | (kind[1:] == 2)]))
        sizes = np.diff(np.append(edge, len(x)))
        word = kind[edge] > 0
        starts, sizes = edge[word], sizes[word]
        if not len(starts):
            return out
        keys, first, where = np.unique(self._hashes(x, starts, sizes), return_index=True, return_inverse=True)
        if len(self.known) + len(keys) > self.most_words:
            self._forget()
        new = np.flatnonzero(self._find(keys) < 0)
        if len(new):
            spans = ((starts[k], starts[k] + sizes[k]) for k in first[new])
            self._learn(keys[new], [joined[a:b].replace("\x01", "'") for a, b in spans])
        index = self._find(keys)[where]
        lengths = self.sizes[index].astype(np.int64)
        ends = np.cumsum(lengths)
        ids = self.flat[np.repeat(self.starts[index] - ends + lengths, lengths) + np.arange(ends[-1])]
        bounds = np.cumsum([0] + [len(t) + 1 for t in parts])
        cuts = np.concatenate([[0], ends])[np.searchsorted(starts, bounds)]
        for k, i in enumerate(at):
            out[i] = ids[cuts[k] : cuts[k + 1]]
        return out

    def __call__(self, text: str | None) -> np.ndarray:
        return self.many([text])[0]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's own, kept from task to task."""
    return Encoder(path)


def _groups(column, chars: int = 1 << 19) -> Iterator[list]:
    """Runs of texts of about so many characters."""
    texts, size = [], 0
    for x in column:
        texts.append(x.as_py())
        size += len(texts[-1] or "")
        if size >= chars:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


class Packer:
    """Packs pieces of documents as they come; ``emit`` gets (doc, start, length, sequence, offset, tier)."""

    def __init__(self, tiers, first_sequence: int, emit):
        self.tiers, self.emit, self.sequence, self.first, self.groups = sorted(tiers), emit, first_sequence, first_sequence, 0
        self.windows: list[tuple[int, int]] = []  # (tier, sequence) of those without a step group yet
        self.pools: dict[int, list] = {t: [] for t in self.tiers}  # of (length, order, doc, start), by length
        self.order = 0

    def add(self, doc, start: int, length: int) -> None:
        """Route a piece to the smallest tier that holds it; whole windows leave at once."""
        top = self.tiers[-1]
        while length >= top:
            self._window(top, [(doc, start, top)])
            start, length = start + top, length - top
        if length:
            self.order += 1
            insort(self.pools[next(t for t in self.tiers if t >= length)], (length, self.order, doc, start))

    def _window(self, tier: int, pieces: list) -> None:
        offset = 0
        for doc, start, length in pieces:
            self.emit(doc, start, length, self.sequence, offset, tier)
            offset += length
        self.windows.append((tier, self.sequence))
        self.sequence += 1

    def balance(self) -> dict[int, str]:
        """Step groups of the windows made since the last call, by sequence: of about STEP_TOKENS each and alike in the cost of
        attention, the square of a window's length.  The windows of each tier, longest first, go round the groups, beginning with
        those that cost least so far; so groups have as many of each tier, but for one."""
        n = max(1, round(sum(t for t, _ in self.windows) / STEP_TOKENS))
        cost, out = [0] * n, {}
        for tier in sorted({t for t, _ in self.windows}, reverse=True):
            turn = sorted(range(n), key=lambda k: (cost[k], k))
            for i, sequence in enumerate(x for t, x in self.windows if t == tier):
                k = turn[i % n]
                cost[k] += tier * tier
                out[sequence] = f"{self.first}:{self.groups + k}"
        self.groups += n
        self.windows = []
        return out

    def _take(self, gap: int, tiers: list[int]):
        """The longest pending piece of at most ``gap`` tokens."""
        for t in reversed(tiers):
            pool = self.pools[t]
            if k := bisect_right(pool, (gap, float("inf"))):
                return pool.pop(k - 1)
        return None

    def _cut(self, gap: int, tiers: list[int]):
        """The head of the shortest pending piece, which is longer than the gap; its rest is routed again."""
        for t in tiers:
            if self.pools[t]:
                length, _, doc, start = self.pools[t].pop(0)
                self.add(doc, start + gap, length - gap)
                return gap, 0, doc, start
        return None

    def pending(self, tiers: list[int]) -> int:
        return sum(x[0] for t in tiers for x in self.pools[t])

    def pack(self) -> None:
        """Fill windows of each tier, longest first; the gaps take pieces of the same and shorter tiers."""
        for i in range(len(self.tiers) - 1, -1, -1):
            tier, lower = self.tiers[i], self.tiers[: i + 1]
            while self.pools[tier] and self.pending_at_least(lower, tier):
                self._fill(tier, lower)

    def pending_at_least(self, tiers: list[int], n: int) -> bool:
        left = n
        for t in reversed(tiers):
            for x in reversed(self.pools[t]):
                left -= x[0]
                if left <= 0:
                    return True
        return False

    def _fill(self, tier: int, tiers: list[int]) -> None:
        gap, pieces = tier, []
        while gap:
            length, _, doc, start = self._take(gap, tiers) or self._cut(gap, tiers)
            pieces.append((doc, start, length))
            gap -= length
        self._window(tier, pieces)

    def finish(self) -> None:
        """What is left: windows of ever shorter tiers, then one padded sequence."""
        self.pack()
        for tier in [*reversed(self.tiers), *(2**k for k in range(self.tiers[0].bit_length() - 2, 5, -1))]:
            while self.pending(self.tiers) >= tier:
                self._fill(tier, self.tiers)
        rest = [(doc, start, length) for t in reversed(self.tiers) for length, _, doc, start in reversed(self.pools[t])]
        if rest:
            self._window(self.tiers[-1], rest)
        self.pools = {t: [] for t in self.tiers}


def _packed(path: str, tiers, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, held, rows = encoder(path).many, {}, []

        def emit(doc, start, length, sequence, offset, tier):
            doc_id, ids = held[doc]
            part = np.ascontiguousarray(ids[start : start + length], dtype="<u4")
            rows.append((doc_id, start, length, zlib.crc32(part.tobytes()), len(ids), sequence, offset, tier, *([part] if with_ids else [])))

        def out() -> Iterator[pa.RecordBatch]:
            if rows:
                steps = packer.balance()
                cols = list(zip(*rows, strict=True))
                cols.insert(8, [steps[x] for x in cols[5]])
                kinds = [pa.int64()] * 7 + [pa.int32(), pa.string()]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]
                size = OUT_IDS if with_ids else OUT_ROWS
                for i in range(0, len(rows), size):
                    arrays = [pa.array(c[i : i + size], t) for c, t in zip(cols, kinds, strict=False)]
                    if with_ids:
                        parts = cols[9][i : i + size]
                        arrays.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(np.concatenate(parts).astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(arrays, [*names, "ids"][: len(arrays)])
                rows.clear()

        packer = Packer(tiers, TaskContext.get().partitionId() << 40, emit)
        waiting, number = 0, 0
        for batch in batches:
            encoded = (ids for texts in _groups(batch.column(1)) for ids in encode(texts))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                ids = np.append(ids, np.uint32(END_ID))
                held[number] = (doc_id, ids)
                packer.add(number, 0, len(ids))
                number += 1
                waiting += len(ids)
                if waiting >= BLOCK:
                    packer.pack()
                    yield from out()
                    waiting = 0
                    alive = {x[2] for pool in packer.pools.values() for x in pool}
                    held = {k: v for k, v in held.items() if k in alive}
        packer.finish()
        yield from out()

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, tiers=TIERS, with_ids: bool = False) -> DataFrame:
    """Pack ``docs(doc_id, text)`` into sequences of at most ``max(tiers)`` tokens.

    Each document becomes its ids and END_ID.  Whole windows of the longest context leave
    it first; the rest is routed to the smallest tier that holds it.  Windows of each tier
    are filled with the longest piece that fits, the gaps of long windows with pieces of
    shorter tiers, and the last gap with a cut.  So every window is full; only the end of
    a partition has one padded sequence.  The windows of a block are dealt to step groups of
    about STEP_TOKENS tokens, each with as many windows of each tier but for one, so the
    groups of a block cost alike.

    A partition of the input is packed by one task in blocks of BLOCK tokens, without a
    shuffle; the same split gives the same sequences, so a lost task can run again.

    Returns a row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, tier, step_group`` and, if asked for, its ``ids``.  A null or empty
    text is END_ID alone.  Repeated rows and null ids are packed like any other; other
    columns are not read; an empty table gives an empty one.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers are powers of two")
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, tier int, step_group string"
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.transform(arrow_map, _packed(str(tokenizer), tuple(tiers), with_ids), schema + ", ids array<int>" * with_ids)


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
