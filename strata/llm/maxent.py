"""Language-model scoring with a hashed maximum-entropy model and a class-factored softmax.

A token's hash gives its class and, inside the class, its subclass.  The class is predicted by a softmax
over features of the history: a bias for each class, what the previous word and the word before it (a
skip) say for each class, and the hashed pair of both.  A second softmax predicts the subclass inside the
class in the same way, and inside its subclass a token has its add-one share of the training counts, with
one slot for unseen tokens, so the probabilities of all tokens sum to one.

What the words say is a table in Spark with one row for each word of ``MIN_COUNT`` training occurrences or
more, so it grows with the corpus: the log ratio of a class after that word to the class anywhere, drawn
towards zero by ``PRIOR`` occurrences, in steps of 1/16.  How far each kind of word feature counts for each
class, the biases and the pair weights are trained by gradient rounds: every task sums gradients over
its texts, Spark adds them up, and the weights, whose number is fixed, move.  In training a token's own
occurrence is taken out of the word features, or they would seem to know more than they do.

The texts are tokenised once, into chunks of about ``CHUNK`` tokens that hold 32-bit numbers of the chunk's
own vocabulary.  Counts and word features are joined to the vocabularies, not to the tokens, so no row for
a text and word is ever made, and a word in every text is one row a chunk.  A chunk and what belongs to it
are stored as rows of bounded size, its pieces, and put together where they are read.  All later passes
read chunks and work on numpy arrays; only weights and class totals reach the driver.

Tokens are compared by 64-bit hashes, up to collisions.  Null and empty texts have one token, the end;
texts of any length are scored whole (a chunk holds at least one); repeated rows get equal scores and are
counted as often as they occur; rows with a null id are held out as they have no remainder; without training
rows all counts are zero and all classes equally likely; an empty table gives an empty result.  Only the
id and text columns are read, so further columns of any name have no effect.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, drop_shuffles, give_back, giving_back, load, release, remainder, saved, saved_by, words_of
from strata.llm.words import Words

CLASSES, FEATURES, ROUNDS = 32, 1 << 13, 2
MIN_COUNT, PRIOR = 32, 32.0
STEP = 16.0  # word features are stored in steps of 1 / STEP
CHUNK = 1 << 21  # tokens: the larger a chunk, the fewer rows its vocabulary adds to the joins
END = "\n"  # no word holds a newline
PART = 1 << 12  # tokens whose class probabilities are held at a time
BLOCK = 1 << 13  # words whose counts are packed at a time
# A chunk is kept as pieces, rows of well under half a MB: larger objects fragment an executor's heap.  A piece has so many
# words of the vocabulary with what belongs to them, and so many tokens and texts.
PIECE_WORDS, PIECE_TOKENS, PIECE_TEXTS = 1 << 12, 1 << 15, 1 << 12
BATCH_BYTES = 1 << 20  # of the batches that go to Python
SLICE = 128  # texts whose words are hashed together
WAVES = 4  # parts in which word features are joined to the chunks: only one part's shuffles are on the disk
HELD_OUT_DIVISOR, HELD_OUT_REMAINDER = 7, 2


def tokens(text: str | None) -> list[str]:
    return [*(words_of(ascii_lower(text)) if text else []), END]


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def class_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and subclass of token hashes (signed or not)."""
    h = h.astype(np.int64)
    return h & (CLASSES - 1), (h >> 8) & (CLASSES - 1)


def _slot(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(FEATURES - 1)).astype(np.int64) + 1


def _before(codes: np.ndarray, first: np.ndarray, end, back: int) -> np.ndarray:
    """The token ``back`` places before each one of the same text, ``end`` where there is none;
    ``first`` is where each token's text starts."""
    at = np.arange(len(codes))
    return np.where(at - back >= first, codes[np.maximum(at - back, 0)], end)


def history(codes: np.ndarray, first: np.ndarray | None = None, end: int = 1) -> np.ndarray:
    """The hashed features of each token's history: the bias (feature 0) and the pair of words before."""
    first = np.zeros(len(codes), np.int64) if first is None else first
    one, two = (_before(codes, first, end, k).astype(np.uint64) for k in (1, 2))
    return np.stack([np.zeros(len(codes), np.int64), _slot(one * np.uint64(31) + two * np.uint64(7), 37)], axis=1)


def class_logs(weights: np.ndarray, feats: np.ndarray, more: np.ndarray | float = 0.0) -> np.ndarray:
    """Log probabilities of the classes from hashed features and further logits."""
    logits = weights[feats].sum(axis=1) + more
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


class Weights:
    """All trained weights: a fixed number.  They travel as a dictionary of arrays (``vars``).  ``hashed`` (bias and pairs), ``scale`` by level (class,
    subclass), kind of word feature and class, ``inner`` (biases of the subclasses)."""

    def __init__(self, leaf: np.ndarray):
        top = leaf.sum(axis=1)
        self.hashed = np.zeros((FEATURES, CLASSES), np.float32)
        self.hashed[0] = np.log(top / top.sum())
        self.leaf = np.log(leaf / top[:, None]).astype(np.float32)  # subclasses inside each class
        self.inner = np.zeros(CLASSES, np.float32)
        self.share = np.stack([top / top.sum(), leaf.sum(axis=0) / top.sum()]).astype(np.float32)  # by level
        self.scale = np.full((2, 2, CLASSES), 0.7, np.float32)

    @classmethod
    def of(cls, arrays: dict) -> Weights:
        w = cls.__new__(cls)
        w.__dict__.update(arrays)
        return w


# --- chunks ---

def _binary(x: np.ndarray) -> pa.Array:
    """The array's bytes as one binary value, compressed here: so sorts, joins and batches hold and move
    chunks at a fraction of their size."""
    x = np.ascontiguousarray(x)
    return pa.array([x.nbytes.to_bytes(8, "little") + pa.Codec("zstd", 3).compress(x, asbytes=True)], pa.binary())


def _bytes(value: pa.Scalar) -> pa.Buffer:
    held = value.as_buffer()
    return pa.Codec("zstd").decompress(held[8:], int.from_bytes(held[:8].to_pybytes(), "little"))


def _piece(chunk: int, part: int, fields: dict) -> pa.RecordBatch:
    """A row ``(chunk, part, *fields)``; lists stay lists, what is empty is null."""
    lists = {"ids": pa.list_(pa.int64()), "learn": pa.list_(pa.bool_())}
    row = [pa.array([x or None], lists[n]) if n in lists else _binary(x) if len(x) else pa.nulls(1, pa.binary()) for n, x in fields.items()]
    return pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([part]), *row], names=["chunk", "part", *fields])


def _together(batches: Iterator[pa.RecordBatch]) -> dict:
    """The fields of a chunk from its pieces, which come in any order."""
    found: dict[str, list] = {}
    for batch in batches:
        parts = batch.column("part").to_pylist()
        for name, column in zip(batch.schema.names, batch.columns):
            if name not in ("chunk", "part"):
                values = [_bytes(v) if v.is_valid else b"" for v in column] if pa.types.is_binary(column.type) else [v or [] for v in column.to_pylist()]
                found.setdefault(name, []).extend(zip(parts, values))
    out = {}
    for name in list(found):
        values = [v for _, v in sorted(found.pop(name), key=lambda x: x[0])]
        out[name] = [x for v in values for x in v] if isinstance(values[0], list) else b"".join(values) or None
    return out


def _over_chunks(pieces: DataFrame, run: Callable[[Chunk], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``run`` on each chunk, put together from its pieces.  These lie by chunk, so nothing is shuffled."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(Chunk(_together(batches)))
        give_back()

    return pieces.groupBy("chunk").applyInArrow(task, schema)


def _encode(docs: DataFrame, chunk_tokens: int) -> DataFrame:
    """Rows ``(doc_id, text, learn)`` as pieces of chunks: the codes of all tokens in the chunk's vocabulary
    (code 0 is the end), the vocabulary's hashes and its counts in the texts to learn from."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def flush():
            nonlocal number
            # Equal hashes are one word; the vocabulary has the end and then each word, by its first occurrence.
            _, first, code = np.unique(np.concatenate([w.hashes for w in held]), return_index=True, return_inverse=True)
            order = np.argsort(first)
            rank = np.empty(len(first), np.int32)
            rank[order] = np.arange(1, len(first) + 1)
            first = first[order]
            bounds = np.cumsum([0, *(len(w.hashes) for w in held)])
            owner = np.searchsorted(bounds, first, "right") - 1
            hashes = np.fromiter((word_hash(held[o].word(at)) for o, at in zip(owner.tolist(), (first - bounds[owner]).tolist())), np.uint64, len(first))
            hashes = np.concatenate([[np.uint64(word_hash(b"\n"))], hashes]).view(np.int64)
            sizes = np.concatenate([w.sizes for w in held]) + 1
            ends = np.cumsum(sizes) - 1
            codes = np.zeros(int(sizes.sum()), np.int32)
            is_word = np.ones(len(codes), bool)
            is_word[ends] = False
            codes[is_word] = rank[code]
            seen = np.bincount(codes[np.repeat(np.array(learn, bool), sizes)], minlength=len(hashes)).astype(np.int64)
            number += 1
            fields = {"ids": (ids, PIECE_TEXTS), "learn": (learn, PIECE_TEXTS), "sizes": (sizes, PIECE_TEXTS), "codes": (codes, PIECE_TOKENS),
                      "hashes": (hashes, PIECE_WORDS), "seen": (seen, PIECE_WORDS)}
            for part in range(max(-(-len(x) // n) for x, n in fields.values())):
                yield _piece(number, part, {name: x[part * n:(part + 1) * n] for name, (x, n) in fields.items()})

        held, ids, learn, size = [], [], [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                i, text, x = (batch.column(k).slice(at, SLICE) for k in range(3))
                words = Words(text.to_pylist(), lower=True)
                room = int(np.searchsorted(np.cumsum(words.sizes + 1), chunk_tokens - size)) + 1  # the text that fills the chunk is its last
                if room < len(i):
                    i, text, x = (c.slice(0, room) for c in (i, text, x))
                    words = Words(text.to_pylist(), lower=True)
                held.append(words)
                ids += i.to_pylist()
                learn += x.to_pylist()
                size += int(words.sizes.sum()) + len(i)
                at += len(i)
                if size >= chunk_tokens:
                    yield from flush()
                    held, ids, learn, size = [], [], [], 0
        if held:
            yield from flush()

    return docs.mapInArrow(giving_back(run), "chunk long, part long, ids array<long>, learn array<boolean>, sizes binary, codes binary, hashes binary, seen binary")


def _vocabulary(chunks: DataFrame) -> DataFrame:
    """``(chunk, code, h, c, first)``: each chunk's vocabulary with the words' training counts in all chunks;
    ``first`` marks one row of each word."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                h, n = (np.frombuffer(_bytes(batch.column(k)[i]), np.int64) for k in (2, 3))
                chunk, part = (batch.column(k)[i].as_py() for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), chunk)), pa.array(np.arange(len(h)) + part * PIECE_WORDS),
                                                  pa.array(h), pa.array(n)], names=["chunk", "code", "h", "n"])

    def total(batches):
        held = None  # the rows of the word that the next batch may go on with: one a chunk at most
        names = ["chunk", "code", "h", "c", "first"]

        def out(chunk, code, h, n):
            start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            c = np.repeat(np.add.reduceat(n, start), np.diff(np.append(start, len(h))))
            first = np.zeros(len(h), bool)
            first[start] = True
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (chunk, code, h, c, first)], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(k).to_numpy() for k in range(4)]
            if held is not None:
                now = [np.concatenate(z) for z in zip(held, now)]
            whole = int(np.searchsorted(now[2], now[2][-1], "left"))
            held = [x[whole:] for x in now]
            if whole:
                yield out(*(x[:whole] for x in now))
        if held is not None:
            yield out(*held)

    rows = chunks.where("hashes is not null").select("chunk", "part", "hashes", "seen").mapInArrow(giving_back(run), "chunk long, code long, h long, n long")
    return rows.repartition("h").sortWithinPartitions("h").mapInArrow(giving_back(total), "chunk long, code long, h long, c long, first boolean")


def _by_chunk(rows: DataFrame, names: list[str]) -> DataFrame:
    """``(chunk, code, *names)`` rows (numbers, or binary values of one length) as pieces of chunks, by code."""
    def values(column: pa.Array) -> np.ndarray:
        """The column's numbers, or its binary values as rows of a matrix."""
        if not pa.types.is_binary(column.type):
            return column.to_numpy()
        bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        return np.frombuffer(column.buffers()[2], np.int8)[bounds[0]:bounds[-1]].reshape(len(column), -1)

    def run(batches):
        chunk, parts = None, []

        def flush():
            code = np.concatenate([p[0] for p in parts])
            order = np.argsort(code)
            code, *rest = (np.concatenate([p[k] for p in parts])[order] for k in range(len(names) + 1))
            parts.clear()
            ends = np.append(np.flatnonzero(np.diff(code // PIECE_WORDS)) + 1, len(code)).tolist()
            for a, z in zip([0, *ends], ends):
                yield _piece(chunk, int(code[a]) // PIECE_WORDS, {"code": code[a:z], **{n: x[a:z] for n, x in zip(names, rest)}})

        for batch in batches:
            keys = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, z in zip(cuts, cuts[1:]):
                if a == z:
                    continue
                if parts and keys[a] != chunk:
                    yield from flush()
                chunk = int(keys[a])
                parts.append([values(batch.column(k).slice(a, z - a)) for k in range(1, len(names) + 2)])
        if parts:
            yield from flush()

    # Sorted by one number only, as Spark sorts those fastest; each chunk's codes are put in order above.
    return (rows.select("chunk", "code", *names).repartition("chunk").sortWithinPartitions("chunk")
            .mapInArrow(giving_back(run), ", ".join(["chunk long", "part long", "code binary", *[f"{n} binary" for n in names]])))


class Chunk:
    """A chunk's arrays."""

    def __init__(self, r: dict):
        self.ids, self.learn = r["ids"], np.array(r["learn"], bool)
        self.sizes = np.frombuffer(r["sizes"], np.int64)
        self.codes = np.frombuffer(r["codes"], np.int32)
        self.hashes = np.frombuffer(r["hashes"], np.int64)
        self.counts = np.frombuffer(r["c"], np.int64)
        self.held = self.counts.astype(np.float32) + np.float32(PRIOR)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.one = self._shifted(1)
        self.two = self._shifted(2)
        self.top, self.sub = class_of(self.hashes)
        # Row 0 of the tables (previous word, skip) is that of words without features.
        self.rows = np.zeros(len(self.hashes), np.int32)
        features = np.zeros((0, 4 * CLASSES), np.int8)
        if r.get("features") is not None:
            features = np.frombuffer(r["features"], np.int8).reshape(-1, 4 * CLASSES)
            self.rows[np.frombuffer(r["words"], np.int64)] = np.arange(1, len(features) + 1)
        # By level (class, subclass) and kind (previous word, skip).
        self.tables = [[self._table(features, (2 * kind + level) * CLASSES) for kind in (0, 1)] for level in (0, 1)]

    @staticmethod
    def _table(features: np.ndarray, first: int) -> np.ndarray:
        out = np.zeros((len(features) + 1, CLASSES), np.int8)
        out[1:] = features[:, first:first + CLASSES]
        return out

    def _shifted(self, back: int) -> np.ndarray:
        """The token ``back`` places before each one of the same text; the end (0) where there is none."""
        out = np.zeros_like(self.codes)
        out[back:] = self.codes[:-back]
        for k in range(back):
            out[self.starts[self.sizes > k] + k] = 0
        return out

    def pairs(self, at) -> np.ndarray:
        """The hashed feature of the two words before each token."""
        h = self.hashes.view(np.uint64)
        return _slot(h[self.one[at]] * np.uint64(31) + h[self.two[at]] * np.uint64(7), 37)

    def own(self, w: Weights, level: int, kind: int, words: np.ndarray, row: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the ``words`` before some tokens say for these tokens' own classes: as the tables have it,
        and with the token's own occurrence taken out."""
        mine = self.tables[level][kind][row, cls] * np.float32(1 / STEP)
        held, p = self.held[words], w.share[level][cls]
        rest = np.maximum(np.exp(mine) * p * held - 1, 0.5 * p * PRIOR)
        return mine, np.where(row > 0, np.log(rest / ((held - 1) * p)), mine).astype(np.float32)

    def log_likelihood(self, w: Weights, at: slice) -> np.ndarray:
        """Natural log probability of each token's class and subclass."""
        start, stop, _ = at.indices(len(self.codes))
        out = np.zeros(stop - start)
        for level, cls in enumerate((self.top, self.sub)):
            factors = Factors(self, w, level)
            for a in range(start, stop, PART):
                part = slice(a, min(a + PART, stop))
                codes = self.codes[part]
                z = factors(self.rows[self.one[part]], self.rows[self.two[part]], self.top[codes] if level else self.pairs(part))
                out[a - start:part.stop - start] += np.log(z[np.arange(len(codes)), cls[codes]] / _row_sums(z))
            factors = z = None  # before the next level's are made
        return out


class Factors:
    """Unnormalised probabilities of one level's classes, as products: the exponential of what each word
    says is taken once a word of the chunk, that of hashed features and biases once in all.  Small enough for ``exp``."""

    def __init__(self, chunk: Chunk, w: Weights, level: int):
        self.words = [t * (scale * np.float32(1 / STEP)) for t, scale in zip(chunk.tables[level], w.scale[level])]
        for x in self.words:
            np.exp(x, out=x)
        self.other = np.exp(w.leaf + w.inner) if level else np.exp(w.hashed + w.hashed[0])
        self.room = np.empty((3, PART, CLASSES), np.float32)  # written anew for each part: fresh pages cost more than the sums

    def __call__(self, one: np.ndarray, two: np.ndarray, other: np.ndarray) -> np.ndarray:
        """From the rows of the two words before and the pair's feature, or for subclasses the class."""
        z, x = self.room[:2, :len(one)]
        _rows(self.words[0], one, z)
        z *= _rows(self.words[1], two, x)
        z *= _rows(self.other, other, x)
        return z


def _rows(table: np.ndarray, at: np.ndarray, out: np.ndarray) -> np.ndarray:
    return table.take(at, axis=0, out=out, mode="clip")  # no row is out of bounds; only so it writes straight to ``out``


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], x.dtype)


def _column_sums(x: np.ndarray, y: np.ndarray | None = None) -> np.ndarray:
    """Sums of the columns of ``x``, or of ``x * y``; many rows are taken as one long row."""
    n, wide = len(x) // 16 * 16, 16 * CLASSES
    if y is None:
        return x[:n].reshape(-1, wide).sum(axis=0).reshape(16, CLASSES).sum(axis=0) + x[n:].sum(axis=0)
    return (np.einsum("ij,ij->j", x[:n].reshape(-1, wide), y[:n].reshape(-1, wide)).reshape(16, CLASSES).sum(axis=0)
            + np.einsum("ij,ij->j", x[n:], y[n:]))


# --- what words say ---

def _features(chunks: DataFrame, leaf: np.ndarray) -> DataFrame:
    """``(h, features)`` of every word of ``MIN_COUNT`` occurrences: for each kind (previous word, skip)
    and level (class, subclass) the rounded log ratios of the classes after it."""
    top = leaf.sum(axis=1) / leaf.sum()
    share = np.concatenate([top, leaf.sum(axis=0) / leaf.sum()] * 2)

    def count(chunk):
        often = np.flatnonzero(chunk.counts >= MIN_COUNT)
        place = np.full(len(chunk.hashes), -1, np.int32)
        place[often] = np.arange(len(often))
        learn = np.repeat(chunk.learn, chunk.sizes)
        total = np.zeros((len(often), 4 * CLASSES), np.int32)
        for kind, w in enumerate((chunk.one, chunk.two)):
            at = place[w]
            use = learn & (at >= 0)
            at, codes = at[use] * np.int64(CLASSES), chunk.codes[use]
            for level, cls in enumerate((chunk.top, chunk.sub)):
                first = (2 * kind + level) * CLASSES
                total[:, first:first + CLASSES] = np.bincount(at + cls[codes], minlength=len(often) * CLASSES).reshape(-1, CLASSES)
        hashes = chunk.hashes[often]
        at = codes = use = learn = chunk = None
        for a in range(0, len(often), BLOCK):  # packed, all counts would take a multiple of the table's memory
            word, spot = np.nonzero(total[a:a + BLOCK])
            packed = spot << 32 | total[a + word, spot]
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1, [len(word)]])
            if len(word):
                values = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((8 * bounds).astype(np.int32)), pa.py_buffer(packed)])
                yield pa.RecordBatch.from_arrays([pa.array(hashes[a + word[bounds[:-1]]]), values], names=["h", "n"])

    def ratios(n: np.ndarray) -> np.ndarray:
        parts, p = n.reshape(len(n), 4, CLASSES), share.reshape(4, CLASSES)
        out = np.log((parts + PRIOR * p) / (parts.sum(axis=2, keepdims=True) + PRIOR) / p)
        return np.clip(np.rint(out * STEP), -127, 127).astype(np.int8).reshape(len(n), 4 * CLASSES)

    def add(batches):
        word, total = None, None  # the word that the next batch may go on with

        def emit(words, totals):
            return pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array([r.tobytes() for r in ratios(totals)], pa.binary())],
                                              names=["h", "features"])

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                h, packed = part.column(0).to_numpy(), part.column(1).to_pylist()
                start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                run = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(h))))
                x = np.frombuffer(b"".join(packed), np.int64)
                run = np.repeat(run, [len(b) // 8 for b in packed])
                words = h[start]
                totals = np.bincount(run * (4 * CLASSES) + (x >> 32), x & 0xFFFFFFFF, len(start) * 4 * CLASSES).reshape(-1, 4 * CLASSES)
                if word is not None and word == words[0]:
                    totals[0] += total
                elif word is not None:
                    yield emit([word], total[None])
                if len(words) > 1:
                    yield emit(words[:-1], totals[:-1])
                word, total = int(words[-1]), totals[-1]
        if word is not None:
            yield emit([word], total[None])

    counted = _over_chunks(chunks, count, "h long, n binary")
    return counted.repartition("h").sortWithinPartitions("h").mapInArrow(giving_back(add), "h long, features binary")


# --- training and scoring ---

@contextmanager
def _set(spark, name: str, value: str) -> Iterator[None]:
    """A setting of ``spark.sql`` for a while."""
    name = f"spark.sql.{name}"
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


# Rows go to Python in small batches, pieces one by one: Spark would put all of a task's into one batch, held
# twice outside the executor's heap.
_BATCH = "execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)
_ONE = "execution.arrow.maxRecordsPerBatch", "1"
_BY_CHUNK = "requireAllClusterKeysForCoPartition", "false"  # joins by chunk and part use that tables lie by chunk


def _gradients(chunk: Chunk, w: Weights, turn: int, turns: int, seen: np.ndarray, said: np.ndarray) -> None:
    """Adds the chunk's part of :func:`_round` to ``seen`` and ``said``."""
    hashed = FEATURES * CLASSES
    mine = chunk.learn & (np.arange(len(chunk.learn)) % turns == turn)
    chosen = np.flatnonzero(np.repeat(mine, chunk.sizes)).astype(np.int32)
    if not len(chosen):
        return
    pair = np.concatenate([chunk.pairs(chosen[i:i + PART]).astype(np.uint16) for i in range(0, len(chosen), PART)])
    order = np.argsort(pair, kind="stable")
    chosen, pair, order = chosen[order], pair[order], None  # so that tokens of one pair stand together
    seen[:hashed] += np.bincount(pair * np.int64(CLASSES) + chunk.top[chunk.codes[chosen]], minlength=hashed)
    for level, classes in enumerate((chunk.top, chunk.sub)):
        factors = Factors(chunk, w, level)
        bytes_ = np.empty((PART, CLASSES), np.int8)
        bias = 4 * CLASSES + hashed if level else 0
        for i in range(0, len(chosen), PART):
            at = chosen[i:i + PART]
            codes, words = chunk.codes[at], (chunk.one[at], chunk.two[at])
            cls, n = classes[codes], np.arange(len(at))
            rows = [chunk.rows[x] for x in words]
            p = factors(*rows, chunk.top[codes] if level else pair[i:i + PART])
            own = [chunk.own(w, level, kind, words[kind], rows[kind], cls) for kind in (0, 1)]
            p[n, cls] *= np.exp(sum((new - old) * w.scale[level, kind][cls] for kind, (old, new) in enumerate(own)))
            p /= _row_sums(p)[:, None]
            seen[bias:bias + CLASSES] += np.bincount(cls, minlength=CLASSES)
            said[bias:bias + CLASSES] += _column_sums(p)
            if not level:
                starts = np.flatnonzero(np.diff(pair[i:i + PART].astype(np.int32), prepend=-1))
                said[:hashed].reshape(FEATURES, CLASSES)[pair[i:i + PART][starts]] += np.add.reduceat(p, starts, axis=0)
            for kind in (0, 1):
                x, q = factors.room[1:, :len(at)]
                np.multiply(_rows(chunk.tables[level][kind], rows[kind], bytes_[:len(at)]), np.float32(1 / STEP), out=x)
                x[n, cls] = own[kind][1]
                np.multiply(p, x, out=q)
                first = hashed + (2 * level + kind) * CLASSES
                seen[first:first + CLASSES] += np.bincount(cls, own[kind][1], CLASSES) - _column_sums(q)
                x -= q
                said[first:first + CLASSES] += _column_sums(q, x)
        factors = p = x = q = None  # before the next level's are made


def _round(chunks: DataFrame, w: Weights, turn: int, turns: int) -> dict[str, np.ndarray]:
    """Gradients over the training texts whose turn it is, added up by Spark: observed and expected counts
    of the hashed features and biases, and slope and curvature of each scale."""
    shared = chunks.sparkSession.sparkContext.broadcast(vars(w))
    hashed = FEATURES * CLASSES

    def run(chunk):
        seen, said = np.zeros(hashed + 5 * CLASSES), np.zeros(hashed + 5 * CLASSES)
        _gradients(chunk, Weights.of(shared.value), turn, turns, seen, said)
        chunk = None
        spots = np.flatnonzero((seen != 0) | (said != 0))
        yield pa.RecordBatch.from_arrays([pa.array(spots), pa.array(seen[spots]), pa.array(said[spots])], names=["spot", "seen", "said"])

    sums = (_over_chunks(chunks, run, "spot long, seen double, said double")
            .groupBy("spot").agg(F.sum("seen").alias("seen"), F.sum("said").alias("said")))
    with _set(chunks.sparkSession, *_ONE):
        sums = saved(sums, "lm-round")
    got = sums.toArrow()  # a fixed number of spots
    release(sums)
    seen, said = np.zeros(hashed + 5 * CLASSES), np.zeros(hashed + 5 * CLASSES)
    spots = got.column("spot").to_numpy()
    seen[spots], said[spots] = got.column("seen").to_numpy(), got.column("said").to_numpy()
    return {"hashed": (seen[:hashed].reshape(FEATURES, CLASSES), said[:hashed].reshape(FEATURES, CLASSES)),
            "scale": (seen[hashed:hashed + 4 * CLASSES].reshape(2, 2, CLASSES), said[hashed:hashed + 4 * CLASSES].reshape(2, 2, CLASSES)),
            "inner": (seen[hashed + 4 * CLASSES:], said[hashed + 4 * CLASSES:])}


def train(chunks: DataFrame, w: Weights, rounds: int = ROUNDS) -> Weights:
    """``w`` moved along the gradients of ``rounds`` rounds, scaled by counts and curvature.  Each training
    text has its turn in one of them, so all are learned from and none is read for nothing."""
    for turn in range(rounds):
        got = _round(chunks, w, turn, rounds)
        for name, weights in (("hashed", w.hashed), ("inner", w.inner)):
            seen, said = got[name]
            weights += (np.clip((seen - said) / (said + 4.0), -0.9, 4.0) / 2.0).astype(np.float32)
        slope, curve = got["scale"]
        w.scale += np.clip(slope / (curve + 10.0) / 2.0, -0.3, 0.3).astype(np.float32)
    return w


def score(df: DataFrame, training, id_col: str = "doc_id", text_col: str = "text", chunk_tokens: int = CHUNK) -> DataFrame:
    """Per row ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``; rows where
    the condition ``training`` holds are learned from."""
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                     F.coalesce(training, F.lit(False)).alias("learn"))
    with _set(df.sparkSession, *_BATCH), _set(df.sparkSession, *_BY_CHUNK):
        return _score(docs, chunk_tokens)


def _score(docs: DataFrame, chunk_tokens: int) -> DataFrame:
    spark = docs.sparkSession
    encoded = saved_by("chunk", [_encode(docs, chunk_tokens)], "lm_encoded")
    vocabulary = saved(_vocabulary(encoded), "lm-vocabulary", "zstd")
    drop_shuffles(spark)
    leaf = np.ones((CLASSES, CLASSES))  # a slot for unseen tokens in each
    n_all = v_all = 0
    kinds = vocabulary.where("first and c > 0").groupBy(F.expr(f"h & {CLASSES - 1}").alias("k"), F.expr(f"shiftright(h, 8) & {CLASSES - 1}").alias("s"))
    for r in kinds.agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():  # one row a subclass
        leaf[r["k"], r["s"]] += r["n"] + r["v"]
        n_all, v_all = n_all + r["n"], v_all + r["v"]
    counts = saved_by("chunk", [_by_chunk(vocabulary, ["c"]).drop("code")], "lm_counts")
    drop_shuffles(spark)
    counted = encoded.drop("seen").join(counts, ["chunk", "part"], "left")  # joined again below: the codes are kept once
    features = saved(_features(counted, leaf), "lm-features")
    drop_shuffles(spark)
    often = vocabulary.where(F.col("c") >= MIN_COUNT).select("chunk", "code", "h")
    wave = F.pmod(F.xxhash64("chunk"), F.lit(WAVES))
    words = saved_by("chunk", [_by_chunk(often.where(wave == k).join(features, "h"), ["features"]).withColumnRenamed("code", "words")
                               for k in range(WAVES)], "lm_words")
    release(vocabulary, features)
    # Joined again in each pass, without a shuffle as all three tables lie by chunk: a third copy of
    # the chunks, or moving them in each pass, would take more disk than all the rest.
    chunks = counted.join(words, ["chunk", "part"], "left")
    shared = spark.sparkContext.broadcast(vars(train(chunks, Weights(leaf))))
    rooms = np.log10(leaf)

    def run(chunk):
        per = chunk.log_likelihood(Weights.of(shared.value), slice(None))
        seen = np.log10(chunk.counts + 1.0)
        inside = (seen - rooms[chunk.top, chunk.sub])[chunk.codes]
        base = (seen - math.log10(n_all + v_all + 1))[chunk.codes]
        sums = [np.add.reduceat(x, chunk.starts) for x in (per / math.log(10) + inside, base, (chunk.counts > 0)[chunk.codes].astype(np.int64))]
        yield pa.RecordBatch.from_arrays([
            pa.array(chunk.ids, pa.int64()), pa.array(~chunk.learn), pa.array(chunk.sizes), pa.array(sums[2]),
            pa.array(np.full(len(chunk.ids), n_all, np.int64)), pa.array(sums[1]), pa.array(sums[0])],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    scored = _over_chunks(chunks, run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    with _set(spark, *_ONE):
        return saved(scored, "lm-scores")


def op8_maxent(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    return score(docs, remainder("doc_id", HELD_OUT_DIVISOR) != HELD_OUT_REMAINDER)
