"""Substring dedup by a join of window hashes, preselected by reference blocks.

Every text is cut into reference blocks by its content: a window of ``window`` words belongs to
the block named by the smallest hash of the half-windows in it, so equal windows of different
documents always meet in one block.  Blocks that only one text has are never looked at again.  Blocks
of equal name and equal words are one variant, however many texts have it; the windows of each variant
are indexed once, by the block's name and a hash of the words (128 bits together), with the smallest id
they start in.

A window is held if the index has it for a smaller id; the union of a document's held windows are
its duplicate spans.  No text is factored against reference blocks: the spans are those that greedy
factors of ``window`` words or more would cover, as such a factor is a run of held windows.

Texts are compared before anything is removed.  Equal texts are parsed once: of a text that
occurs under several ids, all but the smallest id lose every word (if it has a window at all).  A
null or empty text has no words; a null id counts as larger than all ids; repeated rows of one id
are judged alike and never against each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import drop_shuffles, fields, load, map_rows, release, saved, word_bytes, words_of

WINDOW = 50
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so they have inverses modulo 2**64
_LAST_ID = (1 << 63) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def runs_hash(codes: np.ndarray, size: int, base: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` codes."""
    n = len(codes)
    if n < size:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * _powers(base, n), dtype=np.uint64)])
    back = _powers(pow(base, -1, 1 << 64), n - size + 1)
    return _mix((sums[size:] - sums[:-size]) * back)


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """The smallest of every ``size`` neighbours, by doubling."""
    width = 1
    while width * 2 <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = size - width
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


class Windows:
    """Window hashes and blocks of texts; remembers the hash of each word."""

    def __init__(self, window: int):
        self.window, self.memo = window, {}

    def codes(self, text: str | None, lower: bool = False) -> np.ndarray:
        memo, words = self.memo, word_bytes(text, lower)
        if len(memo) > 500_000:
            memo.clear()
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))

    def blocks(self, codes: np.ndarray) -> np.ndarray:
        """The block of each window."""
        half = self.window // 2
        if len(codes) < self.window:
            return np.zeros(0, np.int64)
        return sliding_min(runs_hash(codes, half, _BASES[0]), self.window - half + 1).view(np.int64)

    def runs(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The stretches of neighbouring windows in one block: its name, a hash of the stretch's
        words, where its first window starts, and how many windows it has."""
        b = self.blocks(codes)
        if not len(b):
            return (b,) * 4
        at = np.concatenate([[0], np.flatnonzero(b[1:] != b[:-1]) + 1])
        m = np.diff(np.concatenate([at, [len(b)]]))
        n = len(codes)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * _powers(_BASES[1], n), dtype=np.uint64)])
        back = _powers(pow(_BASES[1], -1, 1 << 64), n)
        words = _mix((sums[at + m + self.window - 1] - sums[at]) * back[at])
        return b[at], _mix(words + m.astype(np.uint64)).view(np.int64), at, m

    def hashes(self, codes: np.ndarray) -> np.ndarray:
        return runs_hash(codes, self.window, _BASES[1]).view(np.int64)


def covered(starts, n: int, window: int) -> np.ndarray:
    """Words of the factors that the parse finds from the starts of held windows."""
    edge = np.zeros(n + 1, np.int64)
    at = np.asarray(starts, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(at + window, n), -1)
    return np.cumsum(edge[:-1]) > 0


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of ``df``: ``doc_id, n_words, n_removed, kept`` (the kept words, one blank between)."""
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).select(
        "doc_id", F.coalesce("doc_id", F.lit(_LAST_ID)).alias("rank"), "text",
        F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    # One row per distinct text, under its smallest id; ``key`` names it from here on.
    firsts = saved(docs.groupBy("sha").agg(F.min("rank").alias("rank")), "substring-texts")

    def list_blocks():
        w = Windows(window)

        def fn(texts):
            found = [w.runs(w.codes(t)) for t in texts]
            return [[f[k].tolist() for f in found] for k in range(4)]

        return fn

    texts = docs.select("sha", "rank", "text")
    reps = saved(texts.join(firsts, ["sha", "rank"], "left_semi").dropDuplicates(["sha"])
                 .withColumn("key", F.xxhash64("sha", "rank")), "substring-reps", "zstd")
    release(firsts)
    listed = map_rows(reps.select("key", "rank", "text"), ["text"], fields("block longs, variant longs, at longs, m longs"),
                      list_blocks, slice_rows=64)
    listed = saved(listed.select("key", "rank", F.inline(F.arrays_zip("block", "variant", "at", "m"))), "substring-blocks")
    # (rank, key) is unique per text; a block is shared when two texts have it.
    shared = (listed.groupBy("block").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
              .where("lo != hi").select("block"))
    occurring = saved(listed.join(shared, "block"), "substring-shared")
    release(listed)
    # Equal blocks are looked into once, in the text of the smallest rank that has them.
    variants = occurring.groupBy("block", "variant").agg(F.min(F.struct("rank", "key", "at", "m")).alias("r"))
    wanted = variants.groupBy(F.col("r.key").alias("key")).agg(F.collect_list(F.struct(
        "block", "variant", F.col("r.rank").alias("lo"), F.col("r.at").alias("at"), F.col("r.m").alias("m"))).alias("blocks"))

    def list_windows():
        w = Windows(window)

        def fn(texts, blocks):
            out = []
            for t, wanted_ in zip(texts, blocks):
                h = w.hashes(w.codes(t))
                out.append([{**b, "h": h[b["at"]:b["at"] + b["m"]].tolist()} for b in wanted_])
            return [out]

        return fn

    block = T.StructType([T.StructField(n, T.LongType()) for n in ("block", "variant", "lo", "at", "m")]
                         + [T.StructField("h", T.ArrayType(T.LongType()))])
    hashed = map_rows(reps.select("key", "text").join(wanted, "key"), ["text", "blocks"],
                      T.StructType([T.StructField("found", T.ArrayType(block))]), list_windows, slice_rows=64)
    windows = saved(hashed.select(F.explode("found").alias("b")).select("b.block", "b.variant", "b.lo", F.posexplode("b.h").alias("off", "h")),
                    "substring-windows")
    drop_shuffles(df.sparkSession)
    index = windows.groupBy("block", "h").agg(F.min("lo").alias("first"))
    known = windows.join(index, ["block", "h"]).groupBy("block", "variant").agg(F.collect_list(F.struct("off", "first")).alias("offs"))
    before = F.transform(F.filter("offs", lambda o: o["first"] < F.col("rank")), lambda o: F.col("at") + o["off"])
    held = saved(occurring.join(known, ["block", "variant"]).select("key", "rank", before.alias("starts")).where(F.size("starts") > 0)
                 .groupBy("key", "rank").agg(F.flatten(F.collect_list("starts")).alias("starts")), "substring-held")
    release(occurring, windows)

    def parse():
        def fn(texts, starts):
            total, removed, kept = [], [], []
            for t, s in zip(texts, starts):
                words = words_of(t)
                total.append(len(words))
                if s:
                    gone = covered(s, len(words), window)
                    removed.append(int(gone.sum()))
                    kept.append(" ".join([w for w, g in zip(words, gone.tolist()) if not g]))
                else:
                    removed.append(0)
                    kept.append(" ".join(words))
            return [total, removed, kept]

        return fn

    parsed = map_rows(reps.join(held, ["key", "rank"], "left").select("sha", "rank", "text", "starts"),
                      ["text", "starts"], fields("n_words long, n_removed long, kept string"), parse,
                      slice_rows=128).select("sha", F.col("rank").alias("first"), "n_words", "n_removed", "kept")
    whole = (F.col("rank") > F.col("first")) & (F.col("n_words") >= window)
    return docs.select("doc_id", "rank", "sha").join(parsed, "sha").select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"))


def op2_substrings(spark, sf_dir: str) -> DataFrame:
    return dedup(load(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str | None]], window: int = WINDOW) -> list[tuple[int, int, int, str]]:
    """The same result by comparing every window with every window; for tests."""
    first: dict[tuple, int] = {}
    for i, t in rows:
        words = words_of(t)
        for at in range(len(words) - window + 1):
            key = tuple(words[at:at + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        words = words_of(t)
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            if first[tuple(words[at:at + window])] < i:
                gone[at:at + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode("utf-8")).hexdigest()))
    return out
