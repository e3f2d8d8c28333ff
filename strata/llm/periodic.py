"""Periodic runs of words, found by Baier grouping, and texts with their repeats taken out.

A run is a stretch of words with smallest period ``q``, at least ``EXPONENT`` periods and
``LENGTH`` words long, that neither neighbouring word prolongs with that period.  Every run holds,
under one of the two orders of its words (any fixed order and its reverse), a Lyndon root: a stretch
of one period that is the longest Lyndon word starting where it starts.  So the method is:

1. Words that occur fewer than ``EXPONENT`` times lie in no run.  They cut a text into stretches, in
   which the count is taken again while that removes much; most prose is gone after two rounds.
2. Phase one of Baier's suffix sorter groups the suffixes of a stretch by the longest Lyndon word
   they start with: from the highest group down, each suffix finds the nearest suffix before it that
   lies in a lower group, and that one's context grows by the context of the group for each of
   its suffixes.  The contexts' lengths are the Lyndon array; no second phase and no suffix array is
   needed.  It runs once for each order.
3. Each candidate root that is followed by its own first word is prolonged to both sides as far
   as words one period apart are equal (LCE by comparing blocks of doubling size); a root inside a
   stretch already prolonged with its period is passed over.

All this is local to a row: nothing is shuffled, and memory follows the longest text of a slice.
Words are runs of characters other than the six ASCII blanks.  A null or blank text has no words and
no runs; repeated rows give equal results; an empty table gives an empty one.  Of equally strong
runs (length over period, compared exactly) the first, then the one of smaller period, is the
strongest.  Only the id and text columns are read and only the id and the results are
returned, so further columns of any name have no effect.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import fields, load, map_rows, word_bytes

EXPONENT = 4  # periods in a run, at least
LENGTH = 6    # words in a run, at least

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def lyndon_lengths(word: list[int]) -> list[int]:
    """For each position of ``word`` (numbers from 0 on) the length of the longest Lyndon word
    that starts there: phase one of Baier's suffix sorter.

    ``order`` holds the positions group by group, lowest first; a group is named by where it
    begins there, so names compare as groups do."""
    n = len(word)
    order = sorted(range(n), key=word.__getitem__)
    place, group, size, context = [0] * n, [0] * n, [0] * n, [1] * n
    name = 0
    for at, i in enumerate(order):
        if at and word[i] != word[order[at - 1]]:
            name = at
        place[i], group[i] = at, name
        size[name] += 1
    before = [-1] * n  # the nearest position to the left in a lower group
    end = n
    while end:
        current = group[order[end - 1]]
        copies: dict[int, int] = {}
        for i in sorted(order[current:end]):
            j = i - 1
            while j >= 0 and group[j] >= current:
                j = before[j]
            before[i] = j
            if j >= 0:
                copies[j] = copies.get(j, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for j, k in copies.items():
            parts.setdefault((-k, group[j]), []).append(j)
        for (less, lower), moved in sorted(parts.items()):  # most copies first: they rank highest
            grown = context[lower] - less * context[current]
            if len(moved) == size[lower]:
                context[lower] = grown
                continue
            size[lower] -= len(moved)
            split = lower + size[lower]
            tail = split + len(moved)
            for j in moved:  # to the upper end of its group
                tail -= 1
                at, other = place[j], order[tail]
                order[at], order[tail] = other, j
                place[other], place[j] = at, tail
                group[j] = split
            size[split], context[split] = len(moved), grown
        end = current
    return [context[g] for g in group]


def stretches(ids: np.ndarray, exponent: int = EXPONENT, length: int = LENGTH) -> list[tuple[int, int]]:
    """The parts ``[a, b)`` outside which no run lies: cut at words that are too rare in them."""
    least, kinds = max(2, exponent), int(ids.max()) + 1 if ids.size else 0
    at = np.flatnonzero(np.bincount(ids, minlength=1)[ids] >= least) if ids.size else ids
    while True:
        part = np.concatenate(([0], np.cumsum(np.diff(at) > 1))) if at.size else at
        if at.size:
            long = np.bincount(part)[part] >= length
            at, part = at[long], part[long]
        if not at.size:
            return []
        _, which, count = np.unique(part.astype(np.int64) * kinds + ids[at], return_inverse=True, return_counts=True)
        keep = count[which] >= least
        if 8 * int(keep.sum()) > 7 * at.size:  # little to gain: what is left is searched
            break
        at = at[keep]
    first = np.flatnonzero(np.concatenate(([True], np.diff(part) > 0)))
    last = np.append(first[1:], at.size) - 1
    return [(int(a), int(b) + 1) for a, b in zip(at[first], at[last])]


def _equal_ahead(ids: np.ndarray, i: int, j: int) -> int:
    """How many words from ``i`` on equal those from ``j`` on (``i < j``)."""
    most, done, step = ids.size - j, 0, 8
    while done < most:
        k = min(step, most - done)
        same = ids[i + done:i + done + k] == ids[j + done:j + done + k]
        if not same.all():
            return done + int(same.argmin())
        done += k
        step *= 2
    return most


def _equal_behind(ids: np.ndarray, i: int, j: int) -> int:
    """How many words before ``i`` equal those before ``j`` (``i < j``)."""
    done, step = 0, 8
    while done < i:
        k = min(step, i - done)
        same = (ids[i - done - k:i - done] == ids[j - done - k:j - done])[::-1]
        if not same.all():
            return done + int(same.argmin())
        done += k
        step *= 2
    return i


def runs(ids: np.ndarray, exponent: int = EXPONENT, length: int = LENGTH) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a sequence of numbers from 0 on, by start, then
    period.  ``exponent`` is at least 2."""
    found = set()
    for a, b in stretches(ids, exponent, length):
        _, word = np.unique(ids[a:b], return_inverse=True)
        size = b - a
        for letters in (word, word.max() - word):
            root = np.array(lyndon_lengths(letters.tolist()), dtype=np.int64)
            start = np.flatnonzero(np.arange(size) + root < size)
            start = start[word[start] == word[start + root[start]]]
            start = start[np.lexsort((start, root[start]))]
            seen_period, seen_end = 0, 0  # the last stretch prolonged with this period ends there
            for i, p in zip(start.tolist(), root[start].tolist()):
                if p == seen_period and i + p <= seen_end:
                    continue
                left = _equal_behind(word, i, i + p)
                total = left + p + _equal_ahead(word, i, i + p)
                seen_period, seen_end = p, i - left + total
                if total >= max(length, exponent * p):
                    found.add((a + i - left, total, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length over period; of equals the first, then of smaller period."""
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def numbered(words: list[bytes]) -> np.ndarray:
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(names.__getitem__, words), np.int64, len(words))


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT,
             length: int = LENGTH) -> DataFrame:
    """``(id, n_words, runs, strongest, collapsed)``: the runs of each text as an array of
    ``(start, length, period)`` by start and period, the strongest one (NULL without runs), and the
    text's words joined by one blank without those that a run holds after its first period."""
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    out = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
                        T.StructField("strongest", RUN), T.StructField("collapsed", T.StringType())])

    def setup():
        def struct(r):
            return None if r is None else {"start": r[0], "length": r[1], "period": r[2]}

        def run(texts: list[str | None]) -> list:
            n_words, all_runs, best, kept = [], [], [], []
            for text in texts:
                words = word_bytes(text)
                found = runs(numbered(words), exponent, length) if len(words) >= length else []
                n_words.append(len(words))
                all_runs.append([struct(r) for r in found])
                best.append(struct(strongest(found)))
                if found:
                    drop = np.zeros(len(words) + 1, dtype=np.int64)
                    for start, size, period in found:
                        drop[start + period] += 1
                        drop[start + size] -= 1
                    words = [w for w, d in zip(words, np.cumsum(drop)) if not d]
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            return [n_words, all_runs, best, kept]

        return run

    src = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"))
    return map_rows(src, ["__text"], out, setup).select(
        F.col("__id").alias(id_col), "n_words", "runs", "strongest", "collapsed")


def repeat_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text)`` with a periodic tail in the texts whose id's crc32 is divisible by ten: the
    queries' own test load, since the given texts hold few runs.  A null id changes nothing."""
    def setup():
        def tail(i: int | None, text: str | None) -> str | None:
            h = None if i is None else crc32(str(i).encode())
            words = word_bytes(text) if h is not None and h % 10 == 0 else []
            if not words:
                return text
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            return b" ".join(words[:a] + [words[a + k % p] for k in range(n - a)]).decode("utf-8", "surrogatepass")

        return lambda ids, texts: [[tail(i, t) for i, t in zip(ids, texts)]]

    src = docs.select(F.col(f"`{id_col}`").cast("long").alias(id_col), F.col(f"`{id_col}`").cast("long").alias("__id"),
                      F.col(f"`{text_col}`").alias("__text"))
    return map_rows(src, ["__id", "__text"], fields("text string"), setup).select(id_col, "text")


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = collapse(repeat_tails(load(spark, sf_dir, "documents", "doc_id", "text")))
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                   F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
