"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

* Folding maps every character to one character: case, full-width forms and accents outside
  Latin-1 (whose letters are ordinary spelling here) by Unicode decomposition, look-alike letters and digit substitutions by the tables below.  Positions in
  the folded text are therefore positions in the text, and word boundaries are read there.
* The lexicon (whole words, and stems that must start a word) is learned on a bounded sample of
  labelled rows: candidates that occur almost only in toxic rows, chosen greedily so that each
  explains rows that fewer than three entries before it explain.  Near copies of one text (equal
  smallest word hash) count as one row, so they do not add their whole vocabulary.  An entry's weight is its smoothed log-odds.
* A match inside an exception phrase does not count.
* The sum of weights over ``words ** alpha`` goes through a logistic curve; ``alpha`` and the
  curve are fitted on the same sample.

Null and empty texts have no match and get the score of a text without one; ties and repeated
rows are scored alike, each on its own; an empty table gives an empty result.  Without labelled
rows of both classes the lexicon is empty and every score is the share of toxic labels (0 when
there is no label at all).
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (giving_back, SLICE, fields, label_sample, load, map_rows, remainder, saved)

# Letters of other scripts that look like a Latin one.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y",
    "ѵ": "v", "ԝ": "w", "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ø": "o",
}
# Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "i", "|": "i", "€": "e"}

# Phrases in which a listed word is harmless.
DEFAULT_EXCEPTIONS = ("trash can", "trash bin", "clown fish")

STEM_LENGTHS = (4, 5, 6, 7, 8)
MAX_LABELLED_ROWS = 20_000


def _fold_table() -> dict[int, str]:
    table = {}
    blocks = [range(0x20, 0x250), range(0x370, 0x530), range(0x1E00, 0x1F00),
              range(0x2100, 0x2150), range(0xFF01, 0xFF5F), range(0x1D400, 0x1D800)]
    for block in blocks:
        for code in block:
            base = unicodedata.normalize("NFKD", chr(code))[:1].lower()[:1]
            if 0xC0 <= code <= 0xFF and code not in (0xD7, 0xF7):
                base = chr(code).lower()  # letters of the corpus' own languages stay apart
            base = LOOK_ALIKES.get(base, SUBSTITUTES.get(base, base))
            base = "i" if base == "l" else base  # 1, I and l are one sign
            if base and base != chr(code):
                table[code] = base
    return table


FOLD = _fold_table()
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """One folded character per character of ``text``."""
    return text.translate(FOLD)


def word_features(text: str | None) -> set[str]:
    """Folded words of a text, and with a trailing ``*`` the stems of those long enough."""
    out = set()
    for word in set(_WORD.findall(text or "")):
        w = fold(word)
        out.add(w)
        for n in STEM_LENGTHS:
            if len(w) > n:
                out.add(w[:n] + "*")
    return out


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float] = field(default_factory=dict)  # folded word, or stem with "*"
    exceptions: tuple[str, ...] = DEFAULT_EXCEPTIONS
    alpha: float = 0.0
    slope: float = 1.0
    bias: float = -4.0


def matcher(model: ToxicityModel):
    """``fn(text) -> (weight sum, matches, n_words)`` over an Aho-Corasick automaton."""
    import ahocorasick

    lexicon = ahocorasick.Automaton()
    for entry, weight in model.weights.items():
        key = entry.rstrip("*")
        old = lexicon.get(key, None)
        whole, stem = (old[1], old[2]) if old else (0.0, 0.0)
        if entry.endswith("*"):
            stem = weight
        else:
            whole = weight
        lexicon.add_word(key, (len(key), whole, stem))
    harmless = ahocorasick.Automaton()
    for phrase in model.exceptions:
        if phrase:
            harmless.add_word(fold(phrase), len(phrase))
    if model.weights:
        lexicon.make_automaton()
    if len(harmless):
        harmless.make_automaton()

    def scan(text: str | None):
        if not text:
            return 0.0, 0, 0
        n_words = text.count(" ") + text.count("\n") + 1
        if not model.weights:
            return 0.0, 0, n_words
        folded = fold(text)
        size = len(folded)
        hits: dict[int, float] = {}
        for end, (n, whole, stem) in lexicon.iter(folded):
            start = end - n + 1
            if start and text[start - 1].isalnum():
                continue
            closed = end + 1 == size or not text[end + 1].isalnum()
            weight = max(whole, stem) if closed else stem
            if weight > hits.get(start, 0.0):
                hits[start] = weight
        if hits and len(harmless):
            for end, n in harmless.iter(folded):
                for start in range(end - n + 1, end + 1):
                    hits.pop(start, None)
        return sum(hits.values()), len(hits), n_words

    return scan


def _logit(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, x))))


def score(df: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``df`` with ``toxicity`` (0 to 1) and ``toxic_matches``."""

    def setup():
        scan = matcher(model)

        def fn(texts):
            scores, counts = [], []
            for text in texts:
                total, hits, n = scan(text)
                scores.append(_logit(model.bias + model.slope * total / max(1, n) ** model.alpha))
                counts.append(hits)
            return [scores, counts]

        return fn

    return map_rows(df, [text_col], fields("toxicity double, toxic_matches long"), setup)


def _feature_counts(sample: DataFrame, label: int, allowed: set[str] | None) -> DataFrame:
    """``(feature, n)``: texts of one class that hold the feature, summed per Arrow batch first."""
    rows = sample.where(F.col("label") == label).select("text")

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            seen: Counter = Counter()
            for at in range(0, batch.num_rows, SLICE):
                for text in batch.slice(at, SLICE).column(0).to_pylist():
                    found = word_features(text)
                    seen.update(found if allowed is None else found & allowed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                names=["feature", "n"])

    return (rows.mapInArrow(giving_back(run), fields("feature string, n long"))
            .groupBy("feature").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_rows: int = MAX_LABELLED_ROWS, max_candidates: int = 50_000,
        min_rows: int = 3, purity: float = 0.97, depth: int = 3,
        exceptions: tuple[str, ...] = DEFAULT_EXCEPTIONS) -> ToxicityModel:
    """Learn the lexicon and its curve from at most ``max_rows`` labelled rows of ``labels``.  Of the words
    and stems in ``min_rows`` toxic rows of that sample or more, the ``max_candidates`` most common
    are weighed, so what reaches the driver is bounded by parameters."""
    ids = label_sample(labels, id_col, label_col, max_rows)
    sample = saved(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                               F.col(text_col).alias("text"))
                   .join(F.broadcast(ids), "doc_id").select("text", "label"), "toxic-sample")
    totals = {r["label"]: r["n"] for r in
              sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = totals.get(1, 0), totals.get(0, 0)
    if not n_pos or not n_neg:
        share = n_pos / max(1, n_pos + n_neg)
        return ToxicityModel({}, exceptions, 0.0, 1.0,
                             math.log((share + 1e-4) / (1 - share + 1e-4)))
    pos = {r["feature"]: r["n"] for r in
           _feature_counts(sample, 1, None).where(F.col("n") >= min_rows)
           .orderBy(F.desc("n"), "feature").limit(max_candidates).collect()}
    neg = {r["feature"]: r["n"] for r in _feature_counts(sample, 0, set(pos)).collect()}

    def log_odds(f: str) -> float:
        return (math.log((pos[f] + 0.5) / (n_pos + 1))
                - math.log((neg.get(f, 0) + 0.5) / (n_neg + 1)))

    rate = {f: (pos[f] / n_pos, neg.get(f, 0) / n_neg) for f in pos}
    pure = {f for f, (p, q) in rate.items() if p / (p + q) >= purity and log_odds(f) > 2}

    # The toxic rows of the bounded sample with their pure candidates, for the greedy cover.
    texts = sample.where("label = 1").select("text")

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                keys, found = [], []
                for text in batch.slice(at, SLICE).column(0).to_pylist():
                    has = word_features(text)
                    keys.append(min((zlib.crc32(w.encode()) for w in has), default=0))
                    found.append(sorted(has & pure))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(found, pa.list_(pa.string()))],
                    names=["key", "found"])

    by_key: dict[int, set[str]] = defaultdict(set)
    for r in texts.mapInArrow(giving_back(run), fields("key long, found strings")).collect():
        by_key[r["key"]].update(r["found"])
    weights = {f: log_odds(f) for f in _cover(list(by_key.values()), rate, min_rows, depth)}
    return _calibrated(sample, ToxicityModel(weights, exceptions), n_pos, n_neg)


def _cover(rows: list[set[str]], rate: dict[str, tuple[float, float]], min_rows: int,
           depth: int) -> list[str]:
    """Greedy cover: take the entry that explains most open rows, until it explains too few.
    A row stays open until ``depth`` entries explain it.

    A stem replaces its words only when it explains clearly more rows than its best word, and
    of equal entries the one rarer in clean rows, then the longer word, is taken.  Stems and
    words that a chosen stem holds are not taken again.
    """
    open_rows = defaultdict(set)
    for i, found in enumerate(rows):
        for f in found:
            open_rows[f].add(i)
    chosen = []
    left = [depth] * len(rows)
    while open_rows:
        def gain(f):
            n = len(open_rows[f])
            return n / 1.3 if f.endswith("*") else n

        best = max(open_rows, key=lambda f: (gain(f), -rate[f][1], len(f), f))
        if len(open_rows[best]) < min_rows:
            break
        chosen.append(best)
        hit = open_rows.pop(best)
        gone = set()
        for i in hit:
            left[i] -= 1
            if not left[i]:
                gone.add(i)
        stem = best.rstrip("*")
        for f in list(open_rows):
            if best.endswith("*") and f.startswith(stem) or f.endswith("*") and best.startswith(f[:-1]):
                del open_rows[f]
                continue
            open_rows[f] -= gone
            if not open_rows[f]:
                del open_rows[f]
    return chosen


def _calibrated(sample: DataFrame, model: ToxicityModel, n_pos: int, n_neg: int) -> ToxicityModel:
    """Fit ``alpha`` and the logistic curve on (weight sum, words, label) of the sample."""
    import numpy as np

    def setup():
        scan = matcher(model)

        def fn(texts):
            got = [scan(t) for t in texts]
            return [[g[0] for g in got], [g[2] for g in got]]

        return fn

    stats = map_rows(sample, ["text"], fields("total double, words long"), setup)
    got = stats.select("total", "words", "label").toPandas()
    y = got["label"].to_numpy(float)
    best = None
    for alpha in (0.0, 0.25, 0.5, 1.0):
        x = got["total"].to_numpy() / np.maximum(1, got["words"].to_numpy()) ** alpha
        scale = x.std() or 1.0
        z = x / scale
        a, b = 1.0, math.log((n_pos + 1) / (n_neg + 1))
        for _ in range(60):  # Newton steps with a little ridge, so separable data stays finite
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -35, 35)))
            w = p * (1 - p) + 1e-6
            g = np.array([((y - p) * z).sum() - 1e-2 * a, (y - p).sum() - 1e-2 * b])
            h = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()],
                          [(w * z).sum(), w.sum() + 1e-2]])
            step = np.linalg.solve(h, g)
            a, b = a + np.clip(step[0], -5, 5), b + np.clip(step[1], -5, 5)
        p = np.clip(1 / (1 + np.exp(-np.clip(a * z + b, -35, 35))), 1e-9, 1 - 1e-9)
        loss = -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
        if best is None or loss < best[0] - 1e-9:
            best = (loss, alpha, a / scale, b)
    return ToxicityModel(model.weights, model.exceptions, best[1], float(best[2]), float(best[3]))


HELD_OUT_DIVISOR, HELD_OUT_REMAINDER = 5, 0


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """The production model: labels of the held-out ids are never read."""
    return fit(docs, labels.where(remainder("doc_id", HELD_OUT_DIVISOR) != HELD_OUT_REMAINDER))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, load(spark, sf_dir, "labels", "doc_id", "toxic"))
    return score(docs, model).select(
        "doc_id", (remainder("doc_id", HELD_OUT_DIVISOR) == HELD_OUT_REMAINDER).alias("held_out"),
        F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        "toxic_matches")
