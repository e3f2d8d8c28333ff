"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class has a mean and a covariance of the transformed statistics, the covariance shrunk
towards the pooled one and towards its own diagonal.  The score is the logistic of the
difference of the two log densities plus the log prior, from Cholesky factors computed once.

Statistics cover the whole text.  The sums behind means and covariances are made in the tasks
and added by Spark, so the driver sees a few hundred numbers whatever the number of rows.

A null text counts as an empty one, which has defined statistics and so a score like any other;
ties and repeated rows are scored alike; an empty table gives an empty result.  When a class has
no labelled row, the score is the share of good labels (0.5 without any label).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fields, load, map_rows, remainder, saved

# Frequent function words of the corpus' languages.
FUNCTION_WORDS = frozenset("""
the of and to in is that for it with as was on are by this be from at an or have not
der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als auch
de la le et les des en un du une que est pour qui dans par sur pas au avec
el los las y del se por con no su para una es lo al como más o
""".split())

STATISTICS = (
    "log words", "mean word length", "spread of word lengths", "symbols per character",
    "capitals per letter", "digits per character", "bars per word", "distinct words",
    "distinct word pairs", "repeated lines", "function words", "sentence ends per word",
    "log words per line", "exclamations per word", "words that hold a sign", "non-ASCII share",
)


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text, in the order of ``STATISTICS``."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    count = np.bincount(raw, minlength=256)
    n_chars = max(1, len(text))
    words = text.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    upper, lower = count[65:91].sum(), count[97:123].sum()
    letters = max(1, int(upper + lower + count[0xC2:0xF5].sum()))
    digits = count[48:58].sum()
    plain = count[[9, 10, 13, 32, 33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum()
    ascii_signs = count[33:127].sum() - upper - lower - digits - plain + count[32] + count[[9, 10, 13]].sum()
    lines = text.split("\n")
    # Variety falls with length in any text, so it is taken relative to what the length allows.
    distinct = math.log(max(1, len(set(words)))) / math.log(n + 1.0)
    pairs = math.log(max(1, len(set(zip(words, words[1:]))))) / math.log(n + 1.0)
    ends = count[46] + count[63]

    def share(x, y):  # a square root spreads the many shares near zero
        return math.sqrt(max(0.0, float(x)) / y)

    signs = int((count[[35, 36, 37, 38, 42, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 124, 125, 126]]).sum())
    return [
        math.log1p(len(words)), float(lengths.mean()), float(lengths.std()),
        share(ascii_signs, n_chars), share(upper, letters), share(digits, n_chars),
        share(count[124], n), distinct, pairs,
        share(len(lines) - len(set(lines)), len(lines)),
        share(sum(map(FUNCTION_WORDS.__contains__, words)), n), share(ends, n),
        math.log1p(n / len(lines)), share(count[33], n), share(signs, n),
        share(count[0x80:].sum(), max(1, raw.size)),
    ]


@dataclass(frozen=True)
class QualityModel:
    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, ...] = ()      # per class, of the scaled statistics
    inverses: tuple[np.ndarray, ...] = ()   # inverse Cholesky factors, per class
    constants: tuple[float, ...] = ()       # log prior minus half the log determinant
    share: float = 0.5                      # of good labels; the score without a fit
    thin: float = 12.0                      # words at which half of the evidence counts

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.share)
        # Statistics of a few words say little: their evidence is weighed against the prior.
        words = np.expm1(x[:, 0])
        trust = words / (words + self.thin)
        prior = math.log(self.share / (1 - self.share))
        margin = trust * self.margins(x) + (1 - trust) * prior
        return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log density difference, good minus bad, from Mahalanobis distances."""
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        logs = []
        for mean, inverse, constant in zip(self.means, self.inverses, self.constants):
            half = (z - mean) @ inverse.T
            logs.append(constant - 0.5 * (half * half).sum(axis=1))
        return logs[1] - logs[0]


def with_statistics(df: DataFrame, text_col: str = "text", name: str = "statistics") -> DataFrame:
    def setup():
        return lambda texts: [[statistics(t) for t in texts]]

    return map_rows(df, [text_col], fields(f"{name} doubles"), setup)


def _moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per label: number of rows, sum, and sum of outer products of ``statistics``."""
    import pyarrow as pa

    d = len(STATISTICS)

    def run(batches):
        sums = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy().reshape(-1, d)
            for label in (0, 1):
                z = x[y == label]
                sums[label] += np.concatenate([[len(z)], z.sum(0), (z.T @ z).ravel()])
        for label, s in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(s.size, label, np.int32)), pa.array(np.arange(s.size, dtype=np.int32)),
                 pa.array(s)], names=["label", "at", "value"])

    parts = rows.select("label", "statistics").mapInArrow(run, fields("label int, at int, value double"))
    total = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    for r in parts.groupBy("label", "at").agg(F.sum("value").alias("value")).collect():
        total[r["label"]][r["at"]] = r["value"]
    return {k: (s[0], s[1:1 + d], s[1 + d:].reshape(d, d)) for k, s in total.items()}


def fit(stats: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality",
        to_pooled: float = 0.05, to_diagonal: float = 0.05) -> QualityModel:
    """Fit on every labelled row.  ``stats`` is :func:`with_statistics` of the documents."""
    y = (labels.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("label"))
         .where(F.col("label").isin(0, 1) & F.col("__id").isNotNull())
         .groupBy("__id").agg(F.max("label").alias("label")))
    rows = stats.select(F.col(id_col).cast("long").alias("__id"), "statistics").join(y, "__id")
    sums = _moments(rows)
    n = {k: s[0] for k, s in sums.items()}
    d = len(STATISTICS)
    if not n[0] or not n[1]:
        share = n[1] / (n[0] + n[1]) if n[0] + n[1] else 0.5
        return QualityModel(np.zeros(d), np.ones(d), share=float(share))
    total = n[0] + n[1]
    centre = (sums[0][1] + sums[1][1]) / total
    second = (sums[0][2] + sums[1][2]) / total - np.outer(centre, centre)
    scale = np.sqrt(np.maximum(np.diag(second), 1e-8))
    means, covs = [], []
    for k in (0, 1):
        mean = sums[k][1] / n[k]
        cov = sums[k][2] / n[k] - np.outer(mean, mean)
        means.append((mean - centre) / scale)
        covs.append(cov / np.outer(scale, scale))
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / total
    inverses, constants = [], []
    for k in (0, 1):
        cov = (1 - to_pooled) * covs[k] + to_pooled * pooled
        cov = (1 - to_diagonal) * cov + to_diagonal * np.diag(np.diag(cov)) + 1e-6 * np.eye(d)
        factor = np.linalg.cholesky(cov)
        inverses.append(np.linalg.inv(factor))
        constants.append(float(math.log(n[k] / total) - np.log(np.diag(factor)).sum()))
    return QualityModel(centre, scale, tuple(means), tuple(inverses), tuple(constants),
                        float(n[1] / total))


def score(stats: DataFrame, model: QualityModel) -> DataFrame:
    """``stats`` with ``quality_score`` (0 to 1, higher: good likelier)."""
    import pyarrow as pa

    def setup():
        def fn(rows):
            x = np.array(rows, dtype=float).reshape(-1, len(STATISTICS))
            return [pa.array(model.scores(x))]

        return fn

    return map_rows(stats, ["statistics"], fields("quality_score double"), setup)


HELD_OUT_DIVISOR, HELD_OUT_REMAINDER = 3, 1


def op3_quality(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    # The statistics (a few numbers a document) are written once: fitting and scoring read them.
    stats = saved(with_statistics(docs).select("doc_id", "statistics"), "statistics")
    labels = load(spark, sf_dir, "labels", "doc_id", "quality").where(
        remainder("doc_id", HELD_OUT_DIVISOR) != HELD_OUT_REMAINDER)
    return score(stats, fit(stats, labels)).select(
        "doc_id", (remainder("doc_id", HELD_OUT_DIVISOR) == HELD_OUT_REMAINDER).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))
