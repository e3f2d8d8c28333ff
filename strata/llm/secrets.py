"""Secret scans: fixed patterns, and a small character convolutional network over candidates.

The network sees windows of characters around every candidate (a run of six or more key-like
characters that holds a digit or mixes cases, or a very long run of any) and says how likely it is a
secret.  A candidate longer than a window is read whole, in several windows, and counts as its likeliest
one.  The network is trained on labelled findings: candidates that a fixed pattern marks are positive,
the others negative.  It learns from all distinct windows of the texts, in blocks spread over the
tasks.  Every window is shown twice, with its surroundings and with
these blanked, so the network learns the looks of a value beside the key word in front of it, and can find
what the patterns, which need the word, do not.  On a fifth of the windows that training does not see, the
output is calibrated (a logistic fit, to the shares of the classes), and two thresholds are the highest
ones that keep the wanted recalls there, however low: one for windows with their surroundings, one for
blanked ones.  A candidate that reaches either is a finding of the network.  These are added; findings of
the patterns always stay.

A null text counts as an empty one and has no findings; texts of any length are scanned whole; repeated
rows each get their own findings; an empty table gives an empty result.  Without candidates of both kinds
the network adds nothing.  ``scan`` keeps all columns; one named ``secret_spans`` is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import giving_back, fields, load, map_rows, release, saved

KINDS = ("assign", "access", "hex", "model")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{6,}")
LONG_RUN = 20  # a run of this length is a candidate whatever it is made of

_DIGIT = re.compile("[0-9]")

LEFT, BODY, RIGHT = 20, 40, 4
WIDTH = LEFT + BODY + RIGHT

ROUNDS, BATCH, RATE = 12, 64, 0.01
BLOCK = 1 << 12  # windows that learn in one go; weights are averaged over blocks
STEPS = 1024  # a unit of logit, where thresholds are set


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Findings of the fixed patterns ``(start, end, kind)``, in order."""
    spans = []
    if ":" in text or "=" in text:  # no assignment without one of them
        spans += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return ordered(spans)


def ordered(spans):
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs of key-like characters that hold a digit, or both cases beyond a first capital, or are
    very long."""
    out = []
    for m in _CANDIDATE.finditer(text):
        run = m[0]
        if len(run) >= LONG_RUN or _DIGIT.search(run) or not (run[1:].islower() or run.isupper()):
            out.append(m.span())
    return out


def _codes() -> np.ndarray:
    """Classes of characters: 0 padding, then each ASCII printable sign, then other letters."""
    table = np.full(0x300, 97, np.int64)
    table[32:127] = np.arange(1, 96)
    table[:32] = 96
    return table


CLASSES = 98
_TABLE = _codes()


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """A candidate in parts of at most ``BODY`` characters, the last one full too."""
    if end - start <= BODY:
        return [(start, end)]
    return [(min(at, end - BODY), min(at, end - BODY) + BODY) for at in range(start, end, BODY)]


def encode(text: str, start: int, end: int) -> np.ndarray:
    """Class codes of a window: context, at most ``BODY`` characters, context."""
    body = text[start:end]
    window = text[max(0, start - LEFT):start].rjust(LEFT, "\0") + body.ljust(BODY, "\0") + text[end:end + RIGHT].ljust(RIGHT, "\0")
    points = np.frombuffer(window.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points == 0, 0, _TABLE[np.minimum(points, 0x2FF)])


def bare(x: np.ndarray) -> np.ndarray:
    """Windows without what surrounds the candidate."""
    out = x.copy()
    out[:, :LEFT] = out[:, LEFT + BODY:] = 0
    return out


@dataclass
class CharNet:
    """Embedding, one convolution with ReLU, maximum and mean over the places, logistic output."""

    embed: np.ndarray
    conv: np.ndarray
    conv_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    threshold: float = 2.0  # above 1: finds nothing
    bare_threshold: float = 2.0  # for windows without their surroundings

    @staticmethod
    def fresh(seed: int = 7, size: int = 8, span: int = 5, filters: int = 16) -> CharNet:
        rng = np.random.default_rng(seed)
        return CharNet(rng.normal(0, 0.5, (CLASSES, size)), rng.normal(0, 0.2, (span * size, filters)),
                       np.zeros(filters), rng.normal(0, 0.2, 2 * filters), 0.0)

    def forward(self, x: np.ndarray):
        span = self.conv.shape[0] // self.embed.shape[1]
        e = self.embed[x]
        patches = np.concatenate([e[:, i:WIDTH - span + 1 + i] for i in range(span)], axis=2)
        hidden = np.maximum(0, patches @ self.conv + self.conv_bias)
        pooled = np.concatenate([hidden.max(1), hidden.mean(1)], axis=1)
        p = 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.out_bias, -35, 35)))
        return patches, hidden, pooled, p

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        return np.concatenate([self.forward(x[i:i + 1024])[3] for i in range(0, len(x), 1024)])


def calibrate(logits: np.ndarray, y: np.ndarray, n: np.ndarray | None = None, rounds: int = 30) -> tuple[float, float]:
    """Slope and offset of the logistic fit of ``y`` to ``logits`` (each counted ``n`` times), by Newton
    steps to smoothed targets."""
    n = np.ones(len(y)) if n is None else n
    ones, rows = (n * y).sum(), n.sum()
    goal = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (rows - ones + 2))
    columns = np.stack([logits, np.ones(len(y))], axis=1)

    def loss(v):
        z = columns @ v
        return (n * (np.logaddexp(0, z) - goal * z)).sum()

    at = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(columns @ at, -35, 35)))
        move = np.linalg.solve((columns * (n * p * (1 - p))[:, None]).T @ columns + 1e-9 * np.eye(2), columns.T @ (n * (goal - p)))
        while np.abs(move).max() > 1e-9 and not loss(at + move) <= loss(at):
            move = move / 2
        at = at + move
    return float(at[0]), float(at[1])


class Learner:
    """A network and the moments of Adam."""

    names = ("embed", "conv", "conv_bias", "out", "out_bias")

    def __init__(self, net: CharNet):
        self.net, self.step = net, 0.0
        self.first = {n: np.zeros_like(np.asarray(getattr(net, n), float)) for n in self.names}
        self.second = {n: np.zeros_like(v) for n, v in self.first.items()}

    def vector(self) -> np.ndarray:
        """All that learning changes."""
        arrays = [*(getattr(self.net, n) for n in self.names), *self.first.values(), *self.second.values(), self.step]
        return np.concatenate([np.ravel(v) for v in arrays])

    @staticmethod
    def of(vector: np.ndarray, seed: int) -> Learner:
        out, at = Learner(CharNet.fresh(seed)), 0

        def take(like):
            nonlocal at
            at += like.size
            return vector[at - like.size:at].reshape(like.shape)

        for n in out.names:
            setattr(out.net, n, take(out.first[n]))
        for moments in (out.first, out.second):
            moments.update({n: take(v) for n, v in moments.items()})
        out.step = vector[at]
        return out

    def learn(self, shown: np.ndarray, goal: np.ndarray, weight: np.ndarray, order: np.ndarray, batch: int, rate: float) -> None:
        """One pass over the windows in ``order``, on the weighted log loss."""
        net = self.net
        size = net.embed.shape[1]
        span = net.conv.shape[0] // size
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            patches, hidden, pooled, p = net.forward(shown[rows])
            d_logit = (p - goal[rows]) * weight[rows] / len(rows)
            grads = {"out": pooled.T @ d_logit, "out_bias": d_logit.sum()}
            d_pool = d_logit[:, None] * net.out
            k = hidden.shape[2]
            top = hidden == hidden.max(1, keepdims=True)
            d_hidden = top / top.sum(1, keepdims=True) * d_pool[:, None, :k] + d_pool[:, None, k:] / hidden.shape[1]
            d_hidden *= hidden > 0
            grads["conv"] = patches.reshape(-1, patches.shape[2]).T @ d_hidden.reshape(-1, k)
            grads["conv_bias"] = d_hidden.sum((0, 1))
            d_patch = d_hidden @ net.conv.T
            places = hidden.shape[1]
            d_window = np.zeros((len(rows), WIDTH, size))
            for i in range(span):
                d_window[:, i:i + places] += d_patch[:, :, i * size:(i + 1) * size]
            spots = shown[rows][:, :, None] * size + np.arange(size)
            grads["embed"] = np.bincount(spots.ravel(), d_window.ravel(), CLASSES * size).reshape(CLASSES, size)
            self.step += 1
            for n in self.names:
                g = np.asarray(grads[n])
                self.first[n] = 0.9 * self.first[n] + 0.1 * g
                self.second[n] = 0.999 * self.second[n] + 0.001 * g * g
                move = rate * (self.first[n] / (1 - 0.9 ** self.step)) / (np.sqrt(self.second[n] / (1 - 0.999 ** self.step)) + 1e-8)
                setattr(net, n, getattr(net, n) - move)


def bins(p: np.ndarray) -> np.ndarray:
    """The logits of outputs in steps of 1 / ``STEPS``, rounded down."""
    p = np.clip(p, 1e-15, 1 - 1e-15)
    return np.floor(np.log(p / (1 - p)) * STEPS).astype(np.int64)


def settle(net: CharNet, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], recall: float, bare_recall: float) -> CharNet:
    """Calibrate ``net`` and set its thresholds by the held windows with and without their surroundings,
    each part as ``(bins, labels, counts)``."""
    slope, offset = 1.0, 0.0
    at, y, n = parts[0]
    if len(at):
        slope, offset = calibrate((at + 0.5) / STEPS, y, n)
        if slope > 0:  # else the net tells nothing, and turning it around would not help
            net.out, net.out_bias = net.out * slope, net.out_bias * slope + offset
        else:
            slope, offset = 1.0, 0.0
    for name, (at, y, n), wanted in zip(("threshold", "bare_threshold"), parts, (recall, bare_recall)):
        order = np.argsort(at[y == 1], kind="stable")
        good, upto = at[y == 1][order], np.cumsum(n[y == 1][order])
        if len(good):
            # The highest step that keeps the wanted share of the held findings.
            low = good[np.searchsorted(upto, int(np.floor((1 - wanted) * upto[-1])), "right")] / STEPS
            setattr(net, name, float(1 / (1 + np.exp(-(low * slope + offset)))))
    return net


def train(x: np.ndarray, y: np.ndarray, *, recall: float = 0.98, bare_recall: float = 0.9, epochs: int = ROUNDS,
          batch: int = BATCH, rate: float = RATE, seed: int = 7) -> CharNet:
    """Adam on the log loss, classes weighted alike, over windows in memory; a fifth of them sets the
    thresholds.  The rest is shown with and without its surroundings."""
    learner = Learner(CharNet.fresh(seed))
    net = learner.net
    if len(y) == 0 or y.min() == y.max():
        return net
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, used = order[: max(1, len(y) // 5)], order[max(1, len(y) // 5):]
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    shown = np.concatenate([x, bare(x)])
    used = np.concatenate([used, used + len(x)])
    weight, goal = np.concatenate([weight, weight]), np.concatenate([y, y])
    for _ in range(epochs):
        rng.shuffle(used)
        learner.learn(shown, goal, weight, used, batch, rate)
    return settle(net, [(bins(net.predict(w)), y[held], np.ones(len(held))) for w in (x[held], bare(x[held]))], recall, bare_recall)


def labelled_windows(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``(window, label, held)``: every distinct window of a candidate; label 1 where a fixed pattern marks
    one; a fifth, by a hash of the window, is held out of learning."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            windows, labels = [], []
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                spots = candidates(text)
                if not spots:
                    continue
                found = base_spans(text)
                for start, end in spots:
                    hit = any(s < end and start < e for s, e, _ in found)
                    for a, z in pieces(start, end):
                        windows.append(encode(text, a, z).astype(np.uint8).tobytes())
                        labels.append(int(hit))
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows, pa.binary()), pa.array(labels, pa.int32())], names=["window", "label"])

    found = df.select(F.col(text_col).alias("text")).mapInArrow(giving_back(run), fields("window binary, label int"))
    # Copies of a text hold the same windows; one of each is enough to learn from.
    return (found.groupBy("window").agg(F.max("label").alias("label"))
            .withColumn("held", F.pmod(F.xxhash64("window"), F.lit(5)) == 0))


def blocks_of(windows: DataFrame, rows: int, block_rows: int = BLOCK) -> DataFrame:
    """``(block, rows)``: all ``rows`` windows to learn from, in blocks of about ``block_rows`` by a hash."""
    count = max(1, round(rows / block_rows))
    block = F.pmod(F.xxhash64("window", F.lit(1)), F.lit(count)).alias("block")
    return (windows.where(~F.col("held")).select(block, "window", "label").repartition(count, "block")
            .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("window", "label"))).alias("rows")))


def _unpacked(windows) -> np.ndarray:
    return np.frombuffer(b"".join(windows.to_pylist()), np.uint8).reshape(-1, WIDTH).astype(np.int64)


def _round(blocks: DataFrame, vector: np.ndarray, turn: int, rows: int, class_weights: tuple[float, float], seed: int) -> np.ndarray:
    """Every block learns from its windows, starting from the same weights; Spark adds up the results, by the
    windows learned from.  The sums are of whole numbers, so their order has no effect."""
    import pyarrow as pa

    def run(batches):
        total = np.zeros(len(vector) + 1, np.int64)
        for batch in batches:
            for block, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                x, y = _unpacked(content.values.field("window")), content.values.field("label").to_numpy()
                learner = Learner.of(vector, seed)
                shown, goal = np.concatenate([x, bare(x)]), np.concatenate([y, y])
                order = np.random.default_rng([seed, turn, block]).permutation(len(goal))
                learner.learn(shown, goal, np.where(goal == 1, *class_weights[::-1]), order, BATCH, RATE)
                total += np.rint(np.append(learner.vector(), 1.0) * (len(x) / rows * 2.0 ** 40)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["spot", "n"])

    got = blocks.mapInArrow(giving_back(run), fields("spot long, n long")).groupBy("spot").agg(F.sum("n").alias("n")).toArrow()  # a fixed number of spots
    total = np.zeros(len(vector) + 1)
    total[got.column("spot").to_numpy()] = got.column("n").to_numpy()
    return total[:-1] / total[-1] if total[-1] else vector


def fit(df: DataFrame, text_col: str = "text", *, recall: float = 0.98, bare_recall: float = 0.9, seed: int = 7,
        block_rows: int = BLOCK) -> CharNet:
    """The network learned from all windows of ``df`` but the held ones, which all set the thresholds.

    In each round blocks of windows learn side by side, as in :func:`train`, and their weights are averaged.
    With few blocks each learns in every round; with many they take turns, so each learns in two rounds or
    more.  Only weights and counts reach the driver, and their number is fixed."""
    import pyarrow as pa

    windows = saved(labelled_windows(df, text_col), "windows")
    n = {(r["label"], r["held"]): r["count"] for r in windows.groupBy("label", "held").count().collect()}  # four rows at most
    sizes = [sum(c for (label, _), c in n.items() if label == k) for k in (0, 1)]
    rows = sum(c for (_, held), c in n.items() if not held)
    net = CharNet.fresh(seed)
    if not all(sizes) or not rows:
        release(windows)
        return net
    class_weights = tuple(0.5 * sum(sizes) / size for size in sizes)
    count = max(1, round(rows / block_rows))
    blocks = saved(blocks_of(windows, rows, block_rows), "window-blocks")
    turns = max(t for t in (1, 2, 3, 4, 6) if t == 1 or 4 * t <= count)
    vector = Learner(net).vector()
    for turn in range(ROUNDS):
        mine = blocks.where(F.col("block") % turns == turn % turns) if turns > 1 else blocks
        vector = _round(mine, vector, turn, rows, class_weights, seed)
    net = Learner.of(vector, seed).net

    def judge(batches):
        for batch in batches:
            x = _unpacked(batch.column(0))
            for is_bare in (False, True):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), is_bare)), batch.column(1), pa.array(bins(net.predict(bare(x) if is_bare else x)))],
                                                 names=["bare", "label", "bin"])

    judged = windows.where("held").select("window", "label").mapInArrow(giving_back(judge), fields("bare boolean, label int, bin long"))
    got = judged.groupBy("bare", "label", "bin").count().toArrow()  # a fixed number of bins
    columns = [got.column(c).to_numpy() for c in ("bin", "label", "count")]
    is_bare = got.column("bare").to_numpy().astype(bool)
    parts = [tuple(c[is_bare == k] for c in columns) for k in (False, True)]
    release(windows, blocks)
    return settle(net, parts, recall, bare_recall)


def scan(df: DataFrame, net: CharNet, text_col: str = "text") -> DataFrame:
    """``df`` with ``secret_spans``: every finding as ``kind:start:end`` (code points, end
    exclusive) by start, then kind in the order of ``KINDS``."""

    def setup():
        def fn(texts):
            found = [base_spans(t) if t else [] for t in texts]
            spots, firsts, windows = [], [], []
            for i, text in enumerate(texts):
                for start, end in candidates(text) if text else ():
                    spots.append((i, start, end))
                    firsts.append(len(windows))
                    windows += [encode(text, a, z) for a, z in pieces(start, end)]
            if windows:
                x = np.array(windows)
                yes = (net.predict(x) >= net.threshold) | (net.predict(bare(x)) >= net.bare_threshold)
                for (i, start, end), yes in zip(spots, np.logical_or.reduceat(yes, firsts)):  # the likeliest part counts
                    if yes and not any(s < end and start < e for s, e, k in found[i] if k != "model"):
                        found[i].append((start, end, "model"))
            return [[[f"{k}:{s}:{e}" for s, e, k in ordered(f)] for f in found]]

        return fn

    return map_rows(df, [text_col], fields("secret_spans strings"), setup)


def redact(df: DataFrame, text_col: str = "text", spans_col: str = "secret_spans",
           mark: str = "[SECRET]") -> DataFrame:
    """``text`` with every span replaced by ``mark``; overlapping spans become one mark."""

    def setup():
        def fn(texts, spans):
            out = []
            for text, marks in zip(texts, spans):
                if text and marks:
                    parts, at = [], 0
                    for start, end in sorted(tuple(map(int, m.split(":")[1:])) for m in marks):
                        if start >= at:
                            parts += [text[at:start], mark]
                        at = max(at, end)
                    text = "".join(parts) + text[at:]
                out.append(text)
            return [out]

        return fn

    kind = fields(f"{text_col} string")
    order = df.columns
    return map_rows(df, [text_col, spans_col], kind, setup).select(*[f"`{c}`" for c in order])


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    found = scan(docs, fit(docs)).select("doc_id", "secret_spans")

    def count(kind):
        return F.size(F.filter("secret_spans", lambda s: s.startswith(kind + ":"))).cast("long")

    base = F.filter("secret_spans", lambda s: ~s.startswith("model:"))
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join("secret_spans", ",").alias("spans"), count("model").alias("n_model"))
