"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie of pieces.

``load_pieces`` reads the pieces of a public model file (its path is a parameter; nothing is
trained).  A Unigram model's own log scores are used.  A merge-order model has no log scores,
only ranks; its pieces then get the Zipf log score of their rank, ``-log(rank + 1)``.

Encoding marks white space (``▁`` for a blank, one in front of the text), takes the segmentation
with the largest sum of scores, and writes a character that no piece holds as its UTF-8 bytes by
the byte pieces, at a score below every piece's.  Of equally good segmentations the one whose
last piece is longest wins, from the end backwards.  Decoding joins the pieces' bytes, turns the
marks into blanks and drops the first.  A literal ``▁`` in the text goes through the byte pieces,
so decoding gives back the exact text, whatever it holds.

A null text stays null (no ids); an empty text has no ids; texts of any length are encoded whole;
repeated rows get equal ids; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fields, load, map_rows

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
LITERAL_MARK = "\udc00"  # stands for a ``▁`` of the text; no valid text holds a lone surrogate


@dataclass(frozen=True)
class Pieces:
    texts: tuple[str, ...]       # "" for control and byte pieces
    scores: np.ndarray
    byte_ids: tuple[int, ...]    # id of each of the 256 byte pieces
    decoded: tuple[bytes, ...]   # what each id stands for
    unknown_score: float


def load_pieces(path: str = MODEL_PATH) -> Pieces:
    """The pieces of a model file.  The model must have all 256 byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts, scores, decoded = [], [], []
    byte_ids = [-1] * 256
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        scores.append(sp.get_score(i))
        if sp.is_byte(i):
            value = int(piece[3:-1], 16)
            byte_ids[value] = i
            decoded.append(bytes([value]))
            texts.append("")
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            decoded.append(b"")
            texts.append("")
        else:
            decoded.append(piece.replace(MARK, " ").encode("utf-8"))
            texts.append(piece)
    if min(byte_ids) < 0:
        raise ValueError(f"{path} has no byte pieces")
    got = np.array(scores, float)
    normal = np.array([bool(t) for t in texts])
    if np.all(got[normal] == np.round(got[normal])):  # merge ranks, not log scores
        order = np.argsort(-got[normal], kind="stable")
        rank = np.empty(len(order))
        rank[order] = np.arange(len(order))
        got[normal] = -np.log(rank + 1.0)
    return Pieces(tuple(texts), got, tuple(byte_ids), tuple(decoded), float(got[normal].min() - 10.0))


@dataclass(frozen=True)
class DoubleArray:
    """A trie in two arrays: from state ``s`` sign ``c`` leads to ``base[s] + c`` if that slot's
    ``check`` is ``s``."""

    codes: dict[str, int]
    base: np.ndarray
    check: np.ndarray
    ids: np.ndarray      # piece that ends in a state, or -1
    scores: np.ndarray
    longest: int


SLOTS = 2048  # slots of the double array tried at a time


def build_trie(pieces: Pieces) -> DoubleArray:
    alphabet = sorted({c for t in pieces.texts for c in t})
    codes = {c: i + 1 for i, c in enumerate(alphabet)}
    root: dict = {}
    for i, text in enumerate(pieces.texts):
        if text:
            node = root
            for c in text:
                node = node.setdefault(codes[c], {})
            node[0] = i
    size = 1 << 17
    base, check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
    ids, scores = np.full(size, -1, np.int64), np.full(size, -np.inf)
    check[0] = 0
    queue = [(0, root)]
    free = 1  # no slot below this one is free
    for state, node in queue:
        if 0 in node:
            ids[state], scores[state] = node[0], pieces.scores[node[0]]
        signs = np.array(sorted(k for k in node if k), np.int64)
        if not len(signs):
            continue
        while check[free] >= 0:
            free += 1
        low = max(free, int(signs[0]) + 1)  # the first sign's slot is looked for from here
        while True:
            while low + SLOTS + len(alphabet) + 2 >= len(check):
                grow = len(check)
                base = np.concatenate([base, np.zeros(grow, np.int64)])
                check = np.concatenate([check, np.full(grow, -1, np.int64)])
                ids = np.concatenate([ids, np.full(grow, -1, np.int64)])
                scores = np.concatenate([scores, np.full(grow, -np.inf)])
            starts = low + np.flatnonzero(check[low:low + SLOTS] < 0) - signs[0]
            for sign in signs[1:]:
                starts = starts[check[starts + sign] < 0]
            if len(starts):
                break
            low += SLOTS
        at = int(starts[0])
        base[state] = at
        check[at + signs] = state
        queue.extend((at + int(s), node[int(s)]) for s in signs)
    end = int(np.flatnonzero(check >= 0).max()) + len(alphabet) + 2
    return DoubleArray(codes, base[:end], check[:end], ids[:end], scores[:end],
                       max((len(t) for t in pieces.texts), default=1))


def chunk_pattern(pieces: Pieces) -> re.Pattern:
    """Cuts that no piece crosses: in front of a mark that follows another sign, and around
    newlines.  A vocabulary with a piece across such a cut is encoded uncut."""
    across = re.compile(f"[^{MARK}]{MARK}|.\n|\n.", re.DOTALL)
    if any(across.search(t) for t in pieces.texts):
        return re.compile(r".+", re.DOTALL)
    return re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


LOCKSTEP_CHARS = 48      # longer chunks are searched one at a time
MEMO_CHUNKS = 120_000    # chunks a task remembers before it starts anew


class Encoder:
    """Segments chunks, many at a time, and remembers them."""

    def __init__(self, pieces: Pieces, trie: DoubleArray):
        self.p, self.t = pieces, trie
        self.pattern = chunk_pattern(pieces)
        self.forget()

    def forget(self):
        self.memo: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(MEMO_CHUNKS + 1, np.int64)
        self.used = 0

    def _store(self, chunk: str, ids) -> None:
        n = len(self.memo)
        if n + 2 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(len(self.starts), np.int64)])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.int32)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.memo[chunk] = n
        self.used += len(ids)
        self.starts[n + 1] = self.used

    def fallback(self, sign: str) -> list[int]:
        sign = MARK if sign == LITERAL_MARK else sign
        return [self.p.byte_ids[b] for b in sign.encode("utf-8", "surrogatepass")]

    def one(self, chunk: str) -> list[int]:
        """Viterbi over one chunk of any length."""
        t, n = self.t, len(chunk)
        codes = [t.codes.get(c, 0) for c in chunk]
        best, back, piece = [-math.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        base, check, ids, scores = t.base, t.check, t.ids, t.scores
        for s in range(n):
            here, state, single = best[s], 0, False
            for e in range(s, n):
                c = codes[e]
                nxt = base[state] + c
                if not c or check[nxt] != state:
                    break
                state = nxt
                if ids[state] >= 0:
                    single |= e == s
                    value = here + scores[state]
                    if value > best[e + 1]:
                        best[e + 1], back[e + 1], piece[e + 1] = value, s, int(ids[state])
            if not single and here + self.p.unknown_score > best[s + 1]:
                best[s + 1], back[s + 1], piece[s + 1] = here + self.p.unknown_score, s, -1
        out, at = [], n
        while at:
            s = back[at]
            out.append(self.fallback(chunk[s]) if piece[at] < 0 else [piece[at]])
            at = s
        return [i for ids_ in reversed(out) for i in ids_]

    def many(self, chunks: list[str]) -> None:
        """Viterbi over many short chunks in lockstep, longest first."""
        chunks = sorted(chunks, key=len, reverse=True)
        t, k = self.t, len(chunks)
        size = np.fromiter(map(len, chunks), np.int64, k)
        width = int(size[0])
        points = np.zeros((k, width), np.int64)
        joined = "".join(c.ljust(width, "\0") for c in chunks)
        raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(k, width)
        signs, where = np.unique(raw, return_inverse=True)
        points = np.array([t.codes.get(chr(s), 0) for s in signs], np.int64)[where.reshape(k, width)]
        best = np.full((width + 1, k), -np.inf)
        back, piece = np.zeros((width + 1, k), np.int32), np.full((width + 1, k), -1, np.int32)
        best[0] = 0.0
        live_at = [int(np.searchsorted(-size, -s, side="left")) for s in range(width)]  # size > s
        for s in range(width):
            live = live_at[s]
            rows = np.arange(live)
            state = np.zeros(live, np.int64)
            single = np.zeros(live, bool)
            for e in range(s, min(width, s + t.longest)):
                ok = rows < live_at[e]
                rows, state = rows[ok], state[ok]
                c = points[rows, e]
                nxt = t.base[state] + c
                ok = (c > 0) & (t.check[nxt] == state)
                rows, state = rows[ok], nxt[ok]
                if not len(rows):
                    break
                ends = t.ids[state] >= 0
                r, st = rows[ends], state[ends]
                if e == s:
                    single[r] = True
                value = best[s, r] + t.scores[st]
                up = value > best[e + 1, r]
                r = r[up]
                best[e + 1, r] = value[up]
                back[e + 1, r] = s
                piece[e + 1, r] = t.ids[st[up]]
            r = np.flatnonzero(~single)
            value = best[s, r] + self.p.unknown_score
            up = value > best[s + 1, r]
            r = r[up]
            best[s + 1, r] = value[up]
            back[s + 1, r] = s
            piece[s + 1, r] = -1
        # Walk back in lockstep; row i of ``steps`` holds every chunk's i-th piece from the end.
        at, rows, steps, spots = size.copy(), np.arange(k), [], []
        n_pieces = np.zeros(k, np.int64)
        while True:
            rows = rows[at[rows] > 0]
            if not len(rows):
                break
            step, spot = np.full(k, -2, np.int32), np.zeros(k, np.int32)
            step[rows] = piece[at[rows], rows]
            at[rows] = back[at[rows], rows]
            spot[rows] = at[rows]
            n_pieces[rows] += 1
            steps.append(step)
            spots.append(spot)
        path = np.array(steps).T[:, ::-1]
        unknown = (path == -1).any(axis=1)
        flat = path[path != -2]
        ends = np.cumsum(n_pieces)
        for i in np.flatnonzero(unknown):  # spell the unknown signs as bytes
            ids = []
            for piece_id, spot in zip([s[i] for s in steps][::-1], [s[i] for s in spots][::-1]):
                if piece_id >= 0:
                    ids.append(int(piece_id))
                elif piece_id == -1:
                    ids += self.fallback(chunks[i][spot])
            self._store(chunks[i], ids)
        known = np.flatnonzero(~unknown)
        keep = np.repeat(~unknown, n_pieces)
        self._store_all([chunks[i] for i in known], flat[keep], n_pieces[known])

    def _store_all(self, chunks: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self.memo)
        while n + len(chunks) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(len(self.starts), np.int64)])
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.int32)])
        self.flat[self.used:self.used + len(flat)] = flat
        self.starts[n + 1:n + 1 + len(chunks)] = self.used + np.cumsum(lengths)
        self.used += len(flat)
        self.memo.update(zip(chunks, range(n, n + len(chunks))))

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        if len(self.memo) > MEMO_CHUNKS:
            self.forget()
        cut = [None if x is None else
               self.pattern.findall(MARK + x.replace(MARK, LITERAL_MARK).replace(" ", MARK)) if x else []
               for x in texts]
        fresh = {c for chunks in cut if chunks for c in chunks if c not in self.memo}
        short = [c for c in fresh if len(c) <= LOCKSTEP_CHARS]
        for at in range(0, len(short), 20_000):
            self.many(short[at:at + 20_000])
        for c in fresh:
            if len(c) > LOCKSTEP_CHARS:
                self._store(c, self.one(c))
        out = []
        for chunks in cut:
            if not chunks:
                out.append(None if chunks is None else np.zeros(0, np.int32))
                continue
            where = np.fromiter(map(self.memo.__getitem__, chunks), np.int64, len(chunks))
            start, end = self.starts[where], self.starts[where + 1]
            lengths = end - start
            total = np.cumsum(lengths)
            spots = np.arange(total[-1]) + np.repeat(start - (total - lengths), lengths)
            out.append(self.flat[spots])
        return out


def id_type(pieces: Pieces) -> np.dtype:
    return np.dtype("<u2") if len(pieces.texts) <= 1 << 16 else np.dtype("<u4")


def encode(df: DataFrame, path: str = MODEL_PATH, text_col: str = "text", name: str = "ids") -> DataFrame:
    """``df`` with ``ids``: the piece ids of each text, packed little-endian (two bytes an id,
    four for vocabularies over 65,536), the compact form training shards keep."""
    pieces = load_pieces(path)
    kind = id_type(pieces)
    shared = df.sparkSession.sparkContext.broadcast((pieces, build_trie(pieces)))

    def setup():
        encoder = Encoder(*shared.value)
        return lambda texts: [[None if ids is None else ids.astype(kind).tobytes()
                               for ids in encoder.encode(texts)]]

    return map_rows(df, [text_col], fields(f"{name} binary"), setup, slice_rows=256)


def decode(df: DataFrame, path: str = MODEL_PATH, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with the text that packed ids stand for; bytes that are no UTF-8 become U+FFFD."""
    pieces = load_pieces(path)
    kind = id_type(pieces)
    shared = df.sparkSession.sparkContext.broadcast(pieces.decoded)

    def setup():
        table = shared.value

        def text(ids):
            if ids is None:
                return None
            got = b"".join(map(table.__getitem__, np.frombuffer(ids, kind).tolist()))
            got = got[1:] if got[:1] == b" " else got
            return got.decode("utf-8", "replace")

        return lambda rows: [[text(ids) for ids in rows]]

    return map_rows(df, [ids_col], fields(f"{name} string"), setup, slice_rows=256)


def n_tokens(pieces_in_file: int, ids: str = "ids") -> Column:
    return (F.octet_length(ids) / (2 if pieces_in_file <= 1 << 16 else 4)).cast("long")


def op1_sentencepiece(spark, sf_dir: str, path: str = MODEL_PATH) -> DataFrame:
    both = decode(encode(load(spark, sf_dir, "documents", "doc_id", "text"), path), path)
    return both.select("doc_id", n_tokens(len(load_pieces(path).texts)).alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
                       F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))
