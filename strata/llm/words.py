"""Words of many texts at once, as 64-bit hashes made on whole arrays of bytes."""

from __future__ import annotations

import numpy as np
import xxhash

from strata.llm.substrings import _mix

LONG = 256  # bytes; longer words are hashed one by one
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Words:
    """The words of ``texts`` in order: ``raw`` (UTF-8; with ``lower``, A-Z lower-cased), ``starts`` and
    ``lengths`` of the words in it, ``hashes``, and ``sizes``, the words of each text."""

    def __init__(self, texts: list[str | None], lower: bool = False):
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        raw = b"\n".join([b"", *parts, bytes(8)])  # every text between two blanks, and room to read past the last word
        self.raw = raw.lower() if lower else raw
        data = np.frombuffer(self.raw, np.uint8)
        blank = (data == 32) | (data - np.uint8(9) <= 4)
        blank[-8:] = True
        edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        starts, lengths = edges[0::2], edges[1::2] - edges[0::2]
        ends = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)
        self.sizes = np.diff(np.searchsorted(starts, ends, "right"), prepend=0)
        self.starts, self.lengths = starts.astype(np.int32), lengths.astype(np.int32)
        self.hashes = self._hashes(starts, lengths)

    def word(self, at: int) -> bytes:
        return self.raw[self.starts[at]:int(self.starts[at]) + int(self.lengths[at])]

    def _hashes(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Eight bytes of all words at a time."""
        eight = np.ndarray(len(self.raw) - 7, "<u8", self.raw, strides=(1,))
        out = _mix((eight[starts] & _MASKS[np.minimum(lengths, 8)]) + lengths.astype(np.uint64) * _STEP)
        for at in np.flatnonzero(lengths > LONG).tolist():
            out[at] = xxhash.xxh3_64_intdigest(self.word(at))
        left = np.flatnonzero((lengths > 8) & (lengths <= LONG))
        done = 8
        while len(left):
            rest = lengths[left] - done
            out[left] = _mix(out[left] * _STEP + (eight[starts[left] + done] & _MASKS[np.minimum(rest, 8)]))
            left = left[rest > 8]
            done += 8
        return out
