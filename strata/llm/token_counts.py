"""Token counts by a two-tier lookup, computed where the text lies: no pre-token is shuffled.

A byte-level BPE tokenizer first cuts a text into pre-tokens and then merges inside each one, so
the number of tokens of a text is the sum of the numbers of its pre-tokens.  Natural text repeats
few pre-tokens very often.  The first tier is a table of the most frequent ones with their
lengths in tokens: every task summarises all its texts by a bounded counter of what stands between
two blanks (frequent items kept, counts lowered together when it is full) and cuts only what is left
in it into pre-tokens; the summaries, ``SUMMARY`` entries a task at most, are added up, and the
``TABLE`` largest become the table, whose size therefore never grows with the data.  The table only
decides what is found quickly, never a count.
The second tier is a cache of each worker process, bounded in bytes: pre-tokens the table lacks are
encoded once by the library, a slice's misses in one call, and remembered.

The cutting expression's letters and numbers are those of the library: its own pre-tokenizer is
asked on the driver about every code point, and texts that hold one on which the ``regex`` module
differs are cut with corrected classes.  Special strings inside a text count as the library's
default has it: one token each.

A null text counts as empty: no bytes, no tokens.  Texts of any length are counted whole; from
``LONG`` characters on their pre-tokens are taken in portions, so no list grows with the text.
Repeated rows get equal counts, null ids stay null, an empty table gives an empty result.  Only the
id and text columns are read and only the id and the results are returned, so further columns of
any name have no effect.
"""

from __future__ import annotations

import functools
import json
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SLICE, fields, load, map_rows

TOKENIZER_PATH = "/opt/tokenizers/byte_bpe_50k.json"
LIMIT = 512          # tokens; a document of more is over the limit
TABLE = 32_768       # pre-tokens in the broadcast table
TABLE_KEY = 64       # characters; a longer pre-token is left to the second tier
SUMMARY = 8_192      # pre-tokens a task hands over at most
CACHE_BYTES = 64 << 20
LONG = 1 << 20       # characters
PORTION = 1 << 17    # pre-tokens of a long text held at a time

# Fixed value: the cutting expression of this kind of tokenizer, with its letter and number
# classes left open.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s{l}{n}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Cutter:
    """What a worker needs to cut a text as the library does."""
    odd: str                  # pattern of code points the two libraries class differently, or ""
    own: str                  # cutting pattern with the library's classes
    specials: tuple[str, ...]

    def build(self) -> Callable[[str], Iterable[list[str]]]:
        """A function giving the pre-tokens of a text, in lists; each special string is an item
        of its own."""
        plain = regex.compile(CUT.format(L=r"\p{L}", N=r"\p{N}", l=r"\p{L}", n=r"\p{N}"))
        own = regex.compile(self.own, regex.V1) if self.odd else plain
        odd = regex.compile(self.odd) if self.odd else None
        apart = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")") \
            if self.specials else None

        def cut(text: str) -> Iterator[list[str]]:
            parts = apart.split(text) if apart is not None and any(s in text for s in self.specials) else (text,)
            for at, part in enumerate(parts):
                if at % 2:
                    yield [part]
                    continue
                pattern = plain if odd is None or part.isascii() or odd.search(part) is None else own
                if len(part) < LONG:
                    yield pattern.findall(part)
                else:
                    found = (m.group() for m in pattern.finditer(part))
                    while portion := list(islice(found, PORTION)):
                        yield portion

        return cut


def _ranges(chars: Iterable[str]) -> str:
    """The inside of a character class holding ``chars``."""
    out, points = [], sorted(map(ord, chars))
    for point in points:
        if out and out[-1][1] == point - 1:
            out[-1][1] = point
        else:
            out.append([point, point])
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in out)


@functools.lru_cache(maxsize=4)
def cutter(path: str = TOKENIZER_PATH) -> Cutter:
    """The cutting rule of the tokenizer file at ``path``; ValueError if it is of another kind."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    first = made.get("pre_tokenizer") or {}
    if made.get("normalizer") or first.get("type") != "ByteLevel" or first.get("add_prefix_space") \
            or not first.get("use_regex", True) or made["model"]["type"] != "BPE":
        raise ValueError(f"{path} is not a byte-level BPE tokenizer without normalizer and prefix blank")
    added = made.get("added_tokens") or []
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        raise ValueError(f"{path} has special strings that take in their surroundings")
    ask = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    every = "".join(chr(p) for p in range(0x110000) if not 0xD800 <= p < 0xE000)
    # Runs of what the module takes for one class, put to the library: where it sees more than
    # one class it cuts, and what each part is shows when the part follows a known character.
    theirs: dict[str, set[str]] = {"L": set(), "N": set()}
    ours = {}
    for kind, pattern, lead in (("L", r"\p{L}", "a"), ("N", r"\p{N}", "1"), ("O", r"[^\s\p{L}\p{N}]", "!")):
        found = regex.findall(pattern, every)
        ours[kind], run = set(found), "".join(found)
        for _, (start, end) in ask(lead + run):
            part = run[max(0, start - 1):end - 1]
            if start == 0:  # not cut off from the known character: of its class
                theirs.get(kind, set()).update(part)
                continue
            for name, known in (("L", "a"), ("N", "1")):
                if len(ask(known + part)) == 1:
                    theirs[name].update(part)
    differ = (theirs["L"] ^ ours["L"]) | (theirs["N"] ^ ours["N"])
    classes = {}
    for name in ("L", "N"):
        more, less = theirs[name] - ours[name], ours[name] - theirs[name]
        inner = rf"\p{{{name}}}" + _ranges(more)
        classes[name] = f"[[{inner}]--[{_ranges(less)}]]" if less else f"[{inner}]"
    own = (CUT.replace("[^\\s{l}{n}]", "[^\\s{L}{N}]").replace("{L}", classes["L"]).replace("{N}", classes["N"]))
    return Cutter(f"[{_ranges(differ)}]" if differ else "", own, tuple(t["content"] for t in added))


def frequent(docs: DataFrame, path: str = TOKENIZER_PATH, text_col: str = "text", size: int = TABLE,
             summary: int = SUMMARY) -> list[str]:
    """The pre-tokens that occur most often in all of ``docs``, ``size`` at most, by the tasks'
    summaries (a pre-token's count may come out too low, which costs speed only)."""
    rule = cutter(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen = rule.build(), Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                for text in batch.slice(at, SLICE).column(0).to_pylist():
                    for begin in range(0, len(text or ""), LONG):
                        seen.update(text[begin:begin + LONG].split(" "))
                        if len(seen) > 16 * summary:  # a bounded counter: lower all, keep the rest
                            floor = sorted(seen.values(), reverse=True)[4 * summary]
                            seen = Counter({t: n - floor for t, n in seen.items() if n > floor and len(t) <= TABLE_KEY})
        tokens: Counter[str] = Counter()
        for piece, n in seen.items():
            for some in cut(" " + piece if len(piece) <= TABLE_KEY else ""):
                for token in some:
                    tokens[token] += n
        top = [(t, n) for t, n in tokens.most_common(2 * summary) if len(t) <= TABLE_KEY][:summary]
        if top:
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
                                             names=["token", "n"])

    counts = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "token string, n long")
    best = counts.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(size)
    return [r["token"] for r in best.collect()]  # bounded by ``size`` short strings


def encoded_lengths(path: str) -> Callable[[list[str]], list[int]]:
    """How many tokens the library makes of each string, its own worker threads off."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Lookup:
    """The two tiers of one worker: the broadcast table and a cache of what it lacks."""

    def __init__(self, table: dict[str, int], encode: Callable[[list[str]], list[int]], cache_bytes: int = CACHE_BYTES):
        self.table, self.encode, self.most = table, encode, cache_bytes
        self.known, self.held = dict(table), 0

    def learn(self, tokens: set[str]) -> None:
        fresh = [t for t in tokens if t not in self.known]
        if not fresh:
            return
        size = sum(map(len, fresh)) * 2 + 100 * len(fresh)
        if self.held + size > self.most:  # start the cache anew; what is needed comes again
            self.known, self.held = dict(self.table), 0
            fresh = [t for t in tokens if t not in self.known]
        self.known.update(zip(fresh, self.encode(fresh)))
        self.held += size

    def total(self, tokens: list[str]) -> int:
        try:
            return sum(map(self.known.__getitem__, tokens))
        except KeyError:
            self.learn(set(tokens))
            return sum(map(self.known.__getitem__, tokens))


def count(docs: DataFrame, path: str = TOKENIZER_PATH, limit: int = LIMIT, id_col: str = "doc_id",
          text_col: str = "text", table: list[str] | None = None) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row; ``table`` are the pre-tokens of the
    first tier (found by :func:`frequent` if not given)."""
    spark = docs.sparkSession
    rule = cutter(path)
    first = frequent(docs, path, text_col) if table is None else table
    shared = spark.sparkContext.broadcast(dict(zip(first, encoded_lengths(path)(first))) if first else {})

    def setup():
        cut, lookup = rule.build(), Lookup(shared.value, encoded_lengths(path))

        def run(texts: list[str | None]) -> list:
            sizes, totals = [], []
            for text in texts:
                sizes.append(len(text.encode("utf-8", "surrogatepass")) if text else 0)
                totals.append(sum(lookup.total(tokens) for tokens in cut(text)) if text else 0)
            return [sizes, totals, [n > limit for n in totals]]

        return run

    src = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias(text_col))
    return map_rows(src, [text_col], fields("n_bytes long, n_tokens long, over_limit boolean"), setup).select(
        id_col, "n_bytes", "n_tokens", "over_limit")


def op12_token_counts(spark, sf_dir: str) -> DataFrame:
    return count(load(spark, sf_dir, "documents", "doc_id", "text"))
