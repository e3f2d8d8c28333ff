"""N-gram Jaccard join by signature trees, and its connected components.

A document's set is its distinct shingles (runs of ``size`` lower-cased words; a shorter text is
one shingle).  Equal texts are one node.  Sets that are similar enough share a shingle among the
first of each by any fixed order of all shingles (the prefix filter); the order is by a sketch of the
shingles' counts, rare ones first, so sets meet in small buckets.  The sketch only orders: it has a
fixed size and its errors cost time, never links.

1. every set is compared with one set of each of its buckets, where sizes and bitmaps allow a link,
   which already connects most copies;
2. in each bucket that still holds several components, sorted rows form a signature tree: nodes
   hold the OR and the AND of the token bitmaps, the fewest bits of one, and the range of sizes and
   components below them.  A dual traversal drops node pairs of one component or whose largest
   possible overlap is too small.  A bucket of more than ``CELL`` rows is cut into cells by size band,
   large component and key; pairs of cells, each with a tree of its own, are spread over the tasks.
   A pair is given out where its sets first meet: rows carry the ``LOW`` smallest of their set's shared
   shingles, and a pair that has some of these in common counts only in the bucket of the smallest.

Surviving pairs are verified on the shingles of their texts, which are made once for each set.  No link between components is lost; a pair
within a component found before is not looked for, since it cannot change the result.

Null and blank texts have the empty set and no links; repeated rows and equal texts are linked
(a set that is not empty equals itself); a null id is never a component's id unless all its
members' are null; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import giving_back, ascii_lower, drop_shuffles, fields, load, map_rows, release, saved, words_of
from strata.llm.substrings import _mix, _powers
from strata.llm.words import Words

SHINGLE, PERCENT = 5, 75
BITMAP_BYTES = 128
LEAF = 32  # rows of a leaf of the tree
CELL = 2048  # rows of a cell of a large bucket, about
SLICE = 128  # texts whose words are hashed together
LOW = 16  # shingles by which a pair knows where its sets first meet
SLOT_BITS = 18  # the count sketch has 2 ** SLOT_BITS numbers at any input size
_LAST_ID = (1 << 63) - 1


class Shingler:
    """Sorted 64-bit hashes of texts' distinct shingles; the words of many texts are hashed together."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.factors = _powers(0xC2B2AE3D27D4EB4F, size)

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        words = Words(texts, lower=True)
        codes, size = words.hashes, self.size
        runs = np.zeros(max(len(codes) - size + 1, 0), np.uint64)
        for k, factor in enumerate(self.factors):
            runs += codes[k:k + len(runs)] * factor
        runs = _mix(runs + np.uint64(size))
        out, at = [], 0
        for n in words.sizes.tolist():
            if n >= size:
                mine = np.sort(runs[at:at + n - size + 1].view(np.int64))
                out.append(mine[np.concatenate([[True], mine[1:] != mine[:-1]])])
            elif n:  # the whole text; shorter runs differ from the start
                out.append(_mix((codes[at:at + n] * self.factors[:n]).sum(keepdims=True) + np.uint64(n)).view(np.int64))
            else:
                out.append(np.zeros(0, np.int64))
            at += n
        return out


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    return Shingler(size)([text])[0]


def bitmap(codes: np.ndarray) -> bytes:
    bits = np.zeros(BITMAP_BYTES * 8, bool)
    bits[(codes.view(np.uint64) % np.uint64(BITMAP_BYTES * 8)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _slots(codes: np.ndarray) -> np.ndarray:
    return (codes.view(np.uint64) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def sketch(docs: DataFrame, size: int) -> np.ndarray:
    """How many sets have a shingle of each slot: summed in each task, then by Spark."""
    def run(batches):
        shingler, counts = Shingler(size), np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                got = shingler(batch.column(0).slice(at, SLICE).to_pylist())
                counts += np.bincount(_slots(np.concatenate(got)), minlength=1 << SLOT_BITS)
        spots = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(spots), pa.array(counts[spots])], names=["slot", "c"])

    got = docs.select("text").mapInArrow(giving_back(run), "slot long, c long").groupBy("slot").agg(F.sum("c").alias("c")).toArrow()
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    counts[got.column("slot").to_numpy()] = got.column("c").to_numpy()
    return counts


def sets_of(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per row ``n`` (set size), ``prefix`` (the first shingles by the sketch) and ``bits``."""
    counts = docs.sparkSession.sparkContext.broadcast(sketch(docs, size))  # 2 ** SLOT_BITS numbers

    def setup():
        shingler, common = Shingler(size), counts.value

        def prefix(codes: np.ndarray) -> list[int]:
            room = len(codes) - -(-percent * len(codes) // 100) + 1 if len(codes) else 0
            return codes[np.argsort(common[_slots(codes)], kind="stable")[:room]].tolist()  # codes come sorted

        def fn(texts):
            got = shingler(texts)
            return [[len(g) for g in got], [prefix(g) for g in got], [bitmap(g) for g in got]]
        return fn

    return map_rows(docs, ["text"], fields("n long, prefix longs, bits binary"), setup, slice_rows=SLICE).drop("text")


def _tree(lo: int, hi: int, comps, sizes, bits) -> tuple:
    """Root over the rows from ``lo`` to ``hi``.  A node: OR, smallest and largest size, smallest and
    largest component, its rows, its children (None for a leaf), AND, fewest bits of a row."""
    level = []
    for a in range(lo, hi, LEAF):
        z = min(a + LEAF, hi)
        s, c, b = sizes[a:z], comps[a:z], bits[a:z]
        level.append((np.bitwise_or.reduce(b, axis=0), s.min(), s.max(), c.min(), c.max(), a, z, None,
                      np.bitwise_and.reduce(b, axis=0), np.bitwise_count(b).sum(axis=1, dtype=np.int64).min()))
    while len(level) > 1:
        level = [(np.bitwise_or.reduce([k[0] for k in kids], axis=0), min(k[1] for k in kids), max(k[2] for k in kids),
                  min(k[3] for k in kids), max(k[4] for k in kids), kids[0][5], kids[-1][6], kids,
                  np.bitwise_and.reduce([k[8] for k in kids], axis=0), min(k[9] for k in kids))
                 for kids in (level[i:i + 4] for i in range(0, len(level), 4))]
    return level[0]


def apart(a: tuple, b: tuple, percent: int) -> bool:
    """Whether no row of node ``a`` can be similar enough to one of ``b``, by sizes and bitmaps.

    A row that has ``lone`` bits which the other lacks shares at most its size less ``lone``."""
    common = int(np.bitwise_count(a[0] & b[0]).sum(dtype=np.int64))
    for x, y in ((a, b), (b, a)):
        if 100 * x[2] < percent * y[1]:
            return True
        lone = max(int(np.bitwise_count(x[8] & ~y[0]).sum(dtype=np.int64)), x[9] - common)
        if 100 * x[2] - percent * y[1] < (100 + percent) * lone:
            return True
    return False


def tree_pairs(keys, comps, sizes, bits, percent: int = PERCENT, side=None):
    """Pairs of rows of different components that may reach the similarity, by dual traversal; with
    ``side`` (0 or 1 a row) only those of different sides."""
    order = np.lexsort((sizes, comps) if side is None else (sizes, comps, side))
    keys, comps, sizes, bits = keys[order], comps[order], sizes[order], bits[order]
    cut = 0 if side is None else int((side == 0).sum())
    if not len(keys) or side is not None and cut in (0, len(keys)):
        return
    root = _tree(cut, len(keys), comps, sizes, bits)
    todo = [(_tree(0, cut, comps, sizes, bits) if cut else root, root)]
    while todo:
        a, b = todo.pop()
        if a[3] == a[4] == b[3] == b[4]:
            continue  # one component
        if a is not b and apart(a, b, percent):
            continue
        if a[7] is None and b[7] is None:
            sa, sb = slice(a[5], a[6]), slice(b[5], b[6])
            na, nb = sizes[sa][:, None], sizes[sb][None, :]
            # A bit of one set that the other lacks stands for at least one shingle it lacks.
            lone_a = np.bitwise_count(bits[sa][:, None, :] & ~bits[sb][None, :, :]).sum(axis=2, dtype=np.int64)
            lone_b = np.bitwise_count(bits[sb][None, :, :] & ~bits[sa][:, None, :]).sum(axis=2, dtype=np.int64)
            most = np.minimum(na - lone_a, nb - lone_b)
            ok = (comps[sa][:, None] != comps[sb][None, :]) & (100 * most >= percent * (na + nb - most))
            if a is b:
                ok = np.triu(ok, 1)
            for i, j in zip(*np.nonzero(ok)):
                yield keys[a[5] + i], keys[b[5] + j]
        elif a is b:
            kids = a[7]
            todo += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids))]
        elif b[7] is None or a[7] is not None and a[6] - a[5] >= b[6] - b[5]:
            todo += [(k, b) for k in a[7]]
        else:
            todo += [(a, k) for k in b[7]]


def first_meeting(one: np.ndarray, other: np.ndarray, shingle: np.ndarray) -> np.ndarray:
    """Whether a pair of rows is to be given out in this bucket: ``shingle`` is the smallest that
    their ``LOW`` smallest shingles (0: none) have in common, or these have none in common."""
    same = ((one[:, :, None] == other[:, None, :]) & (one != 0)[:, :, None]).any(axis=2)
    at = same.argmax(axis=1)
    rows = np.arange(len(one))
    return ~same[rows, at] | (one[rows, at] == shingle)


def leaf_pairs(codes, keys, comps, sizes, bits, percent: int = PERCENT):
    """The same for rows of many buckets, sorted by bucket, none larger than a leaf: rows that stand
    ``d`` apart are compared at once for all buckets.  Yields arrays of keys."""
    for d in range(1, LEAF):
        if len(codes) <= d:
            return
        i = np.flatnonzero((codes[d:] == codes[:-d]) & (comps[d:] != comps[:-d]))
        if not len(i):
            if not (codes[d:] == codes[:-d]).any():
                return
            continue
        j = i + d
        i, j = (x[100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j])] for x in (i, j))
        lone_i = np.bitwise_count(bits[i] & ~bits[j]).sum(axis=1, dtype=np.int64)
        lone_j = np.bitwise_count(bits[j] & ~bits[i]).sum(axis=1, dtype=np.int64)
        most = np.minimum(sizes[i] - lone_i, sizes[j] - lone_j)
        ok = 100 * most >= percent * (sizes[i] + sizes[j] - most)
        yield keys[i[ok]], keys[j[ok]]


def split(rows: DataFrame, percent: int, cell: int = CELL, any_large: bool = True) -> DataFrame:
    """``rows`` with ``bucket`` and ``side``: a row of a small bucket once, one of a large bucket (by
    ``held``, its rows) once for each cell to compare its own with; two cells are two sides.

    Sizes of similar sets are at most one band apart.  Cells of one component are not compared."""
    carried = [c for c in ("key", "comp", "n", "bits", "low", "shingle") if c in rows.columns]
    once = rows.select(F.col("shingle").alias("bucket"), *carried, F.lit(0).alias("side"), "held")
    if not any_large:
        return once.drop("held")
    step = math.log(max(100 / percent, 1.01)) * 1.000001  # so that rounding never makes it two bands
    large = rows.where(F.col("held") > cell).withColumn("band", F.floor(F.log("n") / step))
    groups = large.groupBy("shingle", "band", "comp").agg(F.count("*").alias("c"))
    cells = (groups.withColumn("cls", F.when(F.col("c") > cell, F.col("comp")).otherwise(-1))
             .groupBy("shingle", "band", "cls").agg(F.ceil(F.sum("c") / cell).alias("m"))
             .groupBy("shingle").agg(F.collect_list(F.struct("band", "cls", "m")).alias("cells")))

    def of(cls):
        return F.get(F.filter("cells", lambda x: (x["band"] == F.col("band")) & (x["cls"] == cls)), F.lit(0))

    def places(x):
        return F.transform(F.sequence(F.lit(0).cast("long"), x["m"] - 1), lambda q: F.struct(
            x["band"].alias("band"), x["cls"].alias("cls"), q.alias("part")))

    placed = (large.join(cells, "shingle").withColumn("own", F.coalesce(of(F.col("comp")), of(F.lit(-1))))
              .withColumn("mine", F.struct(F.col("own.band").alias("band"), F.col("own.cls").alias("cls"),
                                           F.pmod(F.xxhash64("key"), F.col("own.m")).alias("part"))))
    others = F.filter("cells", lambda x: (F.abs(x["band"] - F.col("band")) <= 1)
                      & ((x["cls"] != F.col("own.cls")) | (x["cls"] < 0)))
    met = placed.select(*carried, "mine", F.explode(F.flatten(F.transform(others, places))).alias("other"))
    pairs = met.select(F.xxhash64("shingle", F.least("mine", "other"), F.greatest("mine", "other")).alias("bucket"),
                       *carried, (F.col("mine") > F.col("other")).cast("int").alias("side"))
    return once.where(F.col("held") <= cell).drop("held").unionByName(pairs)


def _bucket_pairs(rows: DataFrame, percent: int, cell: int = CELL, any_large: bool = True) -> DataFrame:
    """Signature trees over the buckets of sorted partitions; a small bucket is one leaf."""
    def run(parts):
        def unpack(part):
            bits = np.frombuffer(b"".join(part["bits"]), np.uint8).reshape(len(part), BITMAP_BYTES)
            low = np.frombuffer(b"".join(part["low"]), ">i8").reshape(len(part), LOW).astype(np.int64)
            return [part[c].to_numpy() for c in ("bucket", "key", "comp", "n")] + [bits, part["side"].to_numpy(), low, part["shingle"].to_numpy()]

        def search(codes, keys, comps, sizes, bits, sides, low, shingle):
            cuts = np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1, [len(codes)]])
            spots = np.arange(len(codes))  # the searches pair up rows; their keys come after
            small = np.repeat(np.diff(cuts) <= LEAF, np.diff(cuts))

            def frame(pairs):
                a, b = (np.concatenate([p[x] for p in pairs]) for x in (0, 1))
                first = np.concatenate([first_meeting(low[a[i:i + 4096]], low[b[i:i + 4096]], shingle[a[i:i + 4096]])
                                        for i in range(0, len(a), 4096)]) if len(a) else np.zeros(0, bool)
                a, b = keys[a[first]], keys[b[first]]
                return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

            pairs = list(leaf_pairs(*(x[small] for x in (codes, spots, comps, sizes, bits)), percent))
            chunk = []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi - lo > LEAF:
                    side = sides[lo:hi] if sides[lo:hi].any() else None
                    for pair in tree_pairs(spots[lo:hi], comps[lo:hi], sizes[lo:hi], bits[lo:hi], percent, side):
                        chunk.append(pair)
                        if len(chunk) == 50_000:
                            yield frame([np.array(chunk, np.int64).T])
                            chunk = []
            if chunk:
                pairs.append(np.array(chunk, np.int64).T)
            if pairs:
                yield frame(pairs)

        held = []  # pieces of the bucket that the next batch may go on with
        for part in parts:
            if not len(part):
                continue
            now = unpack(part)
            if held:
                more = int(np.searchsorted(now[0], held[0][0][0], "right"))
                held.append([x[:more] for x in now])
                if more == len(part):
                    continue
                yield from search(*map(np.concatenate, zip(*held)))
                now = [x[more:] for x in now]
            last = int(np.searchsorted(now[0], now[0][-1], "left"))
            if last:
                yield from search(*(x[:last] for x in now))
            held = [[x[last:] for x in now]]
        if held:
            yield from search(*map(np.concatenate, zip(*held)))

    if "low" not in rows.columns:
        rows = rows.join(_lowest(rows.select("shingle", "key")), "key")
    return split(rows, percent, cell, any_large).repartition("bucket").sortWithinPartitions("bucket").mapInPandas(run, "a long, b long").distinct()


def components(links: DataFrame, tag: str) -> DataFrame:
    """``(key, comp)`` for every key that has a link; ``comp`` is the component's smallest key.

    Large-star and small-star rounds over (key, smaller key) edges until nothing changes; each
    round is written to the shared folder."""
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), tag)
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        lows = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(lows, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        large = saved(large, tag)
        lows = large.groupBy("u").agg(F.min("v").alias("low"))
        moved = large.join(lows, "u")
        small = (moved.where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .union(lows.select("u", F.col("low").alias("v"))).distinct())
        edges = saved(small, tag)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("key"), F.col("v").alias("comp")).union(
        edges.select(F.col("v").alias("key"), F.col("v").alias("comp"))).distinct()


def _lowest(named: DataFrame) -> DataFrame:
    """``(key, low)``: the ``LOW`` smallest shingles of each key, packed in 8 bytes each, padded by 0."""
    def pack(x):
        return F.unhex(F.lpad(F.hex(x), 16, "0"))

    low = F.slice(F.array_sort(F.collect_set("shingle")), 1, LOW)
    filled = F.concat(low, F.array_repeat(F.lit(0).cast("long"), F.lit(LOW) - F.size(low)))
    return named.groupBy("key").agg(filled.alias("low")).select("key", F.concat(*[pack(F.get("low", F.lit(i))) for i in range(LOW)]).alias("low"))


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and bitmaps allow a link."""
    def setup():
        def fn(na, nb, one, other):
            na, nb = np.array(na, np.int64), np.array(nb, np.int64)
            x, y = (np.frombuffer(b"".join(z), np.uint8).reshape(len(z), BITMAP_BYTES) for z in (one, other))
            lone = [np.bitwise_count(p & ~q).sum(axis=1, dtype=np.int64) for p, q in ((x, y), (y, x))]
            most = np.minimum(na - lone[0], nb - lone[1])
            return [pa.array(100 * most >= percent * (na + nb - most))]
        return fn

    both = (pairs.join(nodes.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("bits").alias("x")), "a")
            .join(nodes.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("y")), "b")
            .where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)"))
    return map_rows(both, ["na", "nb", "x", "y"], fields("possible boolean"), setup).where("possible").select("a", "b")


def signature(codes: np.ndarray) -> bytes:
    """A bitmap that grows with the set: eight to sixteen bits a shingle, a power of two in all."""
    size = 8 << max(0, len(codes) - 1).bit_length()
    bits = np.zeros(max(size, 64), bool)
    bits[(codes.view(np.uint64) & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def most_common(one: bytes, other: bytes, na: int, nb: int) -> int:
    """How many shingles two sets share at most, by their signatures; the longer is folded."""
    x, y = (np.frombuffer(z, np.uint8) for z in (one, other))
    while len(x) != len(y):
        if len(x) > len(y):
            x = x[:len(x) // 2] | x[len(x) // 2:]
        else:
            y = y[:len(y) // 2] | y[len(y) // 2:]
    return min(na - int(np.bitwise_count(x & ~y).sum(dtype=np.int64)), nb - int(np.bitwise_count(y & ~x).sum(dtype=np.int64)))


def _sets(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """``(key, n, codes, sign)``: the shingles of every key of ``pairs`` and their signature, made once from
    one document that has the text."""
    keys = pairs.select(F.col("a").alias("key")).distinct().union(pairs.select(F.col("b").alias("key")).distinct()).distinct()
    needed = nodes.select("key", "sha", "rank").join(keys, "key")
    rows = docs.select("sha", F.coalesce("doc_id", F.lit(_LAST_ID)).alias("rank"), "text").join(needed, ["sha", "rank"])
    texts = rows.groupBy("sha", "rank").agg(F.first("key").alias("key"), F.first("text").alias("text"))  # as the join left them

    def setup():
        shingler = Shingler(size)

        def fn(texts):
            got = shingler(texts)
            return [[len(g) for g in got], [g.tobytes() for g in got], [signature(g) for g in got]]
        return fn

    return map_rows(texts.select("key", "text"), ["text"], fields("n long, codes binary, sign binary"), setup, slice_rows=SLICE).drop("text")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough.  The sets travel to those pairs only that their
    signatures, an eighth of the size, leave open."""
    def both(some: DataFrame, column: str) -> DataFrame:
        left = sets.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col(column).alias("x"))
        right = sets.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col(column).alias("y"))
        return some.join(left, "a").join(right, "b")

    def narrow():
        def fn(na, nb, one, other):
            most = [most_common(*z) for z in zip(one, other, na, nb)]
            return [[100 * m >= percent * (p + q - m) for m, p, q in zip(most, na, nb)]]
        return fn

    left_open = saved(map_rows(both(pairs, "sign"), ["na", "nb", "x", "y"], fields("possible boolean"), narrow)
                      .where("possible").select("a", "b"), "jaccard-open")

    def setup():
        def fn(one, other):
            out = []
            for x, y in zip(one, other):
                x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(100 * both >= percent * (len(x) + len(y) - both))
            return [out]
        return fn

    return map_rows(both(left_open, "codes"), ["x", "y"], fields("linked boolean"), setup,
                    slice_rows=64).where("linked").select("a", "b")


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, size: int = SHINGLE,
         percent: int = PERCENT) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id`` (the smallest id its links reach), ``sha`` of the
    text and ``comp``, the component's name (set even where ids are null)."""
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                     F.sha2(F.col(f"`{text_col}`").cast("binary"), 256).alias("sha"))
    all_sets = saved(sets_of(docs, size, percent), "jaccard-sets")
    # One node per distinct text; its key is fixed once the table is written.
    nodes = saved(all_sets.where("n > 0").groupBy("sha").agg(
        F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"),
        F.min(F.coalesce("doc_id", F.lit(_LAST_ID))).alias("rank"))
        .withColumn("key", F.monotonically_increasing_id()), "jaccard-nodes")
    rows_of = saved(all_sets.select("doc_id", "n", "sha"), "jaccard-rows")
    release(all_sets)
    buckets = nodes.select("key", F.explode("prefix").alias("shingle"))
    heads = buckets.groupBy("shingle").agg(F.min("key").alias("a"), F.max("key").alias("z")).where("a < z").select("shingle", "a")
    shared = saved(buckets.join(heads, "shingle"), "jaccard-buckets")
    prefixes, nodes = nodes, saved(nodes.drop("prefix"), "jaccard-nodes")
    release(prefixes)
    star = saved(_possible(shared.where("key > a").select("a", F.col("key").alias("b")).distinct(), nodes, percent), "jaccard-star")
    sets = saved(_sets(star, nodes, docs, size), "jaccard-codes")
    drop_shuffles(df.sparkSession)
    links = saved(_verified(star, sets, percent), "jaccard-links")
    release(star, sets)
    comps = saved(components(links, "jaccard-stars"), "jaccard-comps")
    named = shared.select("shingle", "key").join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    mixed = saved(named.groupBy("shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("held")).where("lo < hi").select("shingle", "held"), "jaccard-mixed")
    any_large = not mixed.where(F.col("held") > CELL).isEmpty()
    met = named.join(mixed, "shingle")
    rows = met.join(nodes.select("key", "n", "bits"), "key").join(_lowest(met.select("shingle", "key")), "key").select(
        "shingle", "key", "comp", "n", "bits", "held", "low")
    pairs = saved(_bucket_pairs(rows, percent, any_large=any_large), "jaccard-pairs")
    release(shared, mixed)
    sets = saved(_sets(pairs, nodes, docs, size), "jaccard-codes")
    drop_shuffles(df.sparkSession)
    more = saved(_verified(pairs, sets, percent), "jaccard-more")
    release(sets, pairs)
    final = saved(components(links.union(more), "jaccard-all"), "jaccard-final")
    placed = (rows_of.select("doc_id", "n", "sha", F.coalesce("doc_id", F.lit(_LAST_ID)).alias("rank"))
              .join(nodes.select("sha", "key"), "sha", "left").join(final, "key", "left")
              .withColumn("comp", F.coalesce("comp", "key")))
    placed = saved(placed, "jaccard-placed")
    release(rows_of, nodes, links, comps, more, final)
    first = placed.where("n > 0").groupBy("comp").agg(F.min("rank").alias("first"))
    return placed.join(first, "comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") == 0) | (F.col("first") == _LAST_ID), F.col("doc_id")).otherwise(F.col("first")).alias("component_id"),
        "sha", "comp")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the smallest id of each component, once; rows with empty sets all stay."""
    found = saved(join(df, id_col, text_col), "jaccard-join")
    best = (found.where("n_shingles > 0").groupBy("comp")
            .agg(F.min(F.struct(F.coalesce("doc_id", F.lit(_LAST_ID)).alias("__rank"), F.col("sha").alias("__sha"))).alias("b"))
            .select("b.*"))
    empty = found.where("n_shingles = 0").select("sha").distinct().select(F.coalesce("sha", F.lit("")).alias("__sha"))
    marked = df.withColumn("__rank", F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LAST_ID))).withColumn(
        "__sha", F.coalesce(F.sha2(F.col(f"`{text_col}`").cast("binary"), 256), F.lit("")))
    one = marked.join(best, ["__rank", "__sha"], "left_semi").dropDuplicates(["__rank", "__sha"])
    return one.select(df.columns).unionByName(marked.join(empty, "__sha", "left_semi").select(df.columns))


def op7_jaccard(spark, sf_dir: str) -> DataFrame:
    return join(load(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def brute_force(rows, size: int = SHINGLE, percent: int = PERCENT):
    """``(doc_id, n_shingles, component_id)`` by comparing all pairs; for tests."""
    def runs(text):
        w = words_of(ascii_lower(text or ""))
        return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()

    got = [(i, runs(t)) for i, t in rows]
    root = list(range(len(got)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(got)):
        for y in range(x):
            a, b = got[x][1], got[y][1]
            both = len(a & b) if a and b else 0
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                root[find(x)] = find(y)
    low: dict[int, int] = {}
    for x, (i, _) in enumerate(got):
        low[find(x)] = min(low.get(find(x), i), i)
    return [(i, len(s), low[find(x)]) for x, (i, s) in enumerate(got)]
