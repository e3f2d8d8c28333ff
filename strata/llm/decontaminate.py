"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact verification.

An item's shingles are its runs of five lower-cased words (a shorter item is one shingle).  A
window is as many consecutive words of a document as an item has.  Every window is laid that can
reach the similarity: one in which so many places hold a shingle of an item of this size as the
similarity takes, in whatever order they stand.  A
document shorter than the item is one window, its whole text.  Every window gets a 64-bit SimHash of its shingles.  The fingerprints are cut into ``RADIUS + 1``
blocks, so a window and an item whose fingerprints differ in at most ``RADIUS``
bits agree in at least one block and meet there.  Fingerprints of a pair at the least similarity may
differ in more bits, so a window and an item also meet by a shingle among the first of each in the
order of the hashes, as many as no similar pair can do without: no pair is lost.  A met pair is
verified exactly: the sum of the smaller over the sum of the larger shingle counts must reach
``similarity``.

Only DataFrame functions are used.  Null or empty texts have no windows; an item shorter than
five words matches its exact sequence; repeated rows are judged alike; ties go to the smaller
item id; empty tables give no matches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower_column, load, saved, words_column

SHINGLE, SIMILARITY = 5, 0.75
RADIUS = 7
BITS = 64


def _shingles(words: str, size: int) -> Column:
    """Hashes of the runs of ``size`` words; empty when there are fewer."""
    def runs(w: Column) -> Column:
        count = F.size(w) - size + 1
        hashes = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(
            *[F.get(w, i + k) for k in range(size)]))
        return F.when(count >= 1, hashes).otherwise(F.array().cast("array<bigint>"))

    # The words are bound once as a lambda's variable, or each run would split the text anew.
    return F.get(F.transform(F.array(F.col(words)), runs), F.lit(0))


def _simhash(shingles: str) -> tuple[list[Column], Column]:
    """The sums, and the bits from them: a bit is set when more than half of the shingles have it.

    Sixteen sums count four bits each, in lanes of 16 bits (items have fewer than 65,536 words)."""
    lanes = F.lit(0x0001000100010001)

    def lane_sum(r: int) -> Column:
        return F.aggregate(shingles, F.lit(0).cast("long"),
                           lambda a, h: a + F.shiftrightunsigned(h, r).bitwiseAND(lanes))

    def bit(b: int) -> Column:
        lane, r = divmod(b, 16)
        ones = F.shiftrightunsigned(F.get("__sums", F.lit(r)), 16 * lane).bitwiseAND(F.lit(0xFFFF))
        return F.when(2 * ones > F.size(shingles), F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("long")

    return [lane_sum(r) for r in range(BITS // 4)], reduce(lambda x, y: x.bitwiseOR(y), [bit(b) for b in range(BITS)])


def _with_print(df: DataFrame) -> DataFrame:
    """``df`` with ``print``, the SimHash of its ``shingles``."""
    sums, bits = _simhash("shingles")
    return df.withColumn("__sums", F.array(*sums)).withColumn("print", bits).drop("__sums")


def _blocks(fingerprint: str, radius: int) -> Column:
    """``(block number, its bits)`` for each of ``radius + 1`` blocks."""
    cuts = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fingerprint, lo)
                              .bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("bits"))
                     for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))])


def _needed(item_size: Column, window_size: Column, similarity: float) -> Column:
    """How many shingles an item and a window of these numbers of shingles have in common, at least,
    if they are similar enough."""
    return F.greatest(F.lit(1), F.ceil(F.lit(similarity) * (item_size + window_size) / F.lit(1 + similarity) - 1e-9)).cast("int")


def _starts(k: int) -> Column:
    """Where the windows of ``n`` words start that hold ``need`` of the places ``ats`` (sorted) or
    more, in a document of ``total`` words; 0 in a shorter document."""
    size = F.col("n") - (k - 1)

    def around(i: Column) -> Column:
        low, high = F.get("ats", i), F.get("ats", i + F.col("need") - 1)
        return F.when(high - low < size, F.sequence(F.greatest(F.lit(0), high - size + 1), F.least(low, F.col("total") - F.col("n"))))

    tight = F.filter(F.transform(F.sequence(F.lit(0), F.size("ats") - F.col("need")), around), lambda s: s.isNotNull())
    return F.when(F.col("total") < F.col("n"), F.array(F.lit(0))).otherwise(F.array_distinct(F.flatten(tight)))


def _keys(radius: int, similarity: float, fingerprint: str, shingles: str) -> Column:
    """``_blocks``, and as block -1 the shingles one of which two similar multisets share (the prefix filter)."""
    first = F.size(shingles) - F.ceil(F.lit(similarity) * F.size(shingles) - 1e-9) + 1
    prefix = F.array_distinct(F.slice(F.array_sort(shingles), F.lit(1), first.cast("int")))
    return F.concat(_blocks(fingerprint, radius), F.transform(prefix, lambda h: F.struct(F.lit(-1).alias("block"), h.alias("bits"))))


def matches(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY,
            radius: int = RADIUS) -> DataFrame:
    """``doc_id, item_id, start, n_words, similarity``: verified windows, the best of each pair of
    document and item (its first on a tie).  A window's ``n`` is the size of the items it is for."""
    item = (items.select(F.col(f"`{item_col}`").alias("item_id"),
                         words_column(ascii_lower_column(F.col(f"`{item_text_col}`"))).alias("words"))
            .where(F.size("words") > 0).withColumn("n", F.size("words"))
            .withColumn("k", F.least(F.col("n"), F.lit(SHINGLE))))
    sized = [item.where(F.col("k") == k).withColumn("shingles", _shingles("words", k)) for k in range(1, SHINGLE + 1)]
    item = saved(reduce(DataFrame.unionByName, sized).drop("words"), "bench-shingles")
    item = saved(_with_print(item), "bench-items")
    anchors = item.select("n", "k", F.explode("shingles").alias("shingle")).distinct()
    sizes = [r["k"] for r in item.select("k").distinct().collect()]  # at most five numbers

    doc = docs.select(F.struct(F.col(f"`{id_col}`").alias("doc_id")).alias("__id"), F.col(f"`{text_col}`").alias("text"),
                      F.xxhash64(F.col(f"`{text_col}`")).alias("text_key"))

    def split(df: DataFrame, k: int) -> DataFrame:
        lowered = df.withColumn("words", words_column(ascii_lower_column(F.col("text"))))
        return lowered.withColumn("shingles", _shingles("words", k))

    found = []
    for k in sizes or [SHINGLE]:
        spots = (split(doc, k).select("__id", "text_key", F.size("words").alias("total"),
                                      F.posexplode("shingles").alias("at", "shingle"))
                 .join(anchors.where(F.col("k") == k), "shingle")
                 # With fewer shingles than this share of the item's a text cannot reach the similarity.
                 .where(F.col("total") - (k - 1) >= F.lit(similarity) * (F.col("n") - (k - 1))))
        places = (spots.groupBy("__id", "text_key", "n").agg(F.array_sort(F.collect_set("at")).alias("ats"), F.max("total").alias("total"))
                  .withColumn("n_words", F.least("n", "total")))
        windows = (places.withColumn("need", _needed(F.col("n") - (k - 1), F.col("n_words") - (k - 1), similarity))
                   .where(F.size("ats") >= F.col("need")).withColumn("starts", _starts(k)).where(F.size("starts") > 0)
                   .groupBy("__id", "text_key").agg(F.flatten(F.collect_list(F.transform("starts", lambda s: F.struct(
                       s.alias("start"), F.col("n").alias("n"), F.col("n_words").alias("n_words"))))).alias("windows")))
        cut = (split(doc.join(windows, ["__id", "text_key"]), k)
               .select(F.col("__id.doc_id").alias("doc_id"), "shingles", F.explode("windows").alias("w"))
               .select("doc_id", F.col("w.start").alias("start"), F.col("w.n").alias("n"), F.col("w.n_words").alias("n_words"),
                       F.slice("shingles", F.col("w.start") + 1, F.col("w.n_words") - (k - 1)).alias("shingles")))
        found.append(cut)
    windows = saved(reduce(DataFrame.unionByName, found), "bench-cut")
    windows = saved(_with_print(windows), "bench-windows")

    right = item.select("item_id", "n", F.col("shingles").alias("item_shingles"),
                        F.col("print").alias("item_print"), F.inline(_keys(radius, similarity, "print", "shingles")))
    pairs = (windows.select("doc_id", "start", "n", "n_words", "shingles", "print", F.inline(_keys(radius, similarity, "print", "shingles")))
             .join(right, ["n", "block", "bits"])
             .where((F.col("block") < 0) | (F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius))
             .dropDuplicates(["doc_id", "start", "n", "n_words", "item_id", "print"]))
    common = F.array_intersect("shingles", "item_shingles")
    counted = F.aggregate(common, F.lit(0), lambda a, h: a + F.least(
        F.size(F.filter("shingles", lambda x: x == h)), F.size(F.filter("item_shingles", lambda x: x == h))))
    once = F.size(F.array_distinct("shingles")) == F.size("shingles")  # then no shingle counts twice
    both = F.when(once, F.size(common)).otherwise(counted)
    scored = (pairs.withColumn("both", both)
              .withColumn("either", F.size("shingles") + F.size("item_shingles") - F.col("both"))
              .where(F.col("both") >= F.lit(similarity) * F.col("either"))
              .withColumn("similarity", F.col("both") / F.col("either")))
    best = F.max_by(F.struct("start", "n_words", "similarity"), F.struct("similarity", -F.col("start"), "n_words"))
    return scored.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", F.col("best.start").cast("long").alias("start"),
        F.col("best.n_words").cast("long").alias("n_words"), F.col("best.similarity").alias("similarity"))


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    return matches(load(spark, sf_dir, "documents", "doc_id", "text"), load(spark, sf_dir, "benchmark", "item_id", "text"))
