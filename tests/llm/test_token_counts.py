"""Token counts against the library itself."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from strata.llm import token_counts
from strata.llm.common import load

SF = "/root/testdata/sf0.001"
# Column names that clash with those the operator makes.
DDL = "doc_id long, text string, n_tokens string, n_bytes string, over_limit string, token string, n string"


@pytest.fixture(scope="module")
def library():
    return token_counts.encoded_lengths(token_counts.TOKENIZER_PATH)


def odd_texts():
    """Texts of white space of all kinds, special strings, contractions and code points that the two
    libraries' character tables class differently."""
    r = random.Random(3)
    every = "".join(chr(p) for p in range(0x110000) if not 0xD800 <= p < 0xE000)
    odd = token_counts.cutter().odd
    strange = r.sample(regex.findall(odd, every), 40) if odd else []
    parts = ["a", "B", "1", "!", "'", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "é", "中", "٣", "'s", "'LL", "'ll", "😀",
             "<|endoftext|>", "<|", "|>"] + strange
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(3000)]
    return texts + ["", " ", "<|endoftext|>" * 3, "x" * 5000, "ab " * 4000, "!?" * 3000]


def test_counts_equal_the_library(spark, library):
    texts = odd_texts()
    rows = [(i, t, "x", "x", "x", "x", "x") for i, t in enumerate(texts)] + [(None, None, *"xxxxx"), (0, texts[0], *"xxxxx")]
    got = token_counts.count(spark.createDataFrame(rows, DDL))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len((t or "").encode()), n, n > 512) for (i, t, *_), n in zip(rows, library([r[1] or "" for r in rows]))]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_counts_of_all_documents(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in load(spark, SF, "documents").collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.op12_token_counts(spark, SF).collect()}
    assert got == dict(zip(texts, library(list(texts.values()))))


@pytest.mark.parametrize("table", [[], ["never there"], [" the", ".", ","]])
def test_table_never_changes_a_count(spark, table):
    docs = load(spark, SF, "documents")
    one, two = token_counts.count(docs, table=table), token_counts.count(docs)
    assert one.exceptAll(two).isEmpty() and one.count() == two.count()


def test_small_cache_and_long_texts(library, monkeypatch):
    monkeypatch.setattr(token_counts, "LONG", 16)
    monkeypatch.setattr(token_counts, "PORTION", 3)
    texts = odd_texts()
    lookup = token_counts.Lookup({"a": 1}, library, cache_bytes=3000)
    cut = token_counts.cutter().build()
    assert [sum(lookup.total(t) for t in cut(text)) for text in texts] == library(texts)
    assert lookup.held <= 3000 or len(lookup.known) < 100


def test_frequent_is_bounded_and_sees_all_documents(spark):
    docs = spark.createDataFrame([(i, "common rare%d" % i) for i in range(5000)], "doc_id long, text string")
    got = token_counts.frequent(docs.repartition(4), size=3, summary=20)
    assert len(got) == 3 and " common" in got


def test_empty_table_and_other_kinds(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count(docs).collect() == []
    with pytest.raises(ValueError):
        token_counts.cutter("/opt/tokenizers/word_bpe_49k.json")
    none = spark.createDataFrame([(1, None)], "doc_id long, text string").withColumn("text", F.lit(None).cast("string"))
    assert [tuple(r) for r in token_counts.count(none).collect()] == [(1, 0, 0, False)]
