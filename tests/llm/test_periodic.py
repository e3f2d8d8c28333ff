"""Lyndon arrays, runs and collapsed texts against brute force."""

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import periodic
from strata.llm.common import load

SF = "/root/testdata/sf0.001"


def lyndon_brute_force(w):
    def is_lyndon(s):
        return all(s < s[k:] for k in range(1, len(s)))

    return [max(j - i for j in range(i + 1, len(w) + 1) if is_lyndon(w[i:j])) for i in range(len(w))]


def runs_brute_force(w, exponent, length):
    found = []
    for p in range(1, len(w) // exponent + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            s = w[i:j + p]
            if j > i and len(s) >= max(length, exponent * p) and not any(s[q:] == s[:-q] for q in range(1, p)):
                found.append((i, len(s), p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def dense(w):
    names = {x: i for i, x in enumerate(sorted(set(w)))}
    return [names[x] for x in w]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=18))
def test_lyndon_lengths(w):
    w = dense(w)
    assert periodic.lyndon_lengths(w) == lyndon_brute_force(w)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 7)), max_size=8))
def test_runs(parts):
    w = [x for unit, times in parts for x in unit * times]
    for exponent, length in ((4, 6), (2, 2), (3, 1)):
        assert periodic.runs(np.array(w, dtype=np.int64), exponent, length) == runs_brute_force(w, exponent, length)


def test_long_periodic_texts_take_no_square_time():
    r = random.Random(2)
    noise = [r.randrange(5000) for _ in range(3000)]
    for unit, times in (([0], 200_000), ([0, 1], 100_000), (list(range(1000)), 200)):
        w = np.array(noise + unit * times + noise)
        found = periodic.runs(w)
        assert any(p == len(unit) and n >= len(unit) * times for _, n, p in found)


def digest_brute_force(doc_id, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(w), crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = runs_brute_force(w, 4, 6)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None,) * 3
    gone = {i for s, size, p in found for i in range(s + p, s + size)}
    lines = "".join(f"{s},{size},{p}\n" for s, size, p in found)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_query_equals_brute_force(spark):
    got = periodic.op13_periodic_runs(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    docs = load(spark, SF, "documents").collect()
    short = {r["doc_id"]: r["text"] for r in docs if len((r["text"] or "").split()) < 2500}
    want = sorted(digest_brute_force(i, t) for i, t in short.items())
    rows = sorted(tuple(r) for r in got.collect())
    assert len(rows) == len(docs) and sum(r[1] for r in rows) > 0
    assert [r for r in rows if r[0] in short] == want


def test_edge_rows_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "a a a a a a"), (4, "a a a a a a"), (None, "x " + "b c " * 4),
            (5, "a a a a a"), (6, "é\x0bé\x0cé\x1cé é é é é é"), (7, "u v " * 5000)]
    docs = spark.createDataFrame([(i, t, "clash", 9, None) for i, t in rows],
                                 "doc_id long, text string, runs string, n_words long, collapsed string")
    got = periodic.collapse(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "strongest", "collapsed"]
    seen = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect()), key=str)
    assert seen == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 6, [(0, 6, 1)], "a"), (4, 6, [(0, 6, 1)], "a"),
        (None, 9, [(1, 8, 2)], "x b c"), (5, 5, [], "a a a a a"), (6, 8, [], "é é é\x1cé é é é é é"),
        (7, 10_000, [(0, 10_000, 2)], "u v")], key=str)
    assert periodic.collapse(docs.limit(0)).collect() == []
    assert periodic.repeat_tails(docs).where("doc_id is null").first()["text"] == "x " + "b c " * 4


def test_ties_go_to_the_first_run():
    assert periodic.strongest([(0, 6, 1), (9, 12, 2), (30, 6, 1)]) == (0, 6, 1)
    assert periodic.strongest([(0, 8, 2), (9, 9, 2), (20, 18, 4)]) == (9, 9, 2)
    assert periodic.strongest([]) is None
    with pytest.raises(ValueError):
        periodic.collapse(None, exponent=1)
