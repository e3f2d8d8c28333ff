"""Repaired conversations against a plain dynamic program over each whole conversation."""

import hashlib
import random
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from strata.llm import conversation_repair as cr
from strata.llm.common import load

SF = "/root/testdata/sf0.001"
DDL = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute_force(rows):
    """The report of one conversation's rows, already in order."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = text.strip(BLANKS)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    # Cheapest (cost, audit, repaired rows) from each row on, for each last initial.
    after = {"": (0, "", ()), "s": None, "u": None, "a": (0, "", ())}

    def inserted(best):
        for _ in range(4):
            for q, role in (("", "user"), ("s", "user"), ("a", "user"), ("u", "assistant")):
                nxt = best[role[0]]
                if nxt is not None:
                    new = (5 + nxt[0], "I" + nxt[1], ((role, ""), *nxt[2]))
                    if best[q] is None or new[:2] < best[q][:2]:
                        best[q] = new
        return best

    after = inserted(after)
    for (_, _, role, text), fault in zip(reversed(rows), reversed(faults)):
        now = {}
        for q in ("", "s", "u", "a"):
            options = [(2 + after[q][0], "D" + after[q][1], after[q][2])]
            if fault not in ("blank", "duplicate"):
                late = 5 if fault == "truncated" else 0
                may = {"": "su", "s": "u", "u": "a", "a": "u"}[q]
                if role[:1] and role[:1] in may:
                    nxt = after[role[:1]]
                    options.append((late + nxt[0], "K" + nxt[1], ((role, text), *nxt[2])))
                for other in ("user", "assistant"):
                    if other[0] in may:
                        nxt = after[other[0]]
                        options.append((1 + late + nxt[0], "R" + nxt[1], ((other, text), *nxt[2])))
            now[q] = min(options, key=lambda o: o[:2])
        after = inserted(now)
    cost, audit, kept = after[""]
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def wanted(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    key = lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])
    return {c: brute_force(sorted(g, key=key)) for c, g in groups.items()}


def got(df):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def random_rows(seed, conversations, most, roles=("user", "assistant", "system", "tool", "", "Usr", "u2")):
    """Conversations of unlike kinds; turns are unique but for nulls, whose rows differ early on."""
    r = random.Random(seed)
    rows = []
    for c in range(conversations):
        n, sloppy = r.randrange(1, most), r.random()
        for t in sorted(r.sample(range(2 * n + 2), n)):
            role = r.choice(roles) if r.random() < sloppy else ("user", "assistant")[t % 2]
            text = r.choice(["", " \t", "same.", "half", "same."]) if r.random() < sloppy else f"{t} all of it{r.choice('.!? x')} "
            rows.append((c, t, role, text))
    return rows


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in load(spark, SF, "conversations", "conv_id", "turn", "role", "text").collect()]
    want = wanted(damaged(rows))
    result = cr.op11_conversation_repair(spark, SF)
    assert result.columns == ["conv_id", *COLUMNS]
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got(result) == {c: want.get(c, none) for c in {r[0] for r in rows}}


@pytest.mark.parametrize("chunk,fan", [(3, 2), (1, 8), (50, 8)])
def test_chunks_of_all_sizes_equal_the_whole(spark, chunk, fan):
    rows = random_rows(chunk, 40, 30)
    df = spark.createDataFrame(rows, DDL).repartition(5)
    assert got(cr.report(cr.repair(df, chunk_rows=chunk, fan=fan))) == wanted(rows)


def test_one_conversation_over_many_tasks(spark):
    r = random.Random(9)
    rows = [(7, t, ("user", "assistant", "system")[r.randrange(3)], f"{r.randrange(400)}{r.choice(['.', ''])}") for t in range(2000)]
    rows += [(c, t, "user", "x.") for c in (3, 11) for t in range(3)]
    rows += [(8, t, "assistant", "again") for t in range(1000)]  # vectors pass it unchanged
    df = spark.createDataFrame(rows, DDL).repartition(6)
    assert got(cr.report(cr.repair(df, chunk_rows=16, fan=4))) == wanted(rows)


def test_vectors_meet_or_are_run_to_the_end():
    steps, r = cr.Steps(), random.Random(1)
    for _ in range(300):
        codes = bytes(r.randrange(16) for _ in range(r.randrange(30)))
        old, new = (0, 10, 5, 0), tuple(r.choice([(0, 5, 5, 0), (3, 0, 1, 5), (0, 0, 0, 0)]))
        out, met = cr.rerun(steps, codes, old, new)
        assert cr.backward(steps, codes, new)[0] == (cr.backward(steps, codes, old)[0] if met else out)


def test_nulls_repeats_clashes_and_empty_tables(spark):
    rows = [(None, None, None, None), (None, 2, "user", "q?"), (1, None, "user", "a."), (1, None, "user", "b."), (1, 4, "assistant", "c."),
            (2, 1, "user", "q?"), (2, 1, "user", "q?"), (2, 1, "user", "q?"), (2, 9, "assistant", "x" * 100_000), (3, 5, "system", None),
            (4, None, "assistant", "é\x1c"), (5, 1, "user", "é。"), (5, 2, "assistant", "ok.\x85")]
    df = spark.createDataFrame(rows, DDL)
    clash = df.select("*", F.lit(1).alias("codes"), F.lit("x").alias("chunk"), F.lit("y").alias("audit"))
    filled = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got(cr.report(cr.repair(clash))) == wanted(filled)
    assert cr.report(cr.repair(df.limit(0))).collect() == []
    left = cr.repaired_rows(cr.repair(clash)).where("conv_id = 1").orderBy("chunk", "at").collect()
    assert [(r["role"], r["text"]) for r in left] == [("user", "b."), ("assistant", "c.")]


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(4)] + [(None, None, None, None)]
    out = [tuple(r) for r in cr.damage(spark.createDataFrame(rows, DDL)).collect()]
    assert sorted(out, key=str) == sorted(damaged(rows), key=str)
