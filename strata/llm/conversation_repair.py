"""Cheapest repair of conversations by rank-convergence parallel Viterbi.

The rows of a conversation are read by turn (null turns first; rows of one turn by role, then by
the text's first characters and hash, so equal rows are neighbours).  A row's first fault counts:
blank, duplicate (role and text seen earlier), truncated (the last character is no end of sentence).
Edits make the roles' initials read ``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 1,
Delete 2 (the only edit of blank and duplicate rows), Insert an empty user or assistant row 5; a
truncated row that stays adds 5.  Of the cheapest edit sequences the ASCII-least is taken.

Four states say what may follow (nothing yet; after a system, user, assistant row), so the cost from
a row to the end is a vector of four numbers, found backwards.  Rows are laid out by range over
(conversation, turn, ...), so a conversation of any length is spread over as many tasks as its share
of the rows asks for, and is cut into chunks of ``CHUNK`` rows or ``CHUNK_CHARS`` characters:

1. A conversation that lies in one chunk inside one task is repaired there and then.
2. Of the others each task hands over its chunks: one byte of role and fault a row, the texts aside.
   Duplicates between tasks are found by joining 16-byte digests, one row for each text and task.
3. All chunks run backwards at once from a speculative cost vector, that of the end.  Fix-up passes
   rerun a chunk from its successor's vector, side by side with the vectors of its last run, until
   the two differ only by a constant: from there on the earlier result holds.  Passes go on until
   no chunk's end differs from its successor's start.  Pass ``i`` walks ``FAN ** i`` neighbouring
   chunks in a row, so vectors that do not converge (a long stretch of deletions) need a number of
   passes in the logarithm of the chunks, not their number.
4. The stitched costs drive the trace, forwards: in each state the ASCII-least edit that keeps the
   cheapest cost.  Its entry states are speculative too, with fix-ups of the same kind.

A task holds a chunk, never a conversation, but for what one output row must hold: the audit (a
character an edit) and, as a running value, the digest of the repaired conversation.

Null roles and texts read as one blank; null conversation ids are one conversation; null turns count
neither for gaps nor as turns; very long texts stay whole; an empty table gives an empty result.  Only
the four columns are read, so further columns of any name have no effect.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm.common import fields, load, saved

CHUNK = 4096             # rows in a chunk, at most
CHUNK_CHARS = 1 << 20    # characters of text in a chunk, beyond which it ends
FAN = 8                  # growth, from pass to pass, of the neighbouring chunks one walk takes
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()

# Row codes: the class of the role plus four times the fault.
OTHER, SYSTEM, USER, ASSISTANT = range(4)
CLASSES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

# States, by what came last: nothing, a system, user or assistant row.
STATES = range(4)
FOLLOWS = {SYSTEM: (0,), USER: (0, 1, 3), ASSISTANT: (2,)}  # states in which a class may come next
NEEDED = (USER, USER, ASSISTANT, USER)                      # what an inserted or reroled row must be, by state
AT_END = (0, 10, 5, 0)
FINISH = ("", "II", "I", "")
LEGAL_PAIRS = ("su", "ua", "au")


class Steps:
    """One row's effect on a normalised cost vector, remembered for each vector and code."""

    def __init__(self):
        self.known: dict[tuple, tuple] = {}

    def back(self, after: tuple, code: int) -> tuple:
        """``(vector before the row, constant taken off, edits by state, next states, costs)``."""
        got = self.known.get((after, code))
        if got is None:
            got = self.known[after, code] = self._back(after, code)
        return got

    @staticmethod
    def _back(after: tuple, code: int) -> tuple:
        role, fault = code & 3, code >> 2
        late = 5 if fault == TRUNCATED else 0
        options = []  # by state, the edits that use the row up: (cost to the end, letter, next state, own cost)
        for q in STATES:
            use = [(2 + after[q], "D", q, 2)]
            if fault not in (BLANK, DUPLICATE):
                if q in FOLLOWS.get(role, ()):
                    use.append((late + after[role], "K", role, late))
                use.append((1 + late + after[NEEDED[q]], "R", NEEDED[q], 1 + late))
            options.append(use)
        before = [min(use)[0] for use in options]
        for _ in STATES:  # an inserted row first
            before = [min(before[q], 5 + before[NEEDED[q]]) for q in STATES]
        edits, ends, costs = [], [], []
        for q in STATES:
            text, cost, at = "", 0, q
            while True:
                best = [o for o in options[at] if o[0] == before[at]]
                letters = [o[1] for o in best] + (["I"] if 5 + before[NEEDED[at]] == before[at] else [])
                letter = min(letters)
                text += letter
                if letter != "I":
                    _, _, end, own = next(o for o in best if o[1] == letter)
                    break
                cost, at = cost + 5, NEEDED[at]
            edits.append(text)
            ends.append(end)
            costs.append(cost + own)
        least = min(before)
        return tuple(x - least for x in before), least, tuple(edits), tuple(ends), tuple(costs)


def backward(steps: Steps, codes: bytes, after: tuple) -> tuple[tuple, int]:
    """The vector before the first row, normalised, and the constant taken off on the way."""
    taken = 0
    for code in reversed(codes):
        after, least, *_ = steps.back(after, code)
        taken += least
    return after, taken


def rerun(steps: Steps, codes: bytes, old: tuple, new: tuple) -> tuple[tuple, bool]:
    """The vector before the first row when the chunk ends with ``new`` instead of ``old``, and
    whether the two runs met (their vectors differ by a constant only), from where on the earlier
    result holds and nothing is run again."""
    for code in reversed(codes):
        if old == new:
            return new, True
        old, new = steps.back(old, code)[0], steps.back(new, code)[0]
    return new, old == new


def trace(steps: Steps, codes: bytes, after: tuple, state: int, last: bool) -> tuple[list[str], int, int]:
    """The edits of each row from ``state`` on (those after the last row as one more item, where
    the conversation ends), the state behind them and their cost."""
    path = []
    for code in reversed(codes):
        step = steps.back(after, code)
        path.append(step)
        after = step[0]
    edits, cost = [], 0
    for _, _, texts, ends, costs in reversed(path):
        edits.append(texts[state])
        cost += costs[state]
        state = ends[state]
    if last:
        edits.append(FINISH[state])
        cost += AT_END[state]
    return edits, state, cost


def repaired(edits: list[str], codes: bytes, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts of the rows that the edits leave, from ``state`` on."""
    new_roles, new_texts = [], []
    for at, some in enumerate(edits):
        for letter in some:
            if letter == "D":
                continue
            if letter == "K":
                state = codes[at] & 3
                new_roles.append(roles[at])
            else:
                state = NEEDED[state]
                new_roles.append("user" if state == USER else "assistant")
            new_texts.append("" if letter == "I" else texts[at])
    return new_roles, new_texts


@dataclass
class _Chunk:
    """Rows of one conversation as a task gathers them."""
    roles: list = field(default_factory=list)
    texts: list = field(default_factory=list)
    turns: list = field(default_factory=list)
    codes: bytearray = field(default_factory=bytearray)
    marks: bytearray = field(default_factory=bytearray)
    chars: int = 0

    def add(self, turn, role: str, text: str, seen: set) -> None:
        body = text.rstrip(BLANKS)
        mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if not body:
            fault = BLANK
        elif mark in seen:
            fault = DUPLICATE
        else:
            fault = SOUND if body[-1] in ENDS else TRUNCATED
        seen.add(mark)
        self.codes.append(CLASSES.get(role[:1], OTHER) + 4 * fault)
        self.marks += mark
        self.roles.append(role)
        self.texts.append(text)
        self.turns.append(turn)
        self.chars += len(text)

    def facts(self) -> dict:
        """What the report needs of the rows as they came."""
        turns = [t for t in self.turns if t is not None]
        first = [r[:1] for r in self.roles]
        return {"turn_first": self.turns[0], "turn_last": self.turns[-1], "turn_low": turns[0] if turns else None,
                "turn_high": turns[-1] if turns else None, "n_turns": len(set(turns)),
                "illegal": sum(a + b not in LEGAL_PAIRS for a, b in zip(first, first[1:])),
                "role_first": first[0], "role_last": first[-1]}


# A chunk of a conversation.  ``edits`` is null until it is repaired; roles and texts are then the
# repaired ones.  ``chunk`` numbers the chunks of all conversations in their order.
_CHUNK = ("chunk long, done boolean, codes binary, marks binary, roles strings, texts strings, edits string, "
          "cost long, turn_first long, turn_last long, turn_low long, turn_high long, n_turns long, illegal long, "
          "role_first string, role_last string")


def _chunk_schema(conv: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("conv_id", conv), *fields(_CHUNK).fields])


def _emitter(schema: T.StructType) -> Callable[[list[dict]], pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in arrow], schema=arrow)

    return batch


def _chunks(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Chunks of all conversations; those that lie whole in one chunk within a task are repaired."""
    schema = _chunk_schema(rows.schema["conv_id"].dataType)
    keys = ["conv_id", "turn", "role", "__head", "__hash", "__salt"]
    laid = (rows.withColumn("__head", F.substring("text", 1, 16)).withColumn("__hash", F.xxhash64("text"))
            .withColumn("__salt", F.monotonically_increasing_id() % 4096)
            .repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys])
            .sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys])
            .select("conv_id", "turn", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit, steps = _emitter(schema), Steps()
        number = TaskContext.get().partitionId() << 32
        ready: list[dict] = []
        size = 0

        def row(chunk: _Chunk, whole: bool) -> dict:
            nonlocal number, size
            out = {"conv_id": conv, "chunk": number, "done": whole, "codes": bytes(chunk.codes), "roles": chunk.roles,
                   "texts": chunk.texts, **chunk.facts()}
            if whole:
                edits, _, cost = trace(steps, out["codes"], AT_END, 0, True)
                out["roles"], out["texts"] = repaired(edits, out["codes"], 0, chunk.roles, chunk.texts)
                out["edits"], out["cost"] = "".join(edits), cost
            else:
                out["marks"] = bytes(chunk.marks)
            number += 1
            size += len(chunk.codes) + chunk.chars // 64
            return out

        conv, chunk, seen = None, None, set()
        first, cut = True, False  # still the task's first conversation; this one already has a chunk
        for batch in batches:
            for c, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if chunk is None or c != conv:
                    if chunk is not None:
                        ready.append(row(chunk, not first and not cut))
                        first = False
                    conv, chunk, seen, cut = c, _Chunk(), set(), False
                elif len(chunk.codes) >= chunk_rows or chunk.chars >= CHUNK_CHARS:
                    ready.append(row(chunk, False))
                    chunk, cut = _Chunk(), True
                chunk.add(turn, role, text, seen)
                if size >= chunk_rows:
                    yield emit(ready)
                    ready, size = [], 0
        if chunk is not None:  # the last conversation may go on in the next task
            ready.append(row(chunk, False))
        if ready:
            yield emit(ready)

    return laid.mapInArrow(run, schema)


def _late_duplicates(parts: DataFrame) -> DataFrame:
    """``(chunk, late)``: the row numbers whose role and text an earlier task's chunk already holds."""
    marks = parts.select("conv_id", "chunk", "marks", F.expr("shiftright(chunk, 32)").alias("part"),
                         F.explode(F.sequence(F.lit(0), F.expr("cast(length(marks) div 16 as int)") - 1)).alias("at"))
    one = marks.select("conv_id", "chunk", "part", "at", F.expr("substring(marks, at * 16 + 1, 16)").alias("mark"))
    # A task marks its own repeats itself, so here the first row of a mark and task is enough.
    firsts = one.groupBy("conv_id", "mark", "part").agg(F.min(F.struct("chunk", "at")).alias("first"))
    window = Window.partitionBy("conv_id", "mark")  # one row a task at most
    late = firsts.withColumn("least", F.min("part").over(window)).where("part > least")
    return late.groupBy(F.col("first.chunk").alias("chunk")).agg(F.collect_list("first.at").alias("late"))


_LINK = "chain long, k long, chunk long, last boolean, codes binary, used longs, out longs"


def _linked(parts: DataFrame) -> DataFrame:
    """The chunks that need stitching, numbered along their conversation, with their codes."""
    late = _late_duplicates(parts)
    lean = parts.select("conv_id", "chunk", "codes").join(late, "chunk", "left")
    window = Window.partitionBy("conv_id")  # one lean row for each chunk of the conversation
    lean = (lean.withColumn("chain", F.min("chunk").over(window))
            .withColumn("k", F.row_number().over(window.orderBy("chunk")).cast("long"))
            .withColumn("last", F.max("chunk").over(window) == F.col("chunk")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit, steps = _emitter(fields(_LINK)), Steps()
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                codes = bytearray(r["codes"])
                for at in r.pop("late") or ():
                    if codes[at] >> 2 != BLANK:
                        codes[at] = codes[at] & 3 | DUPLICATE << 2
                r["codes"], r["used"] = bytes(codes), list(AT_END)  # speculative, but for the last chunk
                r["out"] = list(backward(steps, r["codes"], AT_END)[0])
            if rows:
                yield emit(rows)

    return lean.select("chain", "k", "chunk", "last", "codes", "late").mapInArrow(run, fields(_LINK))


def _settled(links: DataFrame, fix: Callable[[Steps, dict, list[int]], list[int]], back: bool, start: list[int],
             fan: int) -> DataFrame:
    """Fix-up passes until every chunk ``used`` what its neighbour's ``out`` says (``start`` at the
    chain's end).  ``back``: the neighbour is the successor, else the predecessor.  ``fix`` reruns a
    chunk from another vector and returns its new ``out``."""
    schema = links.schema
    links, width, step = saved(links, "repair-links"), 1, 1 if back else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit, steps = _emitter(schema), Steps()
        walk, carried = None, None
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                wanted = r.pop("wanted")
                if walk == (r["chain"], r["walk"]):
                    wanted = carried
                walk = r["chain"], r.pop("walk")
                if wanted != r["used"]:
                    r["out"] = fix(steps, r, wanted)
                    r["used"] = wanted
                carried = r["out"]
            if rows:
                yield emit(rows)

    while True:
        beside = links.select("chain", (F.col("k") - step).alias("k"), F.col("out").alias("wanted"))
        asked = links.join(beside, ["chain", "k"], "left").withColumn(
            "wanted", F.coalesce("wanted", F.array(*[F.lit(x).cast("long") for x in start])))
        if asked.where("wanted != used").isEmpty():
            return links
        walks = asked.withColumn("walk", F.floor(F.col("k") / width))
        order = [F.col("chain"), F.col("walk"), F.col("k").desc() if back else F.col("k")]
        links = saved(walks.repartition("chain", "walk").sortWithinPartitions(*order)
                      .select(*schema.names, "wanted", "walk").mapInArrow(run, schema), "repair-links")
        width *= fan


def _fix_costs(steps: Steps, r: dict, wanted: list[int]) -> list[int]:
    new, met = rerun(steps, r["codes"], tuple(r["used"]), tuple(wanted))
    return r["out"] if met else list(new)


def _fix_trace(steps: Steps, r: dict, wanted: list[int]) -> list[int]:
    return [trace(steps, r["codes"], tuple(r["after"]), wanted[0], r["last"])[1]]


def _stitched(parts: DataFrame, fan: int) -> DataFrame:
    """The chunks ``parts``, repaired with regard to the whole of their conversations."""
    costs = _settled(_linked(parts), _fix_costs, True, list(AT_END), fan)
    # Forwards: a chunk's first guess is that it follows an assistant row.
    schema = fields("chain long, k long, chunk long, last boolean, codes binary, after longs, "
                                  "used longs, out longs")

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit, steps = _emitter(schema), Steps()
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["after"], r["used"] = r["used"], [0 if r["k"] == 1 else ASSISTANT]
                r["out"] = _fix_trace(steps, r, r["used"])
            if rows:
                yield emit(rows)

    traced = _settled(costs.mapInArrow(guess, schema), _fix_trace, False, [0], fan)
    out = T.StructType([*_chunk_schema(parts.schema["conv_id"].dataType).fields, T.StructField("chain", T.LongType())])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit, steps = _emitter(out), Steps()
        for batch in batches:
            for r in batch.to_pylist():
                edits, _, r["cost"] = trace(steps, r["codes"], tuple(r["after"]), r["used"][0], r["last"])
                r["roles"], r["texts"] = repaired(edits, r["codes"], r["used"][0], r["roles"], r["texts"])
                r["edits"], r["done"] = "".join(edits), True
                yield emit([r])

    both = parts.drop("codes", "marks").join(traced.drop("k", "out"), "chunk")
    return both.mapInArrow(finish, out)


def repair(rows: DataFrame, chunk_rows: int = CHUNK, fan: int = FAN) -> DataFrame:
    """The repaired conversations of ``rows`` (``conv_id, turn, role, text``), cut into chunks:
    ``(conv_id, chain, chunk, codes, edits, roles, texts, cost, ...)``, where ``roles`` and ``texts`` are the
    repaired rows, ``edits`` one letter for each edit, ``codes`` one byte for each row as it came (its
    class and fault), ``chain`` tells the conversation and ``chunk`` orders it; ``whole`` chunks are
    conversations of one chunk."""
    src = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
                      F.coalesce(F.col("text"), F.lit(" ")).alias("text"))
    chunks = saved(_chunks(src, chunk_rows), "repair-chunks")
    whole = chunks.where("done").withColumn("chain", F.col("chunk")).withColumn("whole", F.lit(True))
    stitched = saved(_stitched(chunks.where("not done"), fan), "repair-stitched").withColumn("whole", F.lit(False))
    return whole.unionByName(stitched).drop("marks", "done")


def repaired_rows(chunks: DataFrame) -> DataFrame:
    """The rows of repaired conversations: ``(conv_id, chunk, at, role, text)``, in this order."""
    return chunks.select("conv_id", "chunk", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "row")).select(
        "conv_id", "chunk", "at", F.col("row.roles").alias("role"), F.col("row.texts").alias("text"))


def report(chunks: DataFrame) -> DataFrame:
    """One row for each conversation: faults, gaps, cost, audit and the digest of its repaired
    rows (``role:text``, joined by newlines), streamed chunk by chunk.  Only conversations of several
    chunks are shuffled."""
    lines = F.array_join(F.transform(F.arrays_zip("roles", "texts"), lambda r: F.concat(r["roles"], F.lit(":"), r["texts"])), "\n")
    lean = chunks.select("conv_id", "chain", "chunk", "whole", "codes", "edits", "cost", "turn_first", "turn_last", "turn_low", "turn_high",
                         "n_turns", "illegal", "role_first", "role_last", F.size("roles").alias("n_rows"), lines.alias("lines"))
    out = T.StructType([T.StructField("conv_id", chunks.schema["conv_id"].dataType), *fields(
        "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "repaired_sha256 string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit = _emitter(out)
        chain, total, audit, digest, last, ready = None, {}, [], None, None, []

        def close() -> None:
            low, high = total.pop("low"), total.pop("high")
            total["gaps"] = 0 if low is None else high - low + 1 - total.pop("n_turns")
            total["audit"], total["repaired_sha256"] = "".join(audit), digest.hexdigest()
            ready.append(total)

        for batch in batches:
            for r in batch.to_pylist():
                if r["chain"] != chain:
                    if chain is not None:
                        close()
                    chain, audit, digest, last = r["chain"], [], hashlib.sha256(), None
                    total = {"conv_id": r["conv_id"], "low": None, "high": None, "n_turns": 0, "illegal": 0, "cost": 0,
                             "blank": 0, "duplicate": 0, "truncated": 0, "n_rows": 0}
                if last is not None:  # what lies between two chunks
                    total["illegal"] += last["role_last"] + r["role_first"] not in LEGAL_PAIRS
                    total["n_turns"] -= last["turn_last"] is not None and last["turn_last"] == r["turn_first"]
                if r["n_rows"]:
                    digest.update((("\n" if total["n_rows"] else "") + r["lines"]).encode("utf-8", "surrogatepass"))
                total["n_rows"] += r["n_rows"]
                if r["turn_low"] is not None:
                    total["low"] = r["turn_low"] if total["low"] is None else total["low"]
                    total["high"] = r["turn_high"]
                for name, fault in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED)):
                    total[name] += sum(r["codes"].count(c + 4 * fault) for c in range(4))
                total["n_turns"] += r["n_turns"]
                total["illegal"] += r["illegal"]
                total["cost"] += r["cost"]
                audit.append(r["edits"])
                last = r
                if len(ready) >= 1024:
                    yield emit(ready)
                    ready.clear()
        if chain is not None:
            close()
        if ready:
            yield emit(ready)

    longer = lean.where("not whole").repartition("chain").sortWithinPartitions("chain", "chunk")
    return lean.where("whole").mapInArrow(run, out).union(longer.mapInArrow(run, out))


def damage(rows: DataFrame) -> DataFrame:
    """Rows with faults put in by the crc32 of ``conv_id:turn``: some dropped, emptied, robbed of
    their ends of sentences, repeated, or given to the user.  The queries' own test load."""
    def text(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    key = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    kind = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), key.alias("__kind")).where("__kind != 0")
    return kind.select(
        "conv_id", "turn", F.when(F.col("__kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("__kind") == 3, 2).otherwise(1))).alias("__copy")).drop("__copy")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    done = report(repair(damage(rows)))
    ids = rows.select(F.col("conv_id").alias("__conv")).distinct()
    zero = {"repaired_sha256": EMPTY_DIGEST, "audit": ""}
    return ids.join(done, ids["__conv"].eqNullSafe(done["conv_id"]), "left").select(
        F.col("__conv").alias("conv_id"),
        *[F.coalesce(F.col(c), F.lit(zero.get(c, 0))).alias(c) for c in done.columns if c != "conv_id"])
