"""The records of CSV files, found in parallel however large a file is.

A quoted field may hold newlines, so where a record starts depends on all quotes before it.  The
files are read by line, split by byte range like any text, and:

1. each split's quotes are counted (one number a split), and their running sum along a file tells for each
   split whether it starts inside a quoted field;
2. each split then cuts its own lines into records; a record that spans a cut is handed over in pieces,
   which are joined along the file.  Only such pieces are shuffled.

Quotes must stand around whole fields and be doubled inside them, as in the files this library
writes.  A record of several lines that is not of this form fails the read, so the rows are those of the
whole-file parser or there is an error (but that parser turns a field's CR LF into LF in files whose
records end with CR LF; here fields keep it, as in a bulk load).  Records end with a newline, with or without carriage
return; empty lines are no records.  The text is read twice, three times if a record spans a cut; the splits'
parities are held on the driver and in the tasks, 9 bytes a split.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

# A record: ``at`` counts the records that start in its split from 0 on.
RECORD = "key long, split long, at long, record string"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with the split they start in: ``(file, split, key, value)``."""
    text = spark.read.option("lineSep", "\n").text(path)
    place = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")
    return place.select("file", "split", F.xxhash64("file", "split").alias("key"), "value")


class _Walk:
    """Cuts the lines of a task's splits into records, given where each split starts."""

    def __init__(self, keys: np.ndarray, inside: np.ndarray, delimiter: str):
        self.keys, self.inside = keys, inside
        field = f'(?:"(?:[^"]|"")*+"|[^"\\n{re.escape(delimiter)}]*+)'
        self.form = re.compile(f"{field}(?:{re.escape(delimiter)}{field})*+")

    def starts_inside(self, key: int) -> bool:
        at = int(np.searchsorted(self.keys, key))
        if at >= len(self.keys) or self.keys[at] != key:
            raise ValueError("the files or their splits changed while they were read")
        return bool(self.inside[at])

    def checked(self, record: str) -> str:
        if record.endswith("\r"):
            record = record[:-1]
        if "\n" in record and self.form.fullmatch(record) is None:
            raise ValueError(f"a quote inside an unquoted field, or no closing quote, in the record that starts with {record[:60]!r}")
        return record

    def records(self, batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[tuple[int, int, int, pa.Array | str, bool]]:
        """``(key, split, at, records, opens)``.  With ``whole`` the records that lie in one split, in
        arrays; else the pieces of the others, one at a time, ``opens`` where the record starts."""
        key = split = None
        at, inside, held, ours = 0, False, [], False  # the open record's lines so far; whether it began in this split

        def piece():
            return [(key, split, at - 1 if ours else -1, "\n".join(held), ours)] if held and not whole else []

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for begin, end in zip(bounds, bounds[1:]):
                if keys[begin] != key:
                    yield from piece()
                    key, split, at, held = int(keys[begin]), batch.column(1)[begin].as_py(), 0, []
                    inside, ours = self.starts_inside(key), False
                values = batch.column(2).slice(begin, end - begin)
                quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
                after = (np.cumsum(quotes) + inside) & 1
                first = np.flatnonzero(np.concatenate(([inside], after[:-1])) == 0)  # lines that start a record
                if not inside and first.size == len(values) and not after[-1]:
                    if whole:
                        full = pc.replace_substring_regex(values, "\r$", "")
                        full = full.filter(pc.not_equal(full, ""))
                        yield key, split, at, full, False
                        at += len(full)
                    else:
                        at += pc.sum(pc.invert(pc.match_substring_regex(values, "^\r?$"))).as_py()
                    continue
                lines = values.to_pylist()
                head = int(first[0]) if first.size else len(lines)
                if inside:
                    held += lines[:head]
                    if first.size or not after[-1]:  # the open record ends here
                        if not ours:
                            yield from piece()
                        elif whole:
                            yield key, split, at - 1, pa.array([self.checked("\n".join(held))]), False
                        held = []
                out = []
                for a, b in zip(first.tolist(), [*first[1:].tolist(), len(lines)]):
                    if b == len(lines) and after[-1]:
                        held, ours = lines[a:], True
                        continue
                    record = self.checked(lines[a] if b == a + 1 else "\n".join(lines[a:b]))
                    if record:
                        out.append(record)
                if whole and out:
                    yield key, split, at, pa.array(out, pa.string()), False
                at += len(out) + bool(first.size and after[-1])
                inside = bool(after[-1])
        yield from piece()


@dataclass(frozen=True)
class Records:
    """``records`` are all records of the files, headers included; ``splits`` are the files' parts
    ``(key, file, split)`` in which a line starts."""
    records: DataFrame
    splits: DataFrame


def csv_records(spark: SparkSession, path: str | list[str], delimiter: str = ",") -> Records:
    """All records of the CSV files at ``path``: ``(key, split, at, record)``."""
    lines = _lines(spark, path)
    counted = scratch_path(spark, "csv-splits")
    quotes = F.expr("length(value) - length(replace(value, '\"', ''))")
    lines.groupBy("file", "split", "key").agg(F.sum(quotes).alias("quotes")).write.parquet(counted)
    splits = spark.read.parquet(counted)
    odd = splits.groupBy("file").agg(F.sum("quotes").alias("quotes")).where("quotes % 2 = 1").limit(1).collect()
    if odd:
        raise ValueError(f"a quote without its closing quote in {odd[0]['file']}")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    known = splits.select("key", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside")).toArrow()
    keys, inside = known.column("key").to_numpy(), known.column("inside").to_numpy()
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((keys[order], inside[order]))
    source = lines.select("key", "split", "value")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, split, at, records, _ in _Walk(*shared.value, delimiter).records(batches, True):
            n = len(records)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, key)), pa.array(np.full(n, split)), pa.array(np.arange(at, at + n)), records],
                names=["key", "split", "at", "record"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, split, at, text, opens in _Walk(*shared.value, delimiter).records(batches, False):
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([split]), pa.array([at]), pa.array([text]), pa.array([opens])],
                                             names=["key", "split", "at", "text", "opens"])

    records = source.mapInArrow(whole, RECORD)
    if inside.any():
        path_ = scratch_path(spark, "csv-pieces")
        source.mapInArrow(pieces, "key long, split long, at long, text string, opens boolean").join(
            splits.select("key", "file"), "key").write.parquet(path_)
        found = spark.read.parquet(path_)
        along = Window.partitionBy("file").orderBy("split", "opens")
        begun = found.withColumn("begin", F.last(F.when(F.col("opens"), F.struct("key", "split", "at")), ignorenulls=True).over(along))
        joined = begun.groupBy("file", "begin").agg(F.array_sort(F.collect_list(F.struct("split", "opens", "text"))).alias("p"))

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            walk = _Walk(*shared.value, delimiter)
            for batch in batches:
                full = pa.array([walk.checked(r) for r in batch.column(3).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), full],
                                                 names=["key", "split", "at", "record"])

        stitched = joined.select("begin.key", "begin.split", "begin.at", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("record"))
        records = records.unionByName(stitched.mapInArrow(check, RECORD))
    return Records(records, splits.select("key", "file", "split"))


def _data(found: DataFrame, header: bool) -> DataFrame:
    return found.where("not (split = 0 and at = 0)") if header else found


def read_csv_split(spark: SparkSession, path: str | list[str], schema: T.StructType, options: Mapping[str, str]) -> DataFrame:
    """The files' rows as ``schema``; ``options`` are those of the whole-file CSV reader."""
    found = csv_records(spark, path, options.get("sep", ","))
    kept = {k: v for k, v in options.items() if k not in ("header", "enforceSchema")}
    row = F.from_csv(F.col("record"), _ddl(schema), kept)
    return _data(found.records, options.get("header") == "true").select(row.alias("r")).select("r.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


# --- the record that failed a read ---

class BadRecordError(ValueError):
    """The first record, by file and place, that a typed read rejects."""

    def __init__(self, file: str, record: int, text: str, column: str | None, value: str | None, reason: str):
        self.file, self.record, self.text, self.column, self.value, self.reason = file, record, text, column, value, reason
        where = f", column {column}" if column else ""
        super().__init__(f"{file}, record {record}{where}: {reason}")


def first_bad_record(spark: SparkSession, path: str | list[str], schema: T.StructType, options: Mapping[str, str],
                     varchar_limits: Mapping[str, int] | None = None) -> BadRecordError | None:
    """The first record that ``schema`` or the VARCHAR limits reject, or None.

    Records are numbered along their file from 1 on, the header included: by the counts of the
    splits before and the place in its own, so no file is read in one task.  For use after a read
    failed; reads that succeed do not pay for it."""
    found = csv_records(spark, path, options.get("sep", ","))
    plain = {k: v for k, v in options.items() if k not in ("header", "enforceSchema")}
    plain |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}
    limits = varchar_limits or {}

    def parsed(types: T.StructType):
        return F.from_csv(F.col("record"), _ddl(types) + ", `__bad` string", plain)

    row = parsed(schema)
    wrong = row["__bad"].isNotNull()
    for name, limit in limits.items():
        wrong = wrong | F.coalesce(F.char_length(F.rtrim(row[name])) > limit, F.lit(False))
    bad = _data(found.records, options.get("header") == "true").where(wrong).join(found.splits.drop("split"), "key")
    first = bad.orderBy("file", "split", "at").limit(1)
    got = first.collect()
    if not got:
        return None
    r = got[0]
    # One record: its columns one by one.
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    tests = [parsed(T.StructType([f if g.name == f.name else T.StructField(g.name, T.StringType()) for g in schema]))["__bad"].isNotNull()
             for f in schema]
    one = spark.createDataFrame([(r["record"],)], "record string").select(parsed(texts)["__bad"].isNotNull().alias("count"), *[
        t.alias(f"c{i}") for i, t in enumerate(tests)]).first()
    values = next(csv.reader(io.StringIO(r["record"], newline=""), delimiter=options.get("sep", ",")), [])
    earlier = found.splits.where((F.col("file") == r["file"]) & (F.col("split") < r["split"])).select("key")
    number = found.records.join(earlier, "key", "left_semi").count() + r["at"] + 1
    if one["count"]:
        return BadRecordError(r["file"], number, r["record"], None, None, f"{len(values)} fields for {len(schema)} columns")
    for i, f in enumerate(schema):
        value = values[i] if i < len(values) else None
        if one[f"c{i}"]:
            return BadRecordError(r["file"], number, r["record"], f.name, value, f"{value!r} is no {f.dataType.simpleString()}")
        if f.name in limits and value is not None and len(value.rstrip(" ")) > limits[f.name]:
            return BadRecordError(r["file"], number, r["record"], f.name, value, f"too long for VARCHAR({limits[f.name]})")
    return BadRecordError(r["file"], number, r["record"], None, None, "not readable as the declared columns")


@contextmanager
def naming_bad_record(spark: SparkSession, path: str | list[str], schema: T.StructType, options: Mapping[str, str],
                      varchar_limits: Mapping[str, int] | None = None):
    """Turn the failure of a load from ``path`` into one that names file, record and column, where
    a record is to blame; other failures pass through."""
    try:
        yield
    except Exception as exc:
        try:
            bad = first_bad_record(spark, path, schema, options, varchar_limits)
        except Exception:  # noqa: BLE001 - the files cannot be read at all: the first failure says why
            bad = None
        if bad is not None:
            raise bad from exc
        raise
