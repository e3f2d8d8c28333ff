"""Sinks: CSV export (K1), export guarded by a row-count gate (K2), dataset write (K3).

All writes go to a fresh sibling folder first and replace the target only after the
write job committed, so a failed write never leaves the target half-written or missing.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.checks import enforce_varchar
from strata.operators.ledger import LedgerTable
from strata.session import delete_path, hidden_sibling, replace_path
from strata.sources.csv import NULL_MARKER
from strata.sources.datasets import TEXT_TIME_OPTIONS, XML_ROOT_TAG, XML_ROW_TAG, check_format

# Bounds the rows per part file so that a multi-line (hence unsplittable) re-read of an
# export still runs one task per modest file.
DEFAULT_MAX_RECORDS_PER_FILE = 1_000_000
# XML is never split on read and a row is several times larger than in CSV, so its files
# are bounded more tightly (about 70 MB for purchase rows).
XML_MAX_RECORDS_PER_FILE = 200_000


def csv_write_options(*, conflate_empty: bool = False, delimiter: str = ",",
                      max_records_per_file: int | None = DEFAULT_MAX_RECORDS_PER_FILE,
                      columns: int = 2) -> dict[str, str]:
    """``columns``: a single column's NULL would be an empty line, which readers skip, so it is
    written as the marker that :mod:`strata.sources.csv` reads as NULL."""
    opts = {
        "header": "true",
        "sep": delimiter,
        "quote": '"',
        "escape": '"',
        # Spark trims blanks around values on write by default; exports must not.
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        # NULL prints as nothing; an empty string as "" unless asked to conflate them.
        "nullValue": NULL_MARKER if columns == 1 else "",
        "emptyValue": "" if conflate_empty else '""',
    }
    if max_records_per_file:
        opts["maxRecordsPerFile"] = str(max_records_per_file)
    return opts


def printable(df: DataFrame) -> DataFrame:
    """Timestamps as ``yyyy-MM-dd HH:mm:ss[.ffffff]`` text, other columns unchanged."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.col(field.name).cast("string").alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


def _staged(target: str) -> str:
    """A hidden sibling of ``target`` (Spark's file listing skips names starting with '.')."""
    return hidden_sibling(target, f"__staging-{uuid.uuid4().hex[:12]}")


def _write_then_swap(spark, write, target: str) -> None:
    staged = _staged(target)
    try:
        write(staged)
    except Exception:
        delete_path(spark, staged)
        raise
    replace_path(spark, staged, target)


def rows_per_file(df: DataFrame, fmt: str, target_bytes: int, sample_rows: int = 10_000) -> int:
    """How many rows of ``df``, encoded as ``fmt``, make a file of about ``target_bytes``.

    The width is the average of the first ``sample_rows`` rows as the writer encodes them, which takes a
    few tasks of the plan a second time.  Only for text formats: the others compress whole columns."""
    f = check_format(fmt)
    if f not in ("csv", "json", "xml") or target_bytes < 1:
        raise ValueError(f"no row width for {fmt!r} files of {target_bytes} bytes")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    if f == "csv":
        line = F.to_csv(row, {k: v for k, v in csv_write_options(columns=len(df.columns)).items() if k not in ("header", "maxRecordsPerFile")})
    elif f == "json":
        line = F.to_json(row, TEXT_TIME_OPTIONS)
    else:
        line = F.to_xml(row, {**TEXT_TIME_OPTIONS, "rowTag": XML_ROW_TAG})
    rows = printable(df) if f == "csv" else df
    width = rows.limit(sample_rows).select((F.octet_length(line) + 1).alias("bytes")).agg(F.avg("bytes")).first()[0]
    return max(1, round(target_bytes / width)) if width else DEFAULT_MAX_RECORDS_PER_FILE


def export_csv(df: DataFrame, path: str, *, conflate_empty: bool = False,
               max_records_per_file: int | None = DEFAULT_MAX_RECORDS_PER_FILE, atomic: bool = False,
               target_bytes: int | None = None) -> str:
    """Write ``df`` as header CSV under folder ``path``, replacing what was there (K1).

    Header from column names, ``,`` separator, quotes only where needed, embedded quotes
    doubled, NULL as an empty field.  Part files are written in parallel, one or more per
    partition, each holding at most ``max_records_per_file`` rows, or as many as make about
    ``target_bytes``.  ``atomic`` writes ``path`` as a
    ledger table: readers (``read_dataset``) see the old export until they see the new one, and
    a crash leaves one of the two.
    """
    if atomic:
        if conflate_empty or target_bytes or max_records_per_file != DEFAULT_MAX_RECORDS_PER_FILE:
            raise ValueError("an atomic export has the default layout")
        LedgerTable(df.sparkSession, path).overwrite(df, "csv")
        return path
    if target_bytes:
        max_records_per_file = rows_per_file(df, "csv", target_bytes)
    out = printable(df)
    writer = out.write.mode("errorifexists").options(
        **csv_write_options(conflate_empty=conflate_empty, max_records_per_file=max_records_per_file, columns=len(out.columns)))
    _write_then_swap(df.sparkSession, writer.csv, path)
    return path


@dataclass(frozen=True)
class ExportResult:
    status: str  # "exported" or "skipped"
    path: str


def guarded_export(df: DataFrame, path: str, **options) -> ExportResult:
    """Export only when ``df`` has rows (K2).

    The emptiness test stops at the first row found.  An empty input leaves whatever
    was at ``path`` untouched and reports ``skipped``.
    """
    if df.isEmpty():
        return ExportResult("skipped", path)
    export_csv(df, path, **options)
    return ExportResult("exported", path)


def dataset_writer(df: DataFrame, fmt: str, max_records_per_file: int | None = None,
                   compression: str | None = None) -> DataFrameWriter:
    """A writer of ``df`` as ``fmt`` with this library's options for the format."""
    f = check_format(fmt)
    if max_records_per_file is None:
        max_records_per_file = {"csv": DEFAULT_MAX_RECORDS_PER_FILE, "xml": XML_MAX_RECORDS_PER_FILE,
                                "json": DEFAULT_MAX_RECORDS_PER_FILE if compression else 0}.get(f, 0)
    out = printable(df) if f == "csv" else df
    writer = out.write.format(f)
    if compression:
        writer = writer.option("compression", compression)
    if f == "csv":
        writer = writer.options(**csv_write_options(max_records_per_file=max_records_per_file,
                                                     columns=len(out.columns)))
    elif max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if f in ("json", "xml"):
        writer = writer.options(**TEXT_TIME_OPTIONS)
    if f == "xml":
        writer = writer.option("rowTag", XML_ROW_TAG).option("rootTag", XML_ROOT_TAG)
    return writer


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", *, mode: str = "overwrite",
                  varchar_limits: Mapping[str, int] | None = None,
                  partition_by: list[str] | None = None,
                  max_records_per_file: int | None = None, atomic: bool = False,
                  target_bytes: int | None = None, compression: str | None = None) -> str:
    """Write ``df`` to ``path`` as ``fmt`` (K3).

    ``atomic`` overwrites ``path`` as a ledger table, replaced by the creation of one file; read it
    with ``read_dataset``.

    ``overwrite`` writes a sibling folder and swaps it in after success; ``append``
    adds files in place (one job commit: all or nothing).  ``varchar_limits`` applies
    the VARCHAR rule, since a path has no declared column types to enforce it.
    ``max_records_per_file`` defaults per format (0 means unbounded): CSV and XML may hold
    records spanning lines and are then read one task per file, so their files are bounded;
    parquet, orc, avro and JSON lines split on read and keep Spark's one file per task.
    ``target_bytes`` bounds the files of a text format by their size (before compression) instead of their rows.
    ``compression`` names a codec of the format in place of its default (none for text formats);
    reads find it by the file names.  Compressed JSON does not split, so its files are bounded like CSV's.
    """
    f = check_format(fmt)
    if atomic:
        if partition_by or target_bytes or compression or max_records_per_file is not None or mode != "overwrite":
            raise ValueError("an atomic write overwrites, in the default layout")
        LedgerTable(df.sparkSession, path).overwrite(df, f, varchar_limits)
        return path
    if target_bytes:
        max_records_per_file = rows_per_file(df, f, target_bytes)
    writer = dataset_writer(enforce_varchar(df, varchar_limits or {}), f, max_records_per_file, compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        if mode == "overwrite":
            _write_then_swap(df.sparkSession, writer.mode("errorifexists").save, path)
        else:
            writer.mode(mode).save(path)
    except Exception as exc:
        if f == "avro" and "DATA_SOURCE_NOT_FOUND" in str(exc):
            raise RuntimeError("format 'avro' needs the spark-avro module on the classpath") from exc
        raise
    return path
