"""Typed CSV reading with the bulk-load rules of a header CSV ``COPY``.

* line 1 is a header and is skipped; columns map by position, not by header name;
* each field is converted to the declared type and the first bad row fails the whole read;
* an unquoted empty field is NULL, a quoted ``""`` is an empty string;
* a quoted field may hold the delimiter, doubled quotes and newlines.

Multi-line parsing makes a file unsplittable, so one huge file is one task: land many files,
read with ``multi_line=False`` where no field spans lines, or with ``multi_line="split"``, which finds
the records of a file in parallel (:mod:`strata.sources.records`).  Which parser reads a file is the
caller's choice alone; it never depends on the file's size or on the cluster.  Writers in
:mod:`strata.operators.sinks` bound the rows per file, so re-reads of their output run one
task per modest file.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.functions.checks import enforce_varchar
from strata.schemas import LOG_REVIEW, MOVIE_REVIEW, USER_PURCHASE, USER_PURCHASE_VARCHAR
from strata.sources.records import naming_bad_record, read_csv_split

# A token that never occurs in data: unquoted empty fields become NULL, quoted "" stays "".
NULL_MARKER = "\u0002"


def csv_read_options(*, header: bool = True, mode: str = "FAILFAST", multi_line: bool | str = True,
                     postgres_nulls: bool = True, timestamp_format: str | None = None,
                     delimiter: str = ",") -> dict[str, str]:
    opts = {
        "header": str(header).lower(),
        "mode": mode,
        "sep": delimiter,
        "quote": '"',
        "escape": '"',
        "multiLine": str(bool(multi_line)).lower(),
        "enforceSchema": "true",
    }
    if postgres_nulls:
        opts["nullValue"] = NULL_MARKER
    if timestamp_format:
        opts["timestampNTZFormat"] = timestamp_format
        opts["timestampFormat"] = timestamp_format
    return opts


def read_csv_typed(spark: SparkSession, path: str | list[str], schema: T.StructType = USER_PURCHASE,
                   *, varchar_limits: Mapping[str, int] | None = None, multi_line: bool | str = True,
                   **options) -> DataFrame:
    """Read header CSV at ``path`` as ``schema``.

    ``multi_line=True`` (the default) parses each file whole, one task per file, so a quoted
    field may span lines.  ``False`` is the caller's statement that no field does and that
    blank lines may be skipped; files are then split by line across tasks.  ``"split"`` gives the rows
    of ``True`` with one task per split, at the price of a second read of the text; it wants quotes
    around whole fields, and fails where a record of several lines has others.
    ``varchar_limits`` (defaults to the purchase table's when ``schema`` is the purchase
    schema) adds the VARCHAR length rule as a column expression.  The result is lazy and
    column pruning skips parsing of unread columns, so a bad field in a column nobody reads
    does not fail the read; writers read every column and therefore do see it.
    """
    if varchar_limits is None and schema == USER_PURCHASE:
        varchar_limits = USER_PURCHASE_VARCHAR
    if isinstance(multi_line, str) and multi_line != "split":
        raise ValueError(f"multi_line is True, False or 'split', not {multi_line!r}")
    read_options = csv_read_options(multi_line=multi_line, **options)
    if multi_line == "split":
        df = read_csv_split(spark, path, schema, read_options)
    else:
        df = spark.read.schema(schema).options(**read_options).csv(path)
    return enforce_varchar(df, varchar_limits or {})


def naming_bad_csv_record(spark: SparkSession, path: str | list[str], schema: T.StructType = USER_PURCHASE, *,
                          varchar_limits: Mapping[str, int] | None = None, **options):
    """A context for an action that loads the CSV files at ``path``: if it fails because of a record,
    the error names file, record and column (S1).  Nothing is read unless it fails."""
    if varchar_limits is None and schema == USER_PURCHASE:
        varchar_limits = USER_PURCHASE_VARCHAR
    return naming_bad_record(spark, path, schema, csv_read_options(**options), varchar_limits)


def read_bronze_csv(spark: SparkSession, path: str | list[str], kind: str = "movie_review",
                    **options) -> DataFrame:
    """Read a raw ("bronze") CSV of a known kind (S2): ``movie_review``, ``log_review``
    or ``user_purchase``."""
    schemas = {"movie_review": MOVIE_REVIEW, "log_review": LOG_REVIEW, "user_purchase": USER_PURCHASE}
    if kind not in schemas:
        raise KeyError(f"unknown bronze kind {kind!r}; expected one of {sorted(schemas)}")
    return read_csv_typed(spark, path, schemas[kind], **options)
