"""Datasets stored at a path in a chosen format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources.csv import csv_read_options, read_csv_typed

# Formats a silver or gold dataset may be stored in.  Avro needs the external
# spark-avro module on the classpath; without it the read or write fails with
# Spark's DATA_SOURCE_NOT_FOUND.
FORMATS = ("parquet", "orc", "json", "csv", "xml", "avro")

# Text formats lose types unless the schema is given on read.
SCHEMA_NEEDED = ("json", "csv", "xml")

XML_ROW_TAG = "row"
XML_ROOT_TAG = "rows"

# Text formats print timestamps with microseconds (Spark's default keeps milliseconds).
TEXT_TIME_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def check_format(fmt: str) -> str:
    f = fmt.lower()
    if f not in FORMATS:
        raise ValueError(f"unsupported dataset format {fmt!r}; expected one of {FORMATS}")
    return f


def read_dataset(spark: SparkSession, path: str, fmt: str = "parquet",
                 schema: T.StructType | None = None) -> DataFrame:
    """Open the dataset at ``path`` stored as ``fmt``.

    For ``json``, ``csv`` and ``xml`` pass ``schema`` to get the written types back.  A path
    written as a ledger table (``atomic=True``) knows its own format and schema.
    """
    from strata.operators.ledger import LedgerTable, is_ledger

    if is_ledger(spark, path):
        return LedgerTable(spark, path).read()
    return read_dataset_folders(spark, [path], fmt, schema)


def read_dataset_folders(spark: SparkSession, paths: list[str], fmt: str, schema: T.StructType | None) -> DataFrame:
    """The rows of one or more folders written as ``fmt``."""
    path = paths if len(paths) > 1 else paths[0]
    f = check_format(fmt)
    if f == "csv" and schema is not None:  # the bulk-load rules of typed CSV reads
        return read_csv_typed(spark, path, schema, varchar_limits={})
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if f == "csv":
        reader = reader.options(**csv_read_options())
    elif f == "json":
        reader = reader.options(**TEXT_TIME_OPTIONS)
    elif f == "xml":
        reader = (reader.options(**TEXT_TIME_OPTIONS).option("rowTag", XML_ROW_TAG)
                  .option("ignoreSurroundingSpaces", "false"))
    return reader.format(f).load(path)
