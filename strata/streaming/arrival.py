"""Arrival-driven loading (S5): load landing files once they exist.

``refresh`` loads the whole present content of the landing folder whenever its fingerprint (path,
length and modification time of every file, reduced to one row by Spark) differs from the one
recorded under the checkpoint, so an object replaced under its name and parts that arrive over
several runs are all seen.  ``append`` follows a file stream with ``availableNow``: every run takes
what has arrived since the last one.  Into a ledger table a batch is appended exactly once: the
entry that makes its rows visible records the stream's id and the batch's number.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.checks import enforce_varchar
from strata.operators.ledger import LedgerTable
from strata.operators.tables import append_load, create_if_absent, full_refresh_load
from strata.schemas import USER_PURCHASE, USER_PURCHASE_DDL, USER_PURCHASE_VARCHAR
from strata.session import path_exists
from strata.sources.csv import csv_read_options, naming_bad_csv_record, read_csv_typed


@dataclass
class ArrivalResult:
    batches: list[int] = field(default_factory=list)
    rows: int = 0


_MARK = "files long, digest string"


def fingerprint(spark: SparkSession, landing_dir: str) -> Row | None:
    """Number of files and a digest of their paths, lengths and times; None without files."""
    files = spark.read.format("binaryFile").load(landing_dir)
    one = files.select(F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)").alias("h")).agg(
        F.count("*").alias("files"), F.sum("h").cast("string").alias("digest")).first()
    return one if one["files"] else None


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the streaming query keeps in its checkpoint: the same after a restart, another
    one for a new checkpoint (whose batches start from 0 again)."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0])["id"]


def arrival_load(spark: SparkSession, landing_dir: str, table: str | LedgerTable, checkpoint: str, *,
                 schema: T.StructType = USER_PURCHASE, ddl: str = USER_PURCHASE_DDL,
                 varchar_limits: dict[str, int] | None = None, mode: str = "refresh",
                 archive_dir: str | None = None, max_files_per_trigger: int | None = None,
                 **csv_options) -> ArrivalResult:
    """Load CSV files of ``landing_dir`` into ``table``.

    ``mode="refresh"`` replaces the table's rows with all rows of the landing folder if its files
    changed since the last load (one batch, else none).  The fingerprint is taken before the files
    are read and recorded after the table was replaced, so a failure or a file that changes
    meanwhile leads to another load, never to a missed one.  A bad record fails the load with an error
    that names it.
    ``mode="append"`` appends each batch of new files, into a ledger table exactly once; into a
    catalog table a batch retried after a failure mid-write may be appended twice
    (at-least-once).  ``checkpoint`` must be on shared storage.

    ``archive_dir`` moves each processed file there and ``max_files_per_trigger`` bounds the files
    per batch; both belong to ``append`` mode, since a refresh is of the whole landing folder.
    """
    if mode not in ("refresh", "append"):
        raise ValueError("mode must be 'refresh' or 'append'")
    if mode == "refresh" and (max_files_per_trigger or archive_dir):
        raise ValueError("a refresh loads the whole landing folder in one batch")
    if varchar_limits is None and schema == USER_PURCHASE:
        varchar_limits = USER_PURCHASE_VARCHAR
    ledger = isinstance(table, LedgerTable)
    if ledger:
        table.create(schema, varchar_limits)
    else:
        create_if_absent(spark, table, ddl)
    result = ArrivalResult()
    if mode == "refresh":
        mark = f"{checkpoint.rstrip('/')}/landing"
        now = fingerprint(spark, landing_dir)
        if now is None or (path_exists(spark, f"{mark}/_SUCCESS") and
                           spark.read.schema(_MARK).json(mark).first() == now):
            return result
        rows = read_csv_typed(spark, landing_dir, schema, varchar_limits=varchar_limits or {}, **csv_options)
        with naming_bad_csv_record(spark, landing_dir, schema, varchar_limits=varchar_limits or {}, **csv_options):
            result.rows = table.refresh(rows).rows if ledger else full_refresh_load(spark, table, rows, ddl)
        spark.createDataFrame([now], _MARK).coalesce(1).write.mode("overwrite").json(mark)
        result.batches.append(0)
        return result
    # Multi-line parsing, FAILFAST and the NULL rule as in the batch read; one file per task.
    reader = spark.readStream.schema(schema).options(**csv_read_options(**csv_options))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.csv(landing_dir)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        if ledger:
            done = table.append(batch, stream_id(spark, checkpoint), batch_id)
            result.rows += done.rows
        else:
            result.rows += append_load(spark, table, enforce_varchar(batch, varchar_limits or {}))
        result.batches.append(batch_id)

    query = (stream.writeStream.foreachBatch(each_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return result
