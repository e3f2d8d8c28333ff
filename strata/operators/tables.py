"""Table lifecycle and loading (T1-T6) on catalog tables.

A table name may be database-qualified.  Loads are positional, like a bulk ``COPY``:
the source's columns are matched to the table's by order, and the table's declared
types (including ``VARCHAR(n)``) are enforced on insert.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.schemas import USER_PURCHASE_DDL


def quoted(table: str) -> str:
    """``table`` (optionally ``db.table``) as a back-quoted identifier, so a name can never
    be read as SQL."""
    parts = table.split(".")
    if not 1 <= len(parts) <= 3 or not all(p.strip() for p in parts):
        raise ValueError(f"not a table name: {table!r}")
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def create_if_absent(spark: SparkSession, table: str, ddl: str = USER_PURCHASE_DDL,
                     using: str = "parquet") -> None:
    """``CREATE TABLE IF NOT EXISTS`` (T1): a no-op when present, schema not compared."""
    if not using.isidentifier():
        raise ValueError(f"not a data source name: {using!r}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({ddl}) USING {using}")


def clear_table(spark: SparkSession, table: str) -> None:
    """Remove every row, keep the table and its schema."""
    spark.sql(f"TRUNCATE TABLE {quoted(table)}")


def drop_if_exists(spark: SparkSession, table: str) -> None:
    """Idempotent drop."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def row_count_gate(df: DataFrame) -> DataFrame:
    """One row ``(total_rows bigint, proceed boolean)`` (T4).

    A distributed count: partial counts per task, one tiny final merge.
    """
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows", (F.col("total_rows") > 0).alias("proceed"))


def footer_count_gate(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """The gate of :func:`row_count_gate` for a parquet or ORC folder, counted from the files' footers
    (T4): the aggregate is pushed into the scan, so no column of any row is read.

    The settings this takes belong to a session of its own; the caller's stay as they are."""
    if fmt not in ("parquet", "orc"):
        raise ValueError(f"{fmt!r} files have no footer that counts rows")
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set(f"spark.sql.{fmt}.aggregatePushdown", "true")
    return row_count_gate(own.read.format(fmt).load(path))


def has_rows(df: DataFrame) -> bool:
    """The branch a gate takes, computed by stopping at the first row."""
    return not df.isEmpty()


def append_load(spark: SparkSession, table: str, source: DataFrame) -> int:
    """Append ``source`` to ``table`` by position (T5); returns the rows added, as the write
    itself counted them.

    One write job: on failure no file of it becomes visible and old rows stay.  A driver that dies
    while the job commits can leave a part: :class:`strata.operators.ledger.LedgerTable` appends all
    rows or none in that case too, and exactly once.
    """
    counted = Observation()
    source.observe(counted, F.count(F.lit(1)).alias("rows")).write.insertInto(table)
    return int(counted.get["rows"])


def _split(table: str) -> tuple[str | None, str]:
    parts = table.rsplit(".", 1)
    return (parts[0], parts[1]) if len(parts) == 2 else (None, parts[0])


def full_refresh_load(spark: SparkSession, table: str, source: DataFrame,
                      ddl: str = USER_PURCHASE_DDL) -> int:
    """Replace the rows of ``table`` with exactly the rows of ``source``.

    ``source`` is loaded into a stage table created ``LIKE`` the target, so every parse,
    type, range and length error surfaces before the target is touched; then the stage
    is renamed into place.  A failure leaves the old rows readable.  Re-running with the
    same source leaves the same rows (idempotent).  Returns the number of rows loaded.

    The two renames are not one transaction: if the second fails the first is undone, and
    a driver crash between them leaves the old rows under the ``__old_*`` name, from where
    they can be renamed back (:class:`strata.operators.ledger.LedgerTable` has no such gap).  Meant for managed tables: the stage is created ``LIKE`` the
    target without its location, so an external table would come back as a managed one.
    """
    create_if_absent(spark, table, ddl)
    db, base = _split(table)
    tag = uuid.uuid4().hex[:12]
    qual = (lambda n: f"{db}.{n}") if db else (lambda n: n)
    stage, old = qual(f"{base}__stage_{tag}"), qual(f"{base}__old_{tag}")
    try:
        spark.sql(f"CREATE TABLE {quoted(stage)} LIKE {quoted(table)}")
        rows = append_load(spark, stage, source)
        spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted(old)}")
        try:
            spark.sql(f"ALTER TABLE {quoted(stage)} RENAME TO {quoted(table)}")
        except Exception:
            spark.sql(f"ALTER TABLE {quoted(old)} RENAME TO {quoted(table)}")
            raise
        spark.sql(f"DROP TABLE IF EXISTS {quoted(old)}")
        return rows
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(stage)}")


# --- the same loads against a JDBC table ---
# Not exercised by the tests here: no database server may run in this environment.

def append_load_jdbc(source: DataFrame, url: str, table: str,
                     properties: dict[str, str] | None = None, num_partitions: int | None = None) -> None:
    """Append ``source`` to JDBC ``table`` (T5); ``num_partitions`` caps parallel connections.

    Each task commits its own slice, so unlike a catalog-table append a failed job can
    leave the slices of finished tasks behind.
    """
    writer = source.write.mode("append")
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    writer.jdbc(url, table, properties=dict(properties or {}))


def clear_table_jdbc(spark: SparkSession, url: str, table: str,
                     properties: dict[str, str] | None = None) -> None:
    """Remove every row of JDBC ``table``, keeping its definition (T2): an empty overwrite
    with ``truncate`` issues ``TRUNCATE TABLE`` instead of drop-and-create."""
    empty = spark.read.jdbc(url, table, properties=dict(properties or {})).where(F.lit(False))
    empty.write.mode("overwrite").option("truncate", "true").jdbc(url, table,
                                                                  properties=dict(properties or {}))
