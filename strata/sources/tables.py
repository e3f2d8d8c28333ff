"""Whole-table scans (S3): catalog tables, and JDBC tables read in parallel slices."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Every row and column of catalog table ``name``; no order is promised."""
    return spark.table(name)


SAMPLE_ROWS = 100_000  # values of the cutting column that the driver looks at, at most


def _literal(value: object) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, Decimal, str, date)):
        raise TypeError(f"no slices by values like {value!r}")
    return str(value) if isinstance(value, (int, Decimal)) else "'" + str(value).replace("'", "''") + "'"


def quantile_predicates(column: str, sample: Iterable, num_partitions: int) -> list[str]:
    """Conditions on ``column`` that cut a table into at most ``num_partitions`` slices of about
    equal numbers of rows, by a sample of its values.

    Every row meets exactly one of them, whatever its value: the first takes smaller values and NULLs, the
    last larger ones.  A value with more than one slice's share gets a slice that begins with it, and the
    next value begins another, so it weighs on no other slice."""
    if num_partitions < 1:
        raise ValueError("at least one slice")
    values = sorted(v for v in sample if v is not None)
    share = len(values) / num_partitions
    counts = Counter(values)
    distinct = sorted(counts)
    cuts, held = [], 0
    for value, after in zip(distinct, [*distinct[1:], None]):
        heavy = counts[value] >= share
        if held and (heavy or held + counts[value] / 2 > share) and len(cuts) < num_partitions - 1:
            cuts.append(value)
            held = 0
        held += counts[value]
        if heavy and after is not None and len(cuts) < num_partitions - 1:
            cuts.append(after)
            held = 0
    if not cuts:
        return ["1 = 1"]
    text = [_literal(c) for c in cuts]
    return [f"{column} < {text[0]} OR {column} IS NULL",
            *[f"{column} >= {a} AND {column} < {b}" for a, b in zip(text, text[1:])], f"{column} >= {text[-1]}"]


def read_jdbc_quantiles(spark: SparkSession, url: str, table: str, partition_column: str, *, num_partitions: int = 64,
                        sample_percent: float = 1.0, properties: dict[str, str] | None = None) -> DataFrame:
    """Whole-table JDBC scan cut where the values lie, not where the range is: a skewed key gives even
    slices.  The cuts come from a sample that the database draws (``TABLESAMPLE``), at most
    ``SAMPLE_ROWS`` values; they only shape the slices, every row is read once."""
    props = dict(properties or {})
    sampled = spark.read.jdbc(url, f"(SELECT {partition_column} AS v FROM {table} TABLESAMPLE SYSTEM ({sample_percent}) "
                                   f"LIMIT {SAMPLE_ROWS}) s", properties=props)
    predicates = quantile_predicates(partition_column, [r["v"] for r in sampled.collect()], num_partitions)
    return spark.read.jdbc(url, table, predicates=predicates, properties=props)


def read_jdbc(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
              num_partitions: int = 64, lower_bound: int | None = None,
              upper_bound: int | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """Whole-table JDBC scan split into ``num_partitions`` range slices of equal width (for keys that
    are not spread evenly see :func:`read_jdbc_quantiles`).

    Without a numeric ``partition_column`` the read is one task, which is only sensible for
    small tables.  Missing bounds are fetched with one pushed-down ``min``/``max`` query,
    not by scanning the table in Spark.  The bounds only shape the slices: rows outside
    them still land in the first or last slice, so nothing is lost.
    """
    props = dict(properties or {})
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    if lower_bound is None or upper_bound is None:
        bounds = spark.read.jdbc(
            url,
            f"(SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}) b",
            properties=props,
        ).select(F.col("lo").cast("long"), F.col("hi").cast("long")).first()
        lo, hi = (bounds[0], bounds[1]) if bounds is not None else (None, None)
        if lo is None:
            return spark.read.jdbc(url, table, properties=props)
        lower_bound = lo if lower_bound is None else lower_bound
        upper_bound = hi + 1 if upper_bound is None else upper_bound
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions, properties=props)
