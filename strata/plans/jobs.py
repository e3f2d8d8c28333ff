"""Jobs runnable by name (P2), the show and smoke jobs (X5, X6), and the whole
bronze-to-gold flow (P1).

Each job reads its inputs, calls a pure transform and writes its output; between jobs the
only hand-over is the files they write, so any job can be re-run alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.text import DEFAULT_POSITIVE_WORDS
from strata.operators.sinks import guarded_export, write_dataset
from strata.operators.tables import create_if_absent, full_refresh_load
from strata.operators.transforms import (classified_review, movie_analytics, review_logs,
                                         user_purchase)
from strata.schemas import (CLASSIFIED_REVIEW, REVIEW_LOGS, USER_PURCHASE, USER_PURCHASE_DDL,
                            USER_PURCHASE_VARCHAR)
from strata.sources.csv import naming_bad_csv_record, read_bronze_csv, read_csv_typed
from strata.sources.datasets import read_dataset
from strata.streaming.arrival import arrival_load

# Silver dataset names under a silver root, and the gold dataset name under a gold root.
SILVER_REVIEW_LOGS = "review_logs"
SILVER_CLASSIFIED_REVIEW = "classified_movie_review"
SILVER_USER_PURCHASE = "user_purchase"
GOLD_MOVIE_ANALYTICS = "movie_analytics"

SILVER_SCHEMAS = {
    SILVER_REVIEW_LOGS: REVIEW_LOGS,
    SILVER_CLASSIFIED_REVIEW: CLASSIFIED_REVIEW,
    SILVER_USER_PURCHASE: USER_PURCHASE,
}


def _non_negative_int(n) -> int:
    try:
        value = int(str(n).strip())
    except ValueError:
        raise ValueError(f"number of records must be a non-negative integer, got {n!r}") from None
    if value < 0:
        raise ValueError(f"number of records must be a non-negative integer, got {n!r}")
    return value


def show_table(spark: SparkSession, path: str, fmt: str = "parquet", n_records: int | str = 20,
               order_by: Iterable[str] | None = None, schema: T.StructType | None = None,
               *, print_rows: bool = False) -> DataFrame:
    """The first ``n_records`` rows of the dataset at ``path``.

    Which rows are "first" is only defined with ``order_by``; Spark then keeps the top rows
    per task and merges them, so only ``n`` rows per task ever move.
    """
    n = _non_negative_int(n_records)
    df = read_dataset(spark, path, fmt, schema)
    if order_by:
        df = df.orderBy(*order_by)
    out = df.limit(n)
    if print_rows:
        out.show(n, truncate=False)
    return out


def session_smoke(spark: SparkSession, source: DataFrame | None = None) -> DataFrame:
    """Prove the session runs a distributed job (X6): one row ``(row_count, ok)``."""
    df = source if source is not None else spark.range(1_000_000)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(True).alias("ok"))


# --- the single-purpose jobs ---

def review_logs_job(spark: SparkSession, in_csv: str, out: str, fmt: str = "parquet") -> str:
    return write_dataset(review_logs(read_bronze_csv(spark, in_csv, "log_review")), out, fmt)


def classified_review_job(spark: SparkSession, in_csv: str, out: str, fmt: str = "parquet",
                          positive_words: Iterable[str] = DEFAULT_POSITIVE_WORDS) -> str:
    reviews = read_bronze_csv(spark, in_csv, "movie_review")
    return write_dataset(classified_review(reviews, positive_words), out, fmt)


def user_purchase_job(spark: SparkSession, in_csv: str, out: str, fmt: str = "parquet") -> str:
    with naming_bad_csv_record(spark, in_csv, USER_PURCHASE):
        return write_dataset(user_purchase(read_csv_typed(spark, in_csv, USER_PURCHASE)), out, fmt,
                             varchar_limits=USER_PURCHASE_VARCHAR)


def read_silver(spark: SparkSession, silver_root: str, name: str, fmt: str = "parquet") -> DataFrame:
    return read_dataset(spark, f"{silver_root.rstrip('/')}/{name}", fmt, SILVER_SCHEMAS[name])


def movie_analytics_job(spark: SparkSession, silver_root: str, gold_root: str,
                        fmt: str = "parquet") -> str:
    gold = movie_analytics(read_silver(spark, silver_root, SILVER_USER_PURCHASE, fmt),
                           read_silver(spark, silver_root, SILVER_CLASSIFIED_REVIEW, fmt),
                           read_silver(spark, silver_root, SILVER_REVIEW_LOGS, fmt))
    return write_dataset(gold, f"{gold_root.rstrip('/')}/{GOLD_MOVIE_ANALYTICS}", fmt)


def test_job(spark: SparkSession) -> DataFrame:
    return session_smoke(spark)


def show_job(spark: SparkSession, silver_root: str, table_name: str, fmt: str = "parquet",
             n_records: int | str = 20, order_by: Iterable[str] | None = None) -> DataFrame:
    return show_table(spark, f"{silver_root.rstrip('/')}/{table_name}", fmt, n_records, order_by,
                      SILVER_SCHEMAS.get(table_name), print_rows=True)


# Job names; "crm" and "cmr" both name the classified-review job.
JOBS: dict[str, Callable[..., object]] = {
    "test": test_job,
    "show": show_job,
    "rl": review_logs_job,
    "crm": classified_review_job,
    "cmr": classified_review_job,
    "up": user_purchase_job,
    "ma": movie_analytics_job,
}


def run(spark: SparkSession, name: str, **params):
    """Run job ``name`` with its own parameters only; an unknown name is a ``KeyError``."""
    if name not in JOBS:
        raise KeyError(f"unknown job {name!r}; expected one of {sorted(JOBS)}")
    return JOBS[name](spark, **params)


# --- the whole flow ---

@dataclass(frozen=True)
class FlowPaths:
    landing: str            # folder the purchase CSV lands in
    purchase_table: str     # catalog table the purchases are loaded into
    export: str             # folder the table is exported to as CSV
    movie_review_csv: str   # raw reviews
    log_reviews_csv: str    # raw review logs
    silver_root: str
    gold_root: str
    checkpoint: str | None = None  # set: load on arrival (streaming); unset: batch load


@dataclass(frozen=True)
class FlowResult:
    rows_loaded: int
    export_status: str
    silver: dict[str, str]
    gold: str


def bronze_to_gold(spark: SparkSession, paths: FlowPaths, fmt: str = "parquet",
                   positive_words: Iterable[str] = DEFAULT_POSITIVE_WORDS,
                   allow_stale: bool = False, concurrent_silver: bool = True) -> FlowResult:
    """Load, export, transform to silver and aggregate to gold, in that order.

    1. load the landed purchase CSV into the purchase table by full refresh (on arrival when
       ``paths.checkpoint`` is set); a missing landing folder fails with ``PATH_NOT_FOUND``;
    2. export the table to CSV unless it is empty; an empty table stops the flow unless
       ``allow_stale`` (then the previous export, if any, is used);
    3. review logs, classified reviews and user purchases to silver, then the gold
       per-customer analytics from the three silver datasets.  The three silver jobs do not
       depend on each other; with ``concurrent_silver`` they are submitted together from
       driver threads, so the executors one job leaves idle in its tail serve the others.

    Any failure raises and stops the later steps (gold is not built).
    """
    create_if_absent(spark, paths.purchase_table, USER_PURCHASE_DDL)
    if paths.checkpoint:
        rows = arrival_load(spark, paths.landing, paths.purchase_table, paths.checkpoint).rows
    else:
        rows = full_refresh_load(spark, paths.purchase_table, read_csv_typed(spark, paths.landing))
    exported = guarded_export(spark.table(paths.purchase_table), paths.export)
    if exported.status == "skipped" and not allow_stale:
        raise RuntimeError(f"{paths.purchase_table} is empty: export skipped, flow stopped")
    root = paths.silver_root.rstrip("/")
    words = list(positive_words)
    steps = {
        SILVER_REVIEW_LOGS: lambda: review_logs_job(
            spark, paths.log_reviews_csv, f"{root}/{SILVER_REVIEW_LOGS}", fmt),
        SILVER_CLASSIFIED_REVIEW: lambda: classified_review_job(
            spark, paths.movie_review_csv, f"{root}/{SILVER_CLASSIFIED_REVIEW}", fmt, words),
        SILVER_USER_PURCHASE: lambda: user_purchase_job(
            spark, paths.export, f"{root}/{SILVER_USER_PURCHASE}", fmt),
    }
    if concurrent_silver:
        with ThreadPoolExecutor(max_workers=len(steps), thread_name_prefix="silver") as pool:
            futures = {name: pool.submit(step) for name, step in steps.items()}
        silver = {name: f.result() for name, f in futures.items()}  # re-raises a failure
    else:
        silver = {name: step() for name, step in steps.items()}
    gold = movie_analytics_job(spark, root, paths.gold_root, fmt)
    return FlowResult(rows, exported.status, silver, gold)
