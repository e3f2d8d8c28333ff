"""The data work between layers (X1-X4): pure DataFrame -> DataFrame functions.

None of them writes; the jobs in :mod:`strata.plans.jobs` read bronze, call these and
write silver or gold.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.checks import enforce_varchar
from strata.functions.text import (DEFAULT_POSITIVE_WORDS, contains_any, effective_words,
                                   stop_words, tokens, without_stop_words)
from strata.functions.xml import parse_log
from strata.schemas import LOG_XML_FIELDS, USER_PURCHASE, USER_PURCHASE_VARCHAR


def review_logs(raw: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Raw ``(event_id, log)`` rows, ``log`` one XML ``<log>`` element, to typed events.

    Output ``(event_id, ts timestamp_ntz, user_id, event_type, value)``, one row per input
    row.  Row-local: no shuffle.
    """
    parsed = raw.select("event_id", parse_log("log", LOG_XML_FIELDS, mode).alias("x"))
    return parsed.select(
        F.col("event_id").cast("long").alias("event_id"),
        F.col("x.ts").cast(T.TimestampNTZType()).alias("ts"),
        F.col("x.user_id").alias("user_id"),
        F.col("x.event_type").alias("event_type"),
        F.col("x.value").alias("value"),
    )


def classified_review(reviews: DataFrame, positive_words: Iterable[str] = DEFAULT_POSITIVE_WORDS,
                      *, language: str = "english", with_tokens: bool = False) -> DataFrame:
    """Mark each review positive (1) or not (0).

    Tokens are the lower-cased runs of letters and digits of ``review_text``; stop words
    of ``language`` are removed; a review is positive when any remaining token is one of
    ``positive_words``.  NULL text is not positive.  Row-local: no shuffle, no Python.
    """
    stops = stop_words(language) if language else ()
    words = effective_words(positive_words, stops)
    toks = tokens("review_text")
    cols = [
        F.col("customer_id").cast("long").alias("customer_id"),
        F.col("review_id").cast("long").alias("review_id"),
        contains_any(toks, words).cast("int").alias("positive_review"),
    ]
    if with_tokens:
        cols.append(without_stop_words(toks, stops).alias("tokens"))
    return reviews.select(*cols)


def user_purchase(purchases: DataFrame) -> DataFrame:
    """The eight purchase columns in declared order and types, lengths checked.

    One output row per input row: no filter, no de-duplication.
    """
    typed = purchases.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in USER_PURCHASE])
    return enforce_varchar(typed, USER_PURCHASE_VARCHAR)


_AMOUNT = T.DecimalType(19, 3)  # int quantity x decimal(8,3) price


def movie_analytics(purchases: DataFrame, reviews: DataFrame, logs: DataFrame,
                    customers: DataFrame | None = None) -> DataFrame:
    """One row per customer over the three silver datasets.

    ``(customer_id, amount_spent, review_score, review_count, log_count, last_log)`` with
    ``amount_spent = sum(quantity * unit_price)``, ``review_score = sum(positive_review)``;
    a customer missing from an input gets 0 counts and sums and a NULL ``last_log``.
    Customers are those found in any input (plus every key of ``customers`` if given).  Rows
    without a customer belong to no row of the result: one row for all of them would add up
    purchases, reviews and logs that have nothing in common.

    Plan: the inputs are projected to one narrow shape, unioned and grouped once.  That is
    a single shuffle with map-side partial aggregation, so a customer holding a large share
    of the rows sends one partial row per task, and there is no join to fan out or skew.
    """
    null_amount, null_int = F.lit(None).cast(_AMOUNT), F.lit(None).cast("int")
    null_ts = F.lit(None).cast(T.TimestampNTZType())

    def shape(df: DataFrame, key: str, amount, positive, review_flag, log_ts, log_flag) -> DataFrame:
        return df.select(F.col(key).cast("long").alias("customer_id"), amount.alias("amount"),
                         positive.alias("positive"), review_flag.alias("review_flag"),
                         log_ts.alias("log_ts"), log_flag.alias("log_flag"))

    parts = [
        shape(purchases, "customer_id", (F.col("quantity") * F.col("unit_price")).cast(_AMOUNT),
              null_int, null_int, null_ts, null_int),
        shape(reviews, "customer_id", null_amount, F.col("positive_review").cast("int"),
              F.lit(1), null_ts, null_int),
        shape(logs, "user_id", null_amount, null_int, null_int,
              F.col("ts").cast(T.TimestampNTZType()), F.lit(1)),
    ]
    if customers is not None:
        key = "customer_id" if "customer_id" in customers.columns else customers.columns[0]
        parts.append(shape(customers, key, null_amount, null_int, null_int, null_ts, null_int))
    unioned = parts[0]
    for p in parts[1:]:
        unioned = unioned.unionByName(p)
    return unioned.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.coalesce(F.sum("amount"), F.lit(0)).cast(T.DecimalType(38, 3)).alias("amount_spent"),
        F.coalesce(F.sum("positive"), F.lit(0)).cast("long").alias("review_score"),
        F.count("review_flag").alias("review_count"),
        F.count("log_flag").alias("log_count"),
        F.max("log_ts").alias("last_log"),
    )
