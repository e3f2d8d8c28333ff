import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest

from strata.functions.text import stop_words
from strata.operators import classified_review, movie_analytics, review_logs, user_purchase
from strata.schemas import CLASSIFIED_REVIEW, REVIEW_LOGS, USER_PURCHASE

LOG = "<log><ts>2024-01-01 00:00:07.179575</ts><user_id>8</user_id><event_type>error</event_type><value>6.55</value></log>"


def test_review_logs_parse(spark):
    raw = spark.createDataFrame([(1, LOG), (2, None)], "event_id bigint, log string")
    got = {r.event_id: tuple(r) for r in review_logs(raw).collect()}
    assert got[1] == (1, dt.datetime(2024, 1, 1, 0, 0, 7, 179575), 8, "error", 6.55)
    assert got[2] == (2, None, None, None, None)
    assert [(f.name, f.dataType) for f in review_logs(raw).schema] == [(f.name, f.dataType) for f in REVIEW_LOGS]


def test_review_logs_malformed(spark):
    raw = spark.createDataFrame([(1, "<log><ts>x</log")], "event_id bigint, log string")
    with pytest.raises(Exception):
        review_logs(raw).collect()
    assert review_logs(raw, mode="PERMISSIVE").first()["user_id"] is None


def test_review_logs_zone_independent(spark):
    raw = spark.createDataFrame([(1, LOG)], "event_id bigint, log string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert review_logs(raw).first()["ts"] == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_classified_review(spark):
    reviews = spark.createDataFrame([
        (1, 1, "A GOOD film."), (1, 2, "good,bad"), (2, 3, None), (3, 4, "the and the"),
        (4, 5, "goodness"), (5, 6, "Très bien"),
    ], "customer_id bigint, review_id bigint, review_text string")
    out = classified_review(reviews, ["good", "the", "bien"])
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in CLASSIFIED_REVIEW]
    got = {r.review_id: r.positive_review for r in out.collect()}
    # "the" is an English stop word, so it never counts
    assert got == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0, 6: 1}


def test_classified_review_tokens(spark):
    assert "the" in stop_words()
    reviews = spark.createDataFrame([(1, 1, "The café, the CAFÉ!")],
                                    "customer_id bigint, review_id bigint, review_text string")
    row = classified_review(reviews, ["café"], with_tokens=True).first()
    assert row.tokens == ["café", "café"] and row.positive_review == 1


def test_user_purchase_types(spark):
    df = spark.createDataFrame([("1", "A", "d", "3", "2010-12-01 08:26:00", "1.5", "7", "UK")],
                               ",".join(f"{f.name} string" for f in USER_PURCHASE))
    out = user_purchase(df)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in USER_PURCHASE]
    assert out.first()["unit_price"] == Decimal("1.500")


def _inputs(spark):
    purchases = spark.createDataFrame([
        ("1", "A", "d", 2, dt.datetime(2010, 1, 1), Decimal("1.500"), 7, "UK"),
        ("2", "B", "d", 1, dt.datetime(2010, 1, 1), Decimal("10.000"), 7, "UK"),
        ("3", "C", "d", 1, dt.datetime(2010, 1, 1), Decimal("2.000"), 9, "UK"),
    ], USER_PURCHASE)
    reviews = spark.createDataFrame([(7, 1, 1), (7, 2, 0), (7, 3, 1), (8, 4, 1)], CLASSIFIED_REVIEW)
    logs = spark.createDataFrame([
        (1, dt.datetime(2024, 1, 1), 7, "view", 1.0), (2, dt.datetime(2024, 1, 3), 7, "view", 1.0),
        (3, dt.datetime(2024, 1, 2), 7, "view", 1.0), (4, dt.datetime(2024, 1, 2), 7, "view", 1.0),
    ], REVIEW_LOGS)
    return purchases, reviews, logs


def test_movie_analytics_no_fan_out(spark):
    got = {r.customer_id: tuple(r) for r in movie_analytics(*_inputs(spark)).collect()}
    assert got[7] == (7, Decimal("13.000"), 2, 3, 4, dt.datetime(2024, 1, 3))
    assert got[8] == (8, Decimal("0.000"), 1, 1, 0, None)
    assert got[9] == (9, Decimal("2.000"), 0, 0, 0, None)
    assert len(got) == 3


def test_movie_analytics_with_customer_list(spark):
    customers = spark.createDataFrame([(7,), (10,)], "customer_id bigint")
    got = {r.customer_id: tuple(r) for r in movie_analytics(*_inputs(spark), customers=customers).collect()}
    assert got[10] == (10, Decimal("0.000"), 0, 0, 0, None)
    assert len(got) == 4


def test_movie_analytics_hot_customer_against_brute_force(spark):
    # one customer holds about a third of all rows of every input
    n = 3000
    cust = [0 if i % 3 == 0 else i % 97 for i in range(n)]
    pur = pd.DataFrame({"invoice_number": [str(i) for i in range(n)], "stock_code": "s", "detail": "d",
                        "quantity": [i % 5 for i in range(n)],
                        "invoice_date": pd.Timestamp("2010-01-01"),
                        "unit_price": [Decimal(i % 11) / 4 for i in range(n)],
                        "customer_id": cust, "country": "UK"})
    rev = pd.DataFrame({"customer_id": cust, "review_id": range(n), "positive_review": [i % 2 for i in range(n)]})
    logs = pd.DataFrame({"event_id": range(n), "ts": pd.date_range("2024-01-01", periods=n, freq="min"),
                         "user_id": cust, "event_type": "view", "value": 1.0})
    out = movie_analytics(spark.createDataFrame(pur, USER_PURCHASE).repartition(8),
                          spark.createDataFrame(rev, CLASSIFIED_REVIEW).repartition(8),
                          spark.createDataFrame(logs, REVIEW_LOGS).repartition(8)).toPandas()
    pur["amt"] = [q * p for q, p in zip(pur.quantity, pur.unit_price)]
    exp_amt = pur.groupby("customer_id").amt.sum()
    exp_score = rev.groupby("customer_id").positive_review.sum()
    exp_logs = logs.groupby("user_id").ts.agg(["count", "max"])
    out = out.set_index("customer_id")
    assert len(out) == 97
    for c in out.index:
        assert out.loc[c, "amount_spent"] == exp_amt[c]
        assert out.loc[c, "review_score"] == exp_score[c]
        assert out.loc[c, "log_count"] == exp_logs.loc[c, "count"]
        assert out.loc[c, "last_log"] == exp_logs.loc[c, "max"]


def test_movie_analytics_single_shuffle(spark):
    plan = movie_analytics(*_inputs(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_user_purchase_zone_independent(spark, tmp_path):
    from strata.operators import export_csv
    from strata.sources import read_csv_typed

    row = ("1", "A", "d", 1, dt.datetime(2010, 3, 28, 1, 30), Decimal("1.500"), 7, "UK")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/London")  # 01:30 is in a DST gap
        path = export_csv(spark.createDataFrame([row], USER_PURCHASE), str(tmp_path / "z"))
        assert tuple(user_purchase(read_csv_typed(spark, path)).first()) == row
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_movie_analytics_leaves_out_rows_without_a_customer(spark):
    purchases, reviews, logs = _inputs(spark)
    nobody = (spark.createDataFrame([("9", "Z", "d", 1, dt.datetime(2010, 1, 1), Decimal("5.000"), None, "UK")], USER_PURCHASE),
              spark.createDataFrame([(None, 9, 1)], CLASSIFIED_REVIEW),
              spark.createDataFrame([(9, dt.datetime(2024, 1, 1), None, "view", 1.0)], REVIEW_LOGS))
    more = movie_analytics(purchases.union(nobody[0]), reviews.union(nobody[1]), logs.union(nobody[2]))
    assert sorted(more.collect()) == sorted(movie_analytics(purchases, reviews, logs).collect())
