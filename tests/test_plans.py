"""Plan-shape checks: the scale properties the design relies on."""

import contextlib
import io

from strata.operators import classified_review, review_logs, user_purchase
from strata.plans import inputs
from strata.schemas import LOG_REVIEW, MOVIE_REVIEW, USER_PURCHASE

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(df) -> str:
    return plan(df).split("\n\n\n")[0]


def test_row_local_transforms_have_no_exchange(spark, tmp_path):
    reviews = spark.read.schema(MOVIE_REVIEW).csv(str(tmp_path))
    logs = spark.read.schema(LOG_REVIEW).csv(str(tmp_path))
    purchases = spark.read.schema(USER_PURCHASE).csv(str(tmp_path))
    for df in (classified_review(reviews, ["good"]), review_logs(logs), user_purchase(purchases)):
        assert "Exchange" not in tree(df)


def test_classification_stays_in_codegen(spark, tmp_path):
    reviews = spark.read.schema(MOVIE_REVIEW).csv(str(tmp_path))
    t = tree(classified_review(reviews, ["good"]))
    assert "* Project" in t  # whole-stage codegen marks the projection with '*'


def test_scans_prune_columns(spark):
    p = plan(inputs.reviews(spark, SF))
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint,text:string>" in p
    p = plan(inputs.purchases(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in p


def test_purchase_input_at_scale_shuffles_lineitem_twice(spark):
    # planning only (nothing runs): sf0.1 files are large enough that only nation stays
    # under a 16 KB threshold, as only nation and region do at any real scale
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(16 << 10))
    try:
        t = tree(inputs.purchases(spark, "/root/testdata/sf0.1"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = t.count("Exchange") - t.count("BroadcastExchange")
    # lineitem, orders, customer, the order side, the lineitem side, part
    assert shuffles == 6
    assert t.count("BroadcastExchange") == 1  # nation: 25 rows at every scale factor
