import datetime as dt
from decimal import Decimal

import pytest

from strata.operators import export_csv, write_dataset
from strata.plans.jobs import (JOBS, FlowPaths, bronze_to_gold, run, session_smoke, show_table)
from strata.schemas import REVIEW_LOGS, USER_PURCHASE
from strata.session import scratch_table
from strata.sources import read_dataset

PURCHASES = [
    ("1", "A", "d", 2, dt.datetime(2010, 1, 1), Decimal("1.500"), 7, "UK"),
    ("2", "B", "d", 1, dt.datetime(2010, 1, 2), Decimal("2.000"), 8, "FR"),
]


def test_show_table(spark, tmp_path):
    logs = spark.createDataFrame([(i, dt.datetime(2024, 1, 1), i % 3, "view", float(i))
                                  for i in range(10)], REVIEW_LOGS)
    path = write_dataset(logs, str(tmp_path / "s"), "parquet")
    got = show_table(spark, path, "parquet", "3", order_by=["event_id"])
    assert [r.event_id for r in got.collect()] == [0, 1, 2]
    assert show_table(spark, path, "parquet", 0).count() == 0
    for bad in (-1, "x", "1.5"):
        with pytest.raises(ValueError):
            show_table(spark, path, "parquet", bad)


def test_session_smoke(spark):
    assert tuple(session_smoke(spark).first()) == (1_000_000, True)


def test_run_by_name(spark, tmp_path):
    assert JOBS["crm"] is JOBS["cmr"]
    with pytest.raises(KeyError):
        run(spark, "nope")
    src = export_csv(spark.createDataFrame(PURCHASES, USER_PURCHASE), str(tmp_path / "src"))
    out = run(spark, "up", in_csv=src, out=str(tmp_path / "silver" / "user_purchase"), fmt="orc")
    assert sorted(tuple(r) for r in read_dataset(spark, out, "orc").collect()) == PURCHASES
    assert run(spark, "test").first().ok


def _paths(spark, tmp_path, purchases, checkpoint=None):
    landing = export_csv(purchases, str(tmp_path / "landing"))
    reviews = spark.createDataFrame([(7, 1, "good film"), (9, 2, "bad")],
                                    "customer_id bigint, review_id bigint, review_text string")
    logs = spark.createDataFrame(
        [(1, "<log><ts>2024-01-01 10:00:00</ts><user_id>8</user_id><event_type>view</event_type>"
             "<value>1.0</value></log>")], "event_id bigint, log string")
    return FlowPaths(landing=landing, purchase_table=scratch_table(spark, "flow"),
                     export=str(tmp_path / "export"),
                     movie_review_csv=export_csv(reviews, str(tmp_path / "reviews")),
                     log_reviews_csv=export_csv(logs, str(tmp_path / "logs")),
                     silver_root=str(tmp_path / "silver"), gold_root=str(tmp_path / "gold"),
                     checkpoint=checkpoint)


@pytest.mark.parametrize("on_arrival", [False, True])
def test_bronze_to_gold(spark, tmp_path, on_arrival):
    ckpt = str(tmp_path / "ckpt") if on_arrival else None
    paths = _paths(spark, tmp_path, spark.createDataFrame(PURCHASES, USER_PURCHASE), ckpt)
    result = bronze_to_gold(spark, paths)
    assert result.export_status == "exported" and result.rows_loaded == 2
    gold = {r.customer_id: tuple(r) for r in read_dataset(spark, result.gold, "parquet").collect()}
    assert gold[7] == (7, Decimal("3.000"), 1, 1, 0, None)
    assert gold[8] == (8, Decimal("2.000"), 0, 0, 1, dt.datetime(2024, 1, 1, 10))
    assert gold[9] == (9, Decimal("0.000"), 0, 1, 0, None)


def test_bronze_to_gold_stops_on_empty_table(spark, tmp_path):
    paths = _paths(spark, tmp_path, spark.createDataFrame([], USER_PURCHASE))
    with pytest.raises(RuntimeError):
        bronze_to_gold(spark, paths)


def test_bronze_to_gold_missing_landing(spark, tmp_path):
    paths = _paths(spark, tmp_path, spark.createDataFrame(PURCHASES, USER_PURCHASE))
    paths = FlowPaths(**{**paths.__dict__, "landing": str(tmp_path / "missing")})
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        bronze_to_gold(spark, paths)


def test_cli_parse():
    from strata.__main__ import parse

    assert parse(["up", "in", "out"]) == ("up", {"in_csv": "in", "out": "out"})
    assert parse(["crm", "a", "b", "orc", "--words", "good,great"]) == (
        "crm", {"in_csv": "a", "out": "b", "fmt": "orc", "positive_words": ["good", "great"]})
    assert parse(["show", "s", "t", "parquet", "5", "--order-by", "event_id"])[1]["order_by"] == ["event_id"]
    with pytest.raises(SystemExit):
        parse(["ma", "only_one"])
    with pytest.raises(SystemExit):
        parse(["nope"])


def test_sized_conf(spark, tmp_path):
    from strata.session import input_bytes, sized_conf

    assert sized_conf(0)["spark.sql.shuffle.partitions"] == "8"
    assert sized_conf(10 << 40)["spark.sql.shuffle.partitions"] == str((10 << 40) // (256 << 20))
    assert sized_conf(10 << 50)["spark.sql.shuffle.partitions"] == str((10 << 50) // (256 << 20))
    assert sized_conf(10 << 50, max_partitions=1000)["spark.sql.shuffle.partitions"] == "1000"
    (tmp_path / "f").write_bytes(b"x" * 1000)
    assert input_bytes(spark, [str(tmp_path)]) == 1000


def test_bronze_to_gold_silver_failure_stops_gold(spark, tmp_path):
    import os

    paths = _paths(spark, tmp_path, spark.createDataFrame(PURCHASES, USER_PURCHASE))
    bad_logs = export_csv(spark.createDataFrame([(1, "<log><ts>x</log")], "event_id bigint, log string"),
                          str(tmp_path / "badlogs"))
    paths = FlowPaths(**{**paths.__dict__, "log_reviews_csv": bad_logs})
    with pytest.raises(Exception):
        bronze_to_gold(spark, paths)
    assert not os.path.exists(os.path.join(paths.gold_root, "movie_analytics"))


def test_bronze_to_gold_allow_stale_uses_previous_export(spark, tmp_path):
    paths = _paths(spark, tmp_path, spark.createDataFrame(PURCHASES, USER_PURCHASE))
    bronze_to_gold(spark, paths)
    # the next landing is empty: the table is refreshed to 0 rows and the export is skipped
    export_csv(spark.createDataFrame([], USER_PURCHASE), paths.landing)
    with pytest.raises(RuntimeError):
        bronze_to_gold(spark, paths)
    result = bronze_to_gold(spark, paths, allow_stale=True)
    assert result.rows_loaded == 0 and result.export_status == "skipped"
    gold = {r.customer_id: r.amount_spent for r in read_dataset(spark, result.gold, "parquet").collect()}
    assert gold[7] == Decimal("3.000")  # from the previous export


def test_cli_main_runs_jobs(spark, tmp_path, capsys):
    from strata.__main__ import main

    assert main(["test"]) == 0
    src = export_csv(spark.createDataFrame(PURCHASES, USER_PURCHASE), str(tmp_path / "src"))
    out = str(tmp_path / "silver" / "user_purchase")
    assert main(["up", src, out, "parquet"]) == 0
    assert out in capsys.readouterr().out
    assert sorted(tuple(r) for r in read_dataset(spark, out, "parquet").collect()) == PURCHASES
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"  # sized for a tiny input
    for key in ("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"):
        spark.conf.unset(key)
