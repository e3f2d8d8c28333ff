import datetime as dt
from decimal import Decimal

from strata.operators import export_csv
from strata.schemas import USER_PURCHASE
from strata.session import scratch_table
from strata.streaming import arrival_load

ROW = ("1", "A", "d", 1, dt.datetime(2010, 12, 1, 8, 26), Decimal("1.500"), 7, "UK")


def test_arrival_refresh_runs_once(spark, tmp_path):
    landing = export_csv(spark.createDataFrame([ROW] * 4, USER_PURCHASE), str(tmp_path / "landing"))
    t = scratch_table(spark, "arr")
    ckpt = str(tmp_path / "ckpt")
    first = arrival_load(spark, landing, t, ckpt)
    second = arrival_load(spark, landing, t, ckpt)
    assert len(first.batches) == 1 and first.rows == 4
    assert second.batches == []
    assert spark.table(t).count() == 4


def test_arrival_append_new_files(spark, tmp_path):
    landing = tmp_path / "landing"
    export_csv(spark.createDataFrame([ROW] * 2, USER_PURCHASE), str(landing / "a"))
    t = scratch_table(spark, "arr2")
    ckpt = str(tmp_path / "ckpt")
    arrival_load(spark, str(landing / "*"), t, ckpt, mode="append")
    export_csv(spark.createDataFrame([ROW] * 3, USER_PURCHASE), str(landing / "b"))
    res = arrival_load(spark, str(landing / "*"), t, ckpt, mode="append")
    assert len(res.batches) == 1
    assert spark.table(t).count() == 5


def test_arrival_archives_processed_files(spark, tmp_path):
    import os

    landing = tmp_path / "landing"
    export_csv(spark.createDataFrame([ROW] * 3, USER_PURCHASE), str(landing / "a"))
    first = {f for f in os.listdir(landing / "a") if f.endswith(".csv")}
    t = scratch_table(spark, "arr3")
    archive = str(tmp_path / "archive")
    ckpt = str(tmp_path / "ckpt")
    assert arrival_load(spark, str(landing / "*"), t, ckpt, mode="append", archive_dir=archive).batches
    # Spark archives a batch's files when it commits the following batch.
    export_csv(spark.createDataFrame([ROW] * 2, USER_PURCHASE), str(landing / "b"))
    assert arrival_load(spark, str(landing / "*"), t, ckpt, mode="append", archive_dir=archive).batches
    left = {f for f in os.listdir(landing / "a") if f.endswith(".csv")}
    archived = {f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".csv")}
    assert first and not (first & left) and first <= archived


def test_arrival_refresh_sees_a_replaced_object(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    header = "invoice_number,stock_code,detail,quantity,invoice_date,unit_price,customer_id,country\n"
    line = "{},A,d,1,2010-12-01 08:26:00,1.5,7,UK\n"
    t, ckpt = scratch_table(spark, "arr7"), str(tmp_path / "ckpt")
    (landing / "user_purchase.csv").write_text(header + line.format(1))
    assert arrival_load(spark, str(landing), t, ckpt).rows == 1
    (landing / "user_purchase.csv").write_text(header + line.format(22) + line.format(33))
    assert arrival_load(spark, str(landing), t, ckpt).rows == 2
    assert sorted(r[0] for r in spark.table(t).collect()) == ["22", "33"]
    (landing / "late.csv").write_text(header + line.format(4))  # a second part: both stay
    assert arrival_load(spark, str(landing), t, ckpt).rows == 3
    assert arrival_load(spark, str(landing), t, ckpt).batches == []


def test_arrival_append_in_bounded_batches(spark, tmp_path):
    import pytest

    landing = tmp_path / "landing"
    for i in range(3):
        export_csv(spark.createDataFrame([ROW] * (i + 1), USER_PURCHASE), str(landing / f"d{i}"))
    files = [f for _, _, fs in __import__("os").walk(landing) for f in fs if f.endswith(".csv")]
    t = scratch_table(spark, "arr4")
    res = arrival_load(spark, str(landing / "*"), t, str(tmp_path / "ckpt"), mode="append",
                       max_files_per_trigger=1)
    assert len(res.batches) == len(files) and spark.table(t).count() == 6
    with pytest.raises(ValueError):
        arrival_load(spark, str(landing / "*"), t, str(tmp_path / "ckpt2"), max_files_per_trigger=1)


def test_arrival_bad_row_fails_and_keeps_rows(spark, tmp_path):
    import pytest

    landing = tmp_path / "landing"
    export_csv(spark.createDataFrame([ROW] * 2, USER_PURCHASE), str(landing / "a"))
    t = scratch_table(spark, "arr5")
    ckpt = str(tmp_path / "ckpt")
    assert arrival_load(spark, str(landing / "*"), t, ckpt).rows == 2
    bad = landing / "b"
    bad.mkdir()
    (bad / "bad.csv").write_text(
        "invoice_number,stock_code,detail,quantity,invoice_date,unit_price,customer_id,country\n"
        "1,A,d,zz,2010-12-01 08:26:00,1.5,7,UK\n")
    with pytest.raises(Exception):
        arrival_load(spark, str(landing / "*"), t, ckpt)
    assert spark.table(t).count() == 2


def test_arrival_large_single_file(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    header = "invoice_number,stock_code,detail,quantity,invoice_date,unit_price,customer_id,country\n"
    (landing / "one.csv").write_text(header + "1,A,d,1,2010-12-01 08:26:00,1.5,7,UK\n" * 200_000)
    t = scratch_table(spark, "arr6")
    res = arrival_load(spark, str(landing), t, str(tmp_path / "ckpt"))
    assert res.rows == 200_000 and spark.table(t).count() == 200_000
