import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import (append_load, clear_table, create_if_absent, drop_if_exists,
                              full_refresh_load, has_rows, row_count_gate, table_exists)
from strata.schemas import USER_PURCHASE
from strata.session import scratch_table
from strata.sources import read_csv_typed

HEADER = "invoice_number,stock_code,detail,quantity,invoice_date,unit_price,customer_id,country\n"
ROW = ("1", "A", "d", 1, dt.datetime(2010, 12, 1, 8, 26), Decimal("1.500"), 7, "UK")


def five(spark):
    return spark.createDataFrame([ROW] * 5, USER_PURCHASE)


def test_create_if_absent_twice_keeps_rows_and_varchar(spark):
    t = scratch_table(spark, "t1")
    create_if_absent(spark, t)
    append_load(spark, t, five(spark))
    create_if_absent(spark, t)
    assert spark.table(t).count() == 5
    types = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE {t}").collect()}
    assert types["invoice_number"] == "varchar(10)"
    assert types["unit_price"] == "decimal(8,3)"


def test_clear_and_drop(spark):
    t = scratch_table(spark, "t2")
    create_if_absent(spark, t)
    append_load(spark, t, five(spark))
    clear_table(spark, t)
    assert spark.table(t).count() == 0
    drop_if_exists(spark, t)
    drop_if_exists(spark, t)
    assert not table_exists(spark, t)


def test_row_count_gate(spark):
    t = scratch_table(spark, "t4")
    create_if_absent(spark, t)
    assert tuple(row_count_gate(spark.table(t)).first()) == (0, False)
    assert not has_rows(spark.table(t))
    append_load(spark, t, five(spark))
    assert tuple(row_count_gate(spark.table(t)).first()) == (5, True)
    assert has_rows(spark.table(t))


def test_append_twice_doubles_refresh_twice_does_not(spark, write_text):
    t = scratch_table(spark, "t5")
    create_if_absent(spark, t)
    append_load(spark, t, five(spark))
    append_load(spark, t, five(spark))
    assert spark.table(t).count() == 10
    src = write_text(HEADER + "1,A,d,1,2010-12-01 08:26:00,1.5,7,UK\n" * 3)
    assert full_refresh_load(spark, t, read_csv_typed(spark, src)) == 3
    assert full_refresh_load(spark, t, read_csv_typed(spark, src)) == 3
    assert spark.table(t).count() == 3


@pytest.mark.parametrize("bad_line", [
    "1,A,d,zz,2010-12-01 08:26:00,1.5,7,UK",            # bad int
    "12345678901,A,d,1,2010-12-01 08:26:00,1.5,7,UK",   # over-long VARCHAR(10)
])
def test_failed_refresh_keeps_old_rows(spark, write_text, bad_line):
    t = scratch_table(spark, "t6")
    create_if_absent(spark, t)
    append_load(spark, t, five(spark))
    src = write_text(HEADER + "2,B,e,2,2010-12-02 00:00:00,2.5,8,FR\n" + bad_line + "\n")
    with pytest.raises(Exception):
        full_refresh_load(spark, t, read_csv_typed(spark, src))
    assert spark.table(t).count() == 5
    db, base = t.split(".")
    left = [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()
            if r.tableName.startswith(base + "__")]
    assert left == []  # no stage or old table left behind


def test_table_varchar_enforced_on_insert(spark):
    t = scratch_table(spark, "tv")
    create_if_absent(spark, t)
    long_row = ("x" * 11,) + ROW[1:]
    with pytest.raises(Exception):
        append_load(spark, t, spark.createDataFrame([long_row], USER_PURCHASE))
    assert spark.table(t).count() == 0


def test_quoted_names():
    from strata.operators.tables import quoted

    assert quoted("db.t") == "`db`.`t`"
    assert quoted("we`ird") == "`we``ird`"
    for bad in ("", "a..b", "a.b.c.d"):
        with pytest.raises(ValueError):
            quoted(bad)


def test_name_is_not_sql(spark):
    keep = scratch_table(spark, "keep")
    create_if_absent(spark, keep)
    db = keep.split(".")[0]
    for name in (f"{db}.x; DROP TABLE {keep}", f"x; DROP TABLE {db}"):
        try:
            drop_if_exists(spark, name)  # an odd identifier: dropped if it exists, or rejected
        except Exception:  # noqa: BLE001
            pass
    assert table_exists(spark, keep)


def test_refresh_from_the_table_itself(spark):
    t = scratch_table(spark, "self")
    create_if_absent(spark, t)
    append_load(spark, t, five(spark))
    append_load(spark, t, five(spark).withColumn("invoice_number", F.lit("2")))
    assert full_refresh_load(spark, t, spark.table(t).where(F.col("invoice_number") == "2")) == 5
    assert {r.invoice_number for r in spark.table(t).collect()} == {"2"}
