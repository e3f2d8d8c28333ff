"""Ledger tables: loads that are visible whole or not at all, and batches that count once."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from strata.operators.ledger import LedgerTable
from strata.operators.sinks import export_csv, guarded_export, write_dataset
from strata.operators.tables import append_load, create_if_absent, drop_if_exists, full_refresh_load
from strata.schemas import USER_PURCHASE, USER_PURCHASE_VARCHAR
from strata.session import scratch_table
from strata.sources.datasets import read_dataset
from strata.streaming.arrival import arrival_load, stream_id


class Crash(Exception):
    pass


def crash(*args, **kwargs):
    raise Crash()


def table_at(spark, path, **options):
    return LedgerTable(spark, str(path), **options)


def numbers(spark, first, last, parts=3):
    return spark.range(first, last, 1, parts).select(F.col("id").alias("n"), F.col("id").cast("string").alias("s"))


@pytest.fixture
def table(spark, tmp_path):
    t = table_at(spark, tmp_path / "t", retain_seconds=0)
    t.create(numbers(spark, 0, 1).schema, {"s": 5})
    return t


def content(t, version=None):
    return sorted(r["n"] for r in t.read(version).collect())


def folders(t):
    return sorted(n for n in os.listdir(t.path) if n.startswith("data-"))


def test_append_counts_once_when_a_load_dies_before_its_entry(spark, table, monkeypatch):
    table.append(numbers(spark, 0, 10), "w", 0)
    with monkeypatch.context() as m:
        m.setattr(LedgerTable, "_put_if_absent", crash)  # killed between write and commit
        with pytest.raises(Crash):
            table.append(numbers(spark, 10, 15), "w", 1)
    assert content(table) == list(range(10)) and len(folders(table)) == 2
    again = table_at(spark, table.path, retain_seconds=0)  # a new driver
    assert again.append(numbers(spark, 10, 15), "w", 1).rows == 5
    assert content(again) == list(range(15)) and again.rows() == 15
    again.recover()
    assert folders(again) == sorted(again.entry().folders)


def test_append_counts_once_when_a_load_dies_after_its_entry(spark, table, monkeypatch):
    put = LedgerTable._put_if_absent
    with monkeypatch.context() as m:
        m.setattr(LedgerTable, "_put_if_absent", lambda *a: (put(*a), crash()))
        with pytest.raises(Crash):
            table.append(numbers(spark, 0, 4), "w", 7)
    done = table.append(numbers(spark, 0, 4), "w", 7)
    assert (done.applied, done.rows) == (False, 0) and content(table) == [0, 1, 2, 3]
    assert not table.append(numbers(spark, 0, 4), "w", 3).applied  # an earlier batch of the writer
    assert table.append(numbers(spark, 0, 4), "other", 7).applied  # batches are numbered by writer
    assert table.append(numbers(spark, 9, 10)).applied and table.append(numbers(spark, 9, 10)).applied
    with pytest.raises(ValueError):
        table.append(numbers(spark, 0, 1), writer="w")


def test_racing_loads_both_land_and_a_racing_batch_lands_once(spark, table, monkeypatch):
    other = table_at(spark, table.path, retain_seconds=0)
    put, state = LedgerTable._put_if_absent, {"raced": False}

    def racing(self, path, text):
        if not state["raced"]:
            state["raced"] = True
            other.append(numbers(spark, 100, 103), "b", 0)
        return put(self, path, text)

    with monkeypatch.context() as m:
        m.setattr(LedgerTable, "_put_if_absent", racing)
        table.append(numbers(spark, 0, 3), "a", 0)
        state["raced"] = False
        m.setattr(other, "append", lambda rows, *a: LedgerTable.append(other, numbers(spark, 3, 5), "a", 1))
        assert not table.append(numbers(spark, 3, 5), "a", 1).applied  # the other one's copy counts
    assert content(table) == [0, 1, 2, 3, 4, 100, 101, 102]
    assert [e.version for e in table.history()] == [0, 1, 2, 3]


@pytest.mark.parametrize("step", ["_stage", "_put_if_absent", "recover"])
def test_refresh_leaves_old_or_new_rows_wherever_it_dies(spark, table, monkeypatch, step):
    table.refresh(numbers(spark, 0, 5))
    with monkeypatch.context() as m:
        m.setattr(LedgerTable, step, crash)
        with pytest.raises(Crash):
            table.refresh(numbers(spark, 50, 60))
    assert content(table) == (list(range(50, 60)) if step == "recover" else list(range(5)))
    table.refresh(numbers(spark, 70, 72))
    assert content(table) == [70, 71]
    table.recover()
    assert folders(table) == sorted(table.entry().folders)


def test_bad_rows_leave_the_table_as_it_was(spark, table):
    table.append(numbers(spark, 0, 2))
    with pytest.raises(Exception, match="too long"):
        table.append(numbers(spark, 0, 2).withColumn("s", F.lit("123456")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        table.refresh(numbers(spark, 0, 2).withColumn("n", F.lit("x")))
    with pytest.raises(ValueError):
        table.append(numbers(spark, 0, 2).select("n"))
    assert content(table) == [0, 1] and folders(table) == sorted(table.entry().folders)


def test_a_reader_never_sees_a_missing_or_mixed_table(spark, tmp_path):
    t = table_at(spark, tmp_path / "t")
    t.create(numbers(spark, 0, 1).schema)
    t.refresh(numbers(spark, 0, 50))
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(table_at(spark, t.path).read().agg(F.count("*"), F.min("n"), F.max("n")).first()))
            except Exception as exc:  # noqa: BLE001 - what a reader saw
                seen.append(exc)

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 21):
        t.refresh(numbers(spark, i * 1000, i * 1000 + 50))
    stop.set()
    reader.join()
    assert len(seen) > 3 and all(isinstance(s, tuple) and s[0] == 50 and s[2] == s[1] + 49 for s in seen), seen


def test_versions_clear_compact_and_drop(spark, tmp_path):
    t = table_at(spark, tmp_path / "t")
    assert not t.exists()
    with pytest.raises(FileNotFoundError):
        t.append(numbers(spark, 0, 1))
    t.create(numbers(spark, 0, 1).schema)
    assert content(t) == [] and t.rows() == 0
    t.create(numbers(spark, 0, 1).select("n").schema)  # present: a no-op
    for i in range(3):
        t.append(numbers(spark, 10 * i, 10 * i + 2), "w", i)
    assert t.compact().applied and len(t.entry().folders) == 1
    assert not t.append(numbers(spark, 0, 1), "w", 2).applied  # compaction keeps what was loaded
    assert content(t) == content(t, 3) == [0, 1, 10, 11, 20, 21]
    t.clear()
    assert content(t) == [] and content(t, 2) == [0, 1, 10, 11]
    with pytest.raises(FileNotFoundError):
        t.read(99)
    t.drop()
    t.drop()
    assert not t.exists()


def test_recover_keeps_what_readers_and_writers_may_use(spark, tmp_path):
    t = table_at(spark, tmp_path / "t", retain_seconds=3600)
    t.create(numbers(spark, 0, 1).schema)
    t.refresh(numbers(spark, 0, 3))
    staged = t.stage(numbers(spark, 5, 6))
    t.refresh(numbers(spark, 1, 4))
    assert t.recover() == [] and content(t, 1) == [0, 1, 2]
    assert t.publish(staged).rows == 1 and content(t) == [1, 2, 3, 5]
    t.retain_seconds = 0
    t.recover()
    assert len(t.history()) == 1 and content(t) == [1, 2, 3, 5]


CSV = ("invoice_number,stock_code,detail,quantity,invoice_date,unit_price,customer_id,country\n"
       "1,a,\"x, y\",2,2010-12-01 08:26:00,1.5,7,Spain\n2,b,,3,2010-12-01 08:26:00,2.5,,\n")


def test_arrivals_are_appended_exactly_once(spark, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "ckpt")
    landing.mkdir()
    (landing / "a.csv").write_text(CSV)
    t = table_at(spark, tmp_path / "t")
    dying = table_at(spark, t.path)
    dying.append = lambda *a: (LedgerTable.append(dying, *a), crash())  # dies before the stream notes the batch
    with pytest.raises(Exception, match="Crash"):
        arrival_load(spark, str(landing), dying, checkpoint, mode="append")
    assert t.rows() == 2 and t.entry().varchar == USER_PURCHASE_VARCHAR
    again = arrival_load(spark, str(landing), t, checkpoint, mode="append")
    assert (again.batches, again.rows) == ([0], 0)
    (landing / "b.csv").write_text(CSV)
    more = arrival_load(spark, str(landing), t, checkpoint, mode="append")
    assert (more.batches, more.rows, t.rows()) == ([1], 2, 4)
    assert t.read().count() == 4 and t.entry().batches == {stream_id(spark, checkpoint): 1}
    refreshed = arrival_load(spark, str(landing), t, str(tmp_path / "ckpt2"))
    assert refreshed.rows == 4 and t.rows() == 4


def test_loads_report_the_rows_their_write_counted(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(CSV)
    name = scratch_table(spark, "counted")
    loaded = arrival_load(spark, str(landing), name, str(tmp_path / "ckpt"), mode="append")
    assert loaded.rows == 2
    rows = spark.table(name)
    other = scratch_table(spark, "counted")
    create_if_absent(spark, other)
    assert append_load(spark, other, rows) == 2 and full_refresh_load(spark, other, rows) == 2
    assert append_load(spark, other, rows.where("false")) == 0 and spark.table(other).count() == 2
    for n in (name, other):
        drop_if_exists(spark, n)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_atomic_datasets_and_exports(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    one = spark.createDataFrame([(1, "a\nb"), (2, ""), (3, None)], "n int, s string")
    write_dataset(one, path, fmt, atomic=True)
    assert sorted(read_dataset(spark, path, fmt).collect(), key=str) == sorted(one.collect(), key=str)
    two = spark.createDataFrame([(4.5,)], "other double")
    if fmt == "csv":
        export_csv(two, path, atomic=True)
        assert guarded_export(two.where("false"), path, atomic=True).status == "skipped"
    else:
        write_dataset(two, path, fmt, atomic=True)
    assert [tuple(r) for r in read_dataset(spark, path, fmt).collect()] == [(4.5,)]
    with pytest.raises(Exception, match="too long"):
        write_dataset(one.select("s"), path, fmt, atomic=True, varchar_limits={"s": 1})
    assert [tuple(r) for r in read_dataset(spark, path, fmt).collect()] == [(4.5,)]


def test_purchase_schema_round_trip(spark, tmp_path):
    t = table_at(spark, tmp_path / "t")
    t.create(USER_PURCHASE, USER_PURCHASE_VARCHAR)
    assert [(f.name, f.dataType) for f in t.read().schema] == [(f.name, f.dataType) for f in USER_PURCHASE]
