import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import export_csv, guarded_export, write_dataset
from strata.schemas import USER_PURCHASE, USER_PURCHASE_VARCHAR
from strata.sources import read_csv_typed, read_dataset

ROWS = [
    ("1", None, "", 1, dt.datetime(2010, 12, 1, 8, 26), Decimal("1.500"), None, "UK"),
    ("2", "B", 'a, "q"\nb', None, dt.datetime(2024, 1, 1, 0, 0, 7, 179575), None, 8, " FR "),
]


def test_export_roundtrip_keeps_nulls_empties_quotes_newlines_blanks(spark, tmp_path):
    df = spark.createDataFrame(ROWS, USER_PURCHASE)
    path = export_csv(df, str(tmp_path / "out"))
    back = sorted(tuple(r) for r in read_csv_typed(spark, path).collect())
    assert back == sorted(ROWS)


def test_export_prints_plain_timestamps(spark, tmp_path):
    df = spark.createDataFrame(ROWS[:1], USER_PURCHASE)
    path = export_csv(df, str(tmp_path / "out"))
    texts = [open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".csv")]
    text = "".join(texts)
    assert "2010-12-01 08:26:00" in text and "T08" not in text
    assert all(t.splitlines()[0].startswith("invoice_number,stock_code") for t in texts if t)


def test_conflate_empty(spark, tmp_path):
    df = spark.createDataFrame(ROWS[:1], USER_PURCHASE)
    path = export_csv(df, str(tmp_path / "out"), conflate_empty=True)
    assert read_csv_typed(spark, path).first()["detail"] is None


def test_guarded_export_skips_empty_and_keeps_old(spark, tmp_path):
    df = spark.createDataFrame(ROWS, USER_PURCHASE)
    path = str(tmp_path / "g")
    assert guarded_export(df.where(F.lit(False)), path).status == "skipped"
    assert not os.path.exists(path)
    assert guarded_export(df, path).status == "exported"
    assert guarded_export(df.where(F.lit(False)), path).status == "skipped"
    assert read_csv_typed(spark, path).count() == 2


def test_failed_overwrite_keeps_old_dataset(spark, tmp_path):
    df = spark.createDataFrame(ROWS, USER_PURCHASE)
    path = write_dataset(df, str(tmp_path / "ds"), "parquet")
    bad = df.withColumn("quantity", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception):
        write_dataset(bad, path, "parquet")
    assert read_dataset(spark, path, "parquet").count() == 2


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv", "xml"])
def test_dataset_formats_roundtrip(spark, tmp_path, fmt):
    df = spark.createDataFrame(ROWS, USER_PURCHASE)
    path = write_dataset(df, str(tmp_path / fmt), fmt)
    back = sorted(tuple(r) for r in read_dataset(spark, path, fmt, USER_PURCHASE).collect())
    assert back == sorted(ROWS)


def test_write_dataset_varchar_check(spark, tmp_path):
    df = spark.createDataFrame([("x" * 11,) + ROWS[0][1:]], USER_PURCHASE)
    with pytest.raises(Exception):
        write_dataset(df, str(tmp_path / "v"), "parquet", varchar_limits=USER_PURCHASE_VARCHAR)


def test_avro_needs_module(spark, tmp_path):
    df = spark.createDataFrame(ROWS, USER_PURCHASE)
    with pytest.raises(Exception):
        write_dataset(df, str(tmp_path / "a"), "avro")


def test_failed_write_leaves_no_staging(spark, tmp_path):
    df = spark.createDataFrame(ROWS, USER_PURCHASE)
    bad = df.withColumn("quantity", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception):
        export_csv(bad, str(tmp_path / "x"))
    with pytest.raises(Exception):
        write_dataset(bad, str(tmp_path / "y"), "parquet")
    assert os.listdir(tmp_path) == []


def test_replaced_export_leaves_only_target(spark, tmp_path):
    df = spark.createDataFrame(ROWS, USER_PURCHASE)
    export_csv(df, str(tmp_path / "x"))
    export_csv(df, str(tmp_path / "x"))
    assert os.listdir(tmp_path) == ["x"]


def test_one_column_csv_keeps_nulls(spark, tmp_path):
    from pyspark.sql import types as T

    from strata.operators import write_dataset
    from strata.sources import read_dataset

    schema = T.StructType([T.StructField("a", T.StringType())])
    path = write_dataset(spark.createDataFrame([("x",), (None,), ("",)], schema), str(tmp_path / "one"), "csv")
    assert sorted((r.a for r in read_dataset(spark, path, "csv", schema).collect()), key=str) == ["", None, "x"]


@pytest.mark.parametrize("fmt", ["csv", "json", "xml"])
@pytest.mark.parametrize("width", [3, 2000])
def test_files_are_bounded_by_bytes(spark, tmp_path, fmt, width):
    rows = 40_000 if width == 3 else 400
    df = spark.range(0, rows, 1, 2).selectExpr("id", f"repeat('x', {width}) as s", "cast(id / 7 as decimal(10,3)) as d")
    path = str(tmp_path / fmt)
    write_dataset(df, path, fmt, target_bytes=50_000)
    sizes = sorted(os.path.getsize(os.path.join(path, n)) for n in os.listdir(path) if n.startswith("part-"))
    full = sizes[2:]  # the last file of each of the two tasks may be short
    assert len(full) > 3 and all(25_000 <= n <= 100_000 for n in full) and sizes[-1] <= 100_000
    assert spark.read.format(fmt).options(header=True, rowTag="row").load(path).count() == rows


def test_only_text_files_are_bounded_by_bytes(spark, tmp_path):
    with pytest.raises(ValueError):
        write_dataset(spark.range(3), str(tmp_path / "p"), "parquet", target_bytes=1000)
    with pytest.raises(ValueError):
        export_csv(spark.range(3), str(tmp_path / "p"), target_bytes=1000, atomic=True)
    export_csv(spark.range(3).where("id > 5"), str(tmp_path / "e"), target_bytes=1000)


@pytest.mark.parametrize("fmt", ["json", "csv", "xml"])
def test_compressed_text_datasets_are_small_and_keep_every_row(spark, tmp_path, fmt):
    df = spark.createDataFrame(ROWS * 2000, USER_PURCHASE).coalesce(1)
    sizes = {}
    for codec in (None, "gzip"):
        path = write_dataset(df, str(tmp_path / f"{fmt}-{codec}"), fmt, compression=codec, max_records_per_file=1500)
        parts = [f for f in os.listdir(path) if f.startswith("part-")]
        assert len(parts) == 3 and all(f.endswith(".gz") == bool(codec) for f in parts)
        sizes[codec] = sum(os.path.getsize(os.path.join(path, f)) for f in parts)
        assert read_dataset(spark, path, fmt, USER_PURCHASE).exceptAll(df).isEmpty()
        assert df.exceptAll(read_dataset(spark, path, fmt, USER_PURCHASE)).isEmpty()
    assert sizes["gzip"] * 5 < sizes[None]


def test_format_roundtrip_writes_text_formats_compressed(spark, monkeypatch):
    from strata.plans import registry

    paths = []
    monkeypatch.setattr(registry, "write_dataset", lambda *a, **k: paths.append(write_dataset(*a, **k)) or paths[-1])
    got = registry.q_dataset_format_roundtrip(spark, "/root/testdata/sf0.001")
    assert {r["count"] for r in got.groupBy("fmt").count().collect()} == {got.where("fmt = 'parquet'").count()}
    parts = {p: [f for _, _, fs in os.walk(p.removeprefix("file:")) for f in fs if f.startswith("part-")] for p in paths}
    assert len(parts) == 5 and all(parts.values())
    assert all(f.endswith(".gz") for p, fs in parts.items() if "parquet" not in p and "orc" not in p for f in fs)
