"""CSV records found in parallel: equal to the whole-file parser, and bad records by name."""

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from strata.plans.jobs import user_purchase_job
from strata.schemas import USER_PURCHASE
from strata.session import scratch_table
from strata.sources.csv import csv_read_options, naming_bad_csv_record, read_csv_typed
from strata.sources.records import BadRecordError, csv_records, first_bad_record
from strata.streaming.arrival import arrival_load

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.StringType())])


@pytest.fixture
def small_splits(spark):
    """Splits of some ten bytes, so records span several of them."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    old = {n: spark.conf.get(n, None) for n in names}

    def set_to(size):
        for n, v in zip(names, (str(size), "1", "1")):
            spark.conf.set(n, v)

    yield set_to
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def text_of(rows, end, quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end, quoting=quoting)
    writer.writerows([("a", "b", "c"), *rows])
    return out.getvalue()


def random_rows(seed, n):
    r = random.Random(seed)
    parts = ["x", "é", ",", '"', "\n", "\r\n", "word", " ", '""', "\n\n", "1"]
    return [("".join(r.choice(parts) for _ in range(r.randrange(9))), r.choice([1, 2, "", -7]),
             r.choice(["", "plain", "two\nlines", 'say "hi"', "z" * 70])) for _ in range(n)]


def plain_ends(rows):
    """The whole-file parser writes a field's CR LF as LF where the records end with CR LF."""
    return sorted((tuple(x.replace("\r\n", "\n") if isinstance(x, str) else x for x in r) for r in rows), key=str)


@pytest.mark.parametrize("size,end", [(37, "\n"), (100_000, "\n"), (61, "\r\n")])
def test_split_reading_equals_the_whole_file_parser(spark, tmp_path, small_splits, size, end):
    for i in range(2):
        (tmp_path / f"f{i}.csv").write_bytes(text_of(random_rows(i, 25), end).encode())
    quoted = [(a, b or 5, c) for a, b, c in random_rows(2, 25)]  # a quoted empty field is no number
    (tmp_path / "f2.csv").write_bytes(text_of(quoted, end, csv.QUOTE_ALL).encode())
    (tmp_path / "only_header.csv").write_text("a,b,c\n")
    (tmp_path / "empty.csv").write_text("")
    whole = read_csv_typed(spark, str(tmp_path), SCHEMA).collect()
    small_splits(size)
    split = read_csv_typed(spark, str(tmp_path), SCHEMA, multi_line="split").collect()
    assert plain_ends(split) == plain_ends(whole) and len(whole) == 75
    source = [*random_rows(0, 25), *random_rows(1, 25), *quoted]
    assert sorted(map(tuple, split), key=str) == sorted([tuple(x if x != "" or (j != 1 and i >= 50) else None for j, x in enumerate(r))
                                                         for i, r in enumerate(source)], key=str)


def test_one_field_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f'line {i}, "{i}"' for i in range(60))
    (tmp_path / "f.csv").write_text(text_of([("first", 1, ""), (long, 2, "x"), ("last", 3, "no newline at the end")], "\n")[:-1])
    small_splits(50)
    rows = {r["b"]: (r["a"], r["c"]) for r in read_csv_typed(spark, str(tmp_path), SCHEMA, multi_line="split").collect()}
    assert rows == {1: ("first", ""), 2: (long, "x"), 3: ("last", "no newline at the end")} or rows[1] == ("first", None)
    assert rows[2][0] == long


def test_options_of_the_whole_file_parser_hold(spark, tmp_path):
    (tmp_path / "f.csv").write_text('x;1;"p;\nq"\n;;""\n')
    for options in ({"header": False, "delimiter": ";"}, {"header": True, "delimiter": ";"}):
        whole = read_csv_typed(spark, str(tmp_path), SCHEMA, **options)
        split = read_csv_typed(spark, str(tmp_path), SCHEMA, multi_line="split", **options)
        assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    with pytest.raises(ValueError):
        read_csv_typed(spark, str(tmp_path), SCHEMA, multi_line="parallel")


@pytest.mark.parametrize("size", [9, 100_000])
@pytest.mark.parametrize("text", ['a,b,c\n5" pipe,1,x\nlong 6" pipe,2,y\nz,3,z\n', 'a,b,c\n"open,1,x\nz,3,z\n'])
def test_quotes_that_are_no_field_quotes_fail(spark, tmp_path, small_splits, size, text):
    (tmp_path / "f.csv").write_text(text)
    small_splits(size)
    with pytest.raises(Exception, match="quote"):
        read_csv_typed(spark, str(tmp_path), SCHEMA, multi_line="split").collect()


HEAD = "invoice_number,stock_code,detail,quantity,invoice_date,unit_price,customer_id,country\n"
GOOD = '1,a,"two\nlines",2,2010-12-01 08:26:00,1.5,7,Spain\n'


@pytest.mark.parametrize("bad,column,reason", [
    (GOOD.replace(",2,", ",two,"), "quantity", "'two' is no int"),
    (GOOD.replace("2010-12-01", "1/12/2010"), "invoice_date", "timestamp_ntz"),
    (GOOD.replace("1.5", "123456.5"), "unit_price", "decimal(8,3)"),
    (GOOD.replace(",7,Spain", ",7"), None, "7 fields for 8 columns"),
    (GOOD.replace("Spain", "Spain,x"), None, "9 fields for 8 columns"),
    (GOOD.replace("Spain", "A country of too many letters"), "country", "VARCHAR(20)"),
])
def test_a_bad_record_is_named(spark, tmp_path, small_splits, bad, column, reason):
    (tmp_path / "b.csv").write_text(HEAD + GOOD * 20 + bad + GOOD * 3 + bad)
    (tmp_path / "a.csv").write_text(HEAD + GOOD * 3)
    small_splits(64)
    found = first_bad_record(spark, str(tmp_path), USER_PURCHASE, csv_read_options(), {"country": 20})
    assert found.file.endswith("/b.csv") and (found.record, found.column) == (22, column) and reason in str(found)


def test_loads_name_the_bad_record(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(HEAD + GOOD + GOOD.replace(",7,", ",x7,"))
    with pytest.raises(BadRecordError, match="a.csv, record 3, column customer_id: 'x7' is no int"):
        arrival_load(spark, str(landing), scratch_table(spark, "named"), str(tmp_path / "ckpt"))
    with pytest.raises(BadRecordError, match="record 3"):
        user_purchase_job(spark, str(landing), str(tmp_path / "out"))
    with pytest.raises(ZeroDivisionError), naming_bad_csv_record(spark, str(landing / "none"), USER_PURCHASE):
        raise ZeroDivisionError
    good = tmp_path / "good"
    good.mkdir()
    (good / "a.csv").write_text(HEAD + GOOD)
    with pytest.raises(ZeroDivisionError), naming_bad_csv_record(spark, str(good), USER_PURCHASE):
        raise ZeroDivisionError


def test_records_are_numbered_along_their_file(spark, tmp_path, small_splits):
    rows = random_rows(5, 15)
    (tmp_path / "f.csv").write_text(text_of(rows, "\n"))
    small_splits(20)
    found = csv_records(spark, str(tmp_path))
    got = [r["record"] for r in found.records.orderBy("split", "at").collect()]
    assert got == [text_of([r], "\n").split("\n", 1)[1][:-1] for r in [("a", "b", "c"), *rows]]
