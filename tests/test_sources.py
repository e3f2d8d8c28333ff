import datetime as dt
from decimal import Decimal

import pytest

from strata.schemas import USER_PURCHASE
from strata.sources import read_bronze_csv, read_csv_typed, read_dataset

HEADER = "invoice_number,stock_code,detail,quantity,invoice_date,unit_price,customer_id,country\n"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_quotes_commas_and_newlines(spark, write_text):
    path = write_text(HEADER + '1,A,"a, ""q"" b",2,2010-12-01 08:26:00,1.5,7,UK\n'
                               '2,B,"line1\nline2",3,2010-12-01,2.25,8,FR\n')
    got = sorted(rows(read_csv_typed(spark, path)))
    assert got[0][2] == 'a, "q" b'
    assert got[1][2] == "line1\nline2"
    assert got[0][4] == dt.datetime(2010, 12, 1, 8, 26)
    assert got[1][4] == dt.datetime(2010, 12, 1)
    assert len(got) == 2


def test_empty_is_null_quoted_empty_is_empty(spark, write_text):
    path = write_text(HEADER + '1,,"",,,,,UK\n')
    (r,) = rows(read_csv_typed(spark, path))
    assert r[1] is None          # unquoted empty string field
    assert r[2] == ""            # quoted empty string field
    assert r[3] is None and r[4] is None and r[5] is None and r[6] is None


def test_decimal_rounds_half_up(spark, write_text):
    path = write_text(HEADER + "1,A,d,1,2010-12-01 08:26:00,1.2345,7,UK\n")
    assert rows(read_csv_typed(spark, path))[0][5] == Decimal("1.235")


def test_duplicates_kept_and_header_mapped_by_position(spark, write_text):
    other_header = "a,b,c,d,e,f,g,h\n"
    line = "1,A,d,1,2010-12-01 08:26:00,1.5,7,UK\n"
    df = read_csv_typed(spark, write_text(other_header + line + line))
    assert df.count() == 2 and df.columns == [f.name for f in USER_PURCHASE]


@pytest.mark.parametrize("bad_line", [
    "1,A,d,zz,2010-12-01 08:26:00,1.5,7,UK",           # bad int
    "1,A,d,99999999999,2010-12-01 08:26:00,1.5,7,UK",  # int overflow
    "1,A,d,1,2010-12-01 08:26:00,1.5,7",               # 7 columns
    "1,A,d,1,2010-12-01 08:26:00,1.5,7,UK,extra",      # 9 columns
    "1,A,d,1,2010-12-01 08:26:00,123456.1,7,UK",       # decimal(8,3) overflow
    "1,A,d,1,12/1/2010 8:26,1.5,7,UK",                 # unsupported date style
    "12345678901,A,d,1,2010-12-01 08:26:00,1.5,7,UK",  # VARCHAR(10) exceeded
])
def test_bad_row_fails_whole_read(spark, write_text, bad_line):
    good = "1,A,d,1,2010-12-01 08:26:00,1.5,7,UK\n"
    df = read_csv_typed(spark, write_text(HEADER + good + bad_line + "\n"))
    with pytest.raises(Exception):
        df.collect()


def test_explicit_timestamp_format(spark, write_text):
    path = write_text(HEADER + "1,A,d,1,12/1/2010 8:26,1.5,7,UK\n")
    df = read_csv_typed(spark, path, timestamp_format="M/d/yyyy H:mm")
    assert rows(df)[0][4] == dt.datetime(2010, 12, 1, 8, 26)


def test_varchar_trailing_blanks_are_cut(spark, write_text):
    path = write_text(HEADER + '"1234567890   ",A,d,1,2010-12-01 08:26:00,1.5,7,UK\n')
    assert rows(read_csv_typed(spark, path))[0][0] == "1234567890"


def test_bronze_kinds(spark, write_text):
    path = write_text('customer_id,review_id,review_text\n1,2,"nice, ""very"" nice"\n')
    assert rows(read_bronze_csv(spark, path, "movie_review")) == [(1, 2, 'nice, "very" nice')]
    with pytest.raises(KeyError):
        read_bronze_csv(spark, path, "nope")


def test_unknown_dataset_format(spark, tmp_path):
    with pytest.raises(ValueError):
        read_dataset(spark, str(tmp_path), "excel")


@pytest.mark.parametrize("body, name", [
    ("1,A,d,1,2010-12-01 08:26:00,1.5,7,UK\n   \n", "blank.csv"),              # a line of blanks
    ('1,A,5" pipe,1,2010-12-01 08:26:00,1.5,7,UK\n' * 9, "stray.csv"),          # a stray quote
    ('1,A,"a\rb",1,2010-12-01 08:26:00,1.5,7,UK\n' * 9, "cr.csv"),             # CR in a field
    ("1,A,d,1,2010-12-01 08:26:00,1.5,7,UK\n" * 9, "up[1].csv"),
])
def test_split_size_does_not_change_the_result(spark, tmp_path, body, name):
    (tmp_path / name).write_text(HEADER + body)

    def outcome(split):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            return sorted(rows(read_csv_typed(spark, str(tmp_path))))
        except Exception as exc:  # noqa: BLE001 - failing alike is alike too
            return type(exc).__name__
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")

    assert outcome("64b") == outcome("128m")


def test_files_with_fields_spanning_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + '1,A,"x, ""y""",1,2010-12-01 08:26:00,1.5,7,UK\n' * 3)
    (tmp_path / "b.csv").write_text(HEADER + '2,B,"two\nlines",2,2010-12-01 08:26:00,2.5,8,FR\n')
    got = sorted(rows(read_csv_typed(spark, str(tmp_path))))
    assert [r[2] for r in got] == ['x, "y"'] * 3 + ["two\nlines"]


def test_line_mode_rejects_embedded_newline(spark, write_text):
    path = write_text(HEADER + '2,B,"two\nlines",2,2010-12-01 08:26:00,2.5,8,FR\n')
    with pytest.raises(Exception):
        read_csv_typed(spark, path, multi_line=False).collect()


def test_line_mode_splits_a_large_file(spark, tmp_path):
    folder = tmp_path / "big dir"
    folder.mkdir()
    line = "1,A,d,1,2010-12-01 08:26:00,1.5,7,UK\n"
    (folder / "one.csv").write_text(HEADER + line * 200_000)
    df = read_csv_typed(spark, str(folder), multi_line=False)
    assert df.rdd.getNumPartitions() > 1
    assert df.count() == 200_000


def test_blank_line_skipped(spark, write_text):
    path = write_text(HEADER + "1,A,d,1,2010-12-01 08:26:00,1.5,7,UK\n\n2,B,e,2,,,8,FR\n")
    assert read_csv_typed(spark, path).count() == 2


@pytest.mark.parametrize("line", [
    '2,B,e,"",2010-12-01,1.5,8,FR',   # int
    '2,B,e,1,2010-12-01,"",8,FR',     # decimal
    '2,B,e,1,"",1.5,8,FR',            # timestamp
])
def test_quoted_empty_non_text_is_rejected(spark, write_text, line):
    df = read_csv_typed(spark, write_text(HEADER + line + "\n"))
    with pytest.raises(Exception):
        df.collect()


def test_column_pruning_hides_unread_bad_field(spark, write_text):
    path = write_text(HEADER + "1,A,d,zz,2010-12-01 08:26:00,1.5,7,UK\n")
    df = read_csv_typed(spark, path)
    assert [r.country for r in df.select("country").collect()] == ["UK"]
    with pytest.raises(Exception):
        df.collect()


def test_quantile_slices_of_skewed_keys(spark):
    import random

    from strata.sources.tables import quantile_predicates

    r = random.Random(4)
    keys = [7] * 3000 + [int(r.paretovariate(0.7)) for _ in range(6000)] + [10**12] + [None] * 50 + [-5, 0]
    predicates = quantile_predicates("k", r.sample(keys, 2000), 16)
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    sizes = list(rows.selectExpr(*[f"count_if({p})" for p in predicates]).first())
    assert sum(sizes) == len(keys) and len(predicates) <= 16
    alone = [p for p in predicates if p.startswith("k >= 7 AND k < ")]
    assert len(alone) == 1 and max(s for s, p in zip(sizes, predicates) if p not in alone and "k < 2" not in p) < 0.2 * len(keys)
    even = quantile_predicates("k", range(1000), 8)
    assert len(even) == 8 and all(90 <= sum(eval(p.replace("AND", "and").replace("OR k IS NULL", ""), {"k": k}) for k in range(1000)) <= 160
                                  for p in even)


def test_quantile_slices_of_other_values():
    import datetime

    from strata.sources.tables import quantile_predicates

    assert quantile_predicates("k", [], 8) == quantile_predicates("k", [None], 8) == quantile_predicates("k", [3, 3], 8) == ["1 = 1"]
    assert quantile_predicates("k", ["a", "it's"], 2) == ["k < 'it''s' OR k IS NULL", "k >= 'it''s'"]
    assert quantile_predicates("d", [datetime.date(2020, 1, 1), datetime.date(2021, 1, 1)], 2)[1] == "d >= '2021-01-01'"
    with pytest.raises(TypeError):
        quantile_predicates("k", [1.5, 2.5], 2)
    with pytest.raises(ValueError):
        quantile_predicates("k", [1], 0)
