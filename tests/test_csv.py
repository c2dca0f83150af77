"""All-text CSV reading."""

import io
from datetime import datetime

import pandas as pd
import pytest

from parceltrail.plans.bronze import load_csv
from parceltrail.sources.csv_text import NA_TOKENS, files_with_breaks, read_text_csv

SAMPLE = """id ,v,w
1,"a ""q"" b",NA
2,"line1
line2",
3,NULL, x 
4,nan,None
"""


@pytest.fixture
def csv(tmp_path):
    def write(text, name="in.csv"):
        (tmp_path / name).write_text(text, encoding="utf-8")
        return str(tmp_path)

    return write


def rows(df):
    return sorted(tuple(r) for r in df.drop("source_file").collect())


def test_sample(spark, csv):
    df = read_text_csv(spark, csv(SAMPLE))
    assert df.columns == ["id", "v", "w", "source_file"]
    assert {t for _, t in df.dtypes} == {"string"}
    found = [tuple(r)[:3] for r in df.orderBy("id").collect()]
    assert found == [
        ("1", 'a "q" b', None),
        ("2", "line1\nline2", None),
        ("3", None, " x "),
        ("4", None, None),
    ]


def test_break_that_looks_like_a_full_row(spark, csv):
    # Read line by line, both halves would have three fields and pass unnoticed.
    path = csv('a,b,c\n1,x,"one\n2,y,z"\n')
    assert len(files_with_breaks(spark, path)) == 1
    assert rows(read_text_csv(spark, path)) == [("1", "x", "one\n2,y,z")]


def test_lone_quote_in_unquoted_field(spark, csv):
    assert rows(read_text_csv(spark, csv('a,b\n1,5" pipe\n2,x\n'))) == [("1", '5" pipe'), ("2", "x")]


def test_no_breaks_found_without_odd_quotes(spark, csv):
    assert files_with_breaks(spark, csv('a,b\n1,"x ""y"" z"\n')) == []


@pytest.mark.parametrize("multi_line", [True, False])
def test_short_row_is_padded(spark, csv, multi_line):
    path = csv("a,b,c\n1,x,y\n5,short\n")
    found = read_text_csv(spark, path, multi_line=multi_line).orderBy("a").collect()
    assert tuple(found[1])[:3] == ("5", "short", None)


@pytest.mark.parametrize("multi_line", [True, False])
def test_short_row_fails_on_request(spark, csv, multi_line):
    path = csv("a,b,c\n1,x,y\n5,short\n")
    with pytest.raises(Exception, match="expected 3 fields in in.csv, got: 5,short"):
        read_text_csv(spark, path, multi_line=multi_line, pad_short=False).collect()


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("select", [["a"], ["c"], ["source_file"]])
def test_long_row_fails_whatever_is_selected(spark, csv, multi_line, select):
    path = csv('a,b,c\n1,x,y\n6,"a,a",b,c\n')
    with pytest.raises(Exception, match="expected 3 fields"):
        read_text_csv(spark, path, multi_line=multi_line).select(*select).collect()


def test_long_row_fails_a_count(spark, csv):
    with pytest.raises(Exception, match="expected 3 fields"):
        read_text_csv(spark, csv("a,b,c\n6,a,b,c\n"), multi_line=False).count()


@pytest.mark.parametrize("multi_line", [None, True, False])
def test_unfinished_quote_in_a_short_row_fails(spark, csv, multi_line):
    with pytest.raises(Exception, match="expected 3 fields"):
        read_text_csv(spark, csv('a,b,c\n1,"x\n'), multi_line=multi_line).collect()


def test_break_in_a_file_declared_line_wise_fails(spark, csv):
    with pytest.raises(Exception, match="expected 3 fields"):
        read_text_csv(spark, csv('a,b,c\n1,"x\ny",z\n'), multi_line=False).collect()


@pytest.mark.parametrize("multi_line", [None, True, False])
def test_text_after_a_closing_quote_fails(spark, csv, multi_line):
    with pytest.raises(Exception, match="(?i)quote"):
        read_text_csv(spark, csv('a,b\n1,"x"y\n'), multi_line=multi_line).collect()


def test_quoted_commas_do_not_make_a_row_long(spark, csv):
    assert rows(read_text_csv(spark, csv('a,b,c\n1,"x,y,z"\n'))) == [
        ("1", "x,y,z", None)
    ]


def test_na_tokens(spark, csv):
    lines = "".join(f'{i},"{token}"," {token} "\n' for i, token in enumerate(NA_TOKENS))
    df = read_text_csv(spark, csv("id,v,padded\n" + lines))
    found = df.collect()
    assert len(found) == len(NA_TOKENS) and all(r.v is None for r in found)
    assert {r.padded for r in found} == {f" {token} " for token in NA_TOKENS}


def test_other_words_are_kept(spark, csv):
    words = ["na", "Null", "NONE", "N/a", "0", "-", "NaNs"]
    found = read_text_csv(spark, csv("v\n" + "\n".join(words) + "\n")).collect()
    assert sorted(r.v for r in found) == sorted(words)


def test_blank_lines_are_skipped(spark, csv):
    assert rows(read_text_csv(spark, csv("a,b\n1,x\n\n2,y\n"))) == [("1", "x"), ("2", "y")]


def test_header_only(spark, csv):
    df = read_text_csv(spark, csv("a,b\n"))
    assert df.columns == ["a", "b", "source_file"] and df.count() == 0


def test_empty_file_has_no_header(spark, csv):
    with pytest.raises(ValueError, match="no header"):
        read_text_csv(spark, csv(""))


def test_folder_of_files_and_source_names(spark, csv):
    csv("a,b\n1,x\n", "one.csv")
    path = csv("a,b\n2,y\n", "two.csv")
    found = {r.a: r.source_file for r in read_text_csv(spark, path).collect()}
    assert found == {"1": "one.csv", "2": "two.csv"}


@pytest.mark.parametrize("multi_line", [None, True])
@pytest.mark.parametrize("long_first", [True, False])
def test_files_with_different_line_ends(spark, tmp_path, multi_line, long_first):
    long = "".join(f'{i},"x\ny {i}"\n' for i in range(60))
    files = {
        "a.csv": "a,b\n" + (long if long_first else '1,"x\ny"\n'),
        "b.csv": "a,b\r\n" + ('2,"p\r\nq"\r\n' if long_first else long.replace("\n", "\r\n")),
        "c.csv": "a,b\r\n3,z\r\n",
        "d.csv": "a,b\n4,w\n",
        "e.csv": "a,b\r5,v\r",
    }
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode())
    found = read_text_csv(spark, str(tmp_path), multi_line=multi_line)
    assert found.columns == ["a", "b", "source_file"]
    expected = []
    for name, text in files.items():
        frame = pd.read_csv(io.StringIO(text, newline=""), dtype=str)
        expected += [(a, b, name) for a, b in frame.itertuples(index=False)]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_many_files_with_breaks_and_one_clean_file(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"{i}.csv").write_bytes(f'a,b\n{i},"x\ny"\n'.encode())
    (tmp_path / "clean.csv").write_bytes(b"a,b\r\n99,z\r\n")
    assert read_text_csv(spark, str(tmp_path)).count() == 31


def test_a_file_that_mixes_line_ends_fails_by_name(spark, tmp_path):
    (tmp_path / "mixed.csv").write_bytes(b'a,b\n1,"x\ny"\n2,z\r\n')
    with pytest.raises(Exception, match="LF and in CRLF in mixed.csv"):
        read_text_csv(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("multi_line", [None, True, False])
def test_repeated_names_in_another_order_fail_by_name(spark, csv, multi_line):
    csv("a,a,c\n1,2,3\n", "one.csv")
    path = csv("c,a,a\n1,2,3\n", "two.csv")
    with pytest.raises(ValueError, match="one.csv.*two.csv"):
        read_text_csv(spark, path, multi_line=multi_line)


def test_headers_may_differ_in_quotes(spark, csv):
    csv("a,b\n1,x\n", "one.csv")
    path = csv('"a","b"\n2,y\n', "two.csv")
    assert rows(read_text_csv(spark, path)) == [("1", "x"), ("2", "y")]


def test_three_spellings_of_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'id,note\n1,"x\ny"\n')
    (tmp_path / "b.csv").write_bytes(b'"id","note"\r\n2,"x\r\ny"\r\n')
    (tmp_path / "c.csv").write_bytes(b'id,"note"\n3,z\n')
    assert rows(read_text_csv(spark, str(tmp_path))) == [("1", "x\ny"), ("2", "x\r\ny"), ("3", "z")]


@pytest.mark.parametrize("multi_line", [None, True, False])
def test_a_third_header_with_other_names_fails(spark, csv, multi_line):
    csv("a,a,c\n1,2,3\n", "one.csv")
    csv('"a",a,c\n1,2,3\n', "three.csv")
    path = csv("c,a,a\n1,2,3\n", "two.csv")
    with pytest.raises(ValueError, match="different headers"):
        read_text_csv(spark, path, multi_line=multi_line)


def test_header_names_are_parsed_like_csv(spark):
    import csv as library

    from pyspark.sql import functions as F

    from parceltrail.sources.csv_text import _names

    lines = ["a,b", ' a ,"b"', '"a ""x"", y",,b', '"a"z,b"c', ",", "a", '"a', "\ufeffid, n", '"a",', '""', 'x,"","y""']
    df = spark.createDataFrame([(i, h) for i, h in enumerate(lines)], "i int, h string")
    found = [r.names for r in df.select("i", _names(F.col("h")).alias("names")).orderBy("i").collect()]
    assert found == [[c.strip() for c in next(library.reader([h.removeprefix("\ufeff")]))] for h in lines]


def test_mixed_files_hold_rows_without_id(spark, tmp_path):
    from parceltrail.queries import csv_mixed_files

    made = [(1, "a"), (2, "b\nc"), (None, "d"), (None, 'e"f'), (None, None), (3, None)]
    spark.createDataFrame(made, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = csv_mixed_files(spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, made))


def test_only_files_with_breaks_are_read_whole(spark, csv):
    csv('a,file_path\n1,"x\ny"\n', "one file%20.csv")
    path = csv("a,file_path\n2,z\n3,w\n", "two.csv")
    df = read_text_csv(spark, path)
    assert rows(df) == [("1", "x\ny"), ("2", "z"), ("3", "w")]
    plan = df._jdf.queryExecution().executedPlan()
    scans = [plan.collectLeaves().apply(i) for i in range(plan.collectLeaves().size())]
    assert sorted(s.selectedPartitions().totalNumberOfFiles() for s in scans) == [1, 1]


def test_files_with_different_headers_fail(spark, csv):
    csv("a,b\n1,x\n", "one.csv")
    path = csv("b,a\n2,y\n", "two.csv")
    with pytest.raises(Exception):
        read_text_csv(spark, path).collect()


def test_header_with_a_dot(spark, csv):
    df = read_text_csv(spark, csv("a.b, c`d\n1,NA\n"))
    assert df.columns == ["a.b", "c`d", "source_file"] and tuple(df.first())[:2] == ("1", None)


def test_audit_columns(spark, csv):
    now = datetime(2020, 5, 17, 12, 0, 0)
    df = load_csv(spark, csv("a\n1\n"), now)
    assert df.columns == ["a", "ingestion_date", "source_file"]
    assert dict(df.dtypes)["ingestion_date"] == "timestamp_ntz"
    assert tuple(df.first()) == ("1", now, "in.csv")
    assert load_csv(spark, csv("a\n1\n")).first().ingestion_date.year >= 2024


def test_audit_columns_of_the_file_are_replaced(spark, csv):
    df = load_csv(spark, csv("ingestion_date,a.b,source_file\nold,1,old.csv\n"), datetime(2020, 5, 17))
    assert df.columns == ["a.b", "ingestion_date", "source_file"]
    assert tuple(df.first()) == ("1", datetime(2020, 5, 17), "in.csv")
