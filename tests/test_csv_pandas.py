"""All-text CSV reading against pandas on random files."""

import csv
import io

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from parceltrail.sources.csv_text import NA_TOKENS, read_text_csv

cells = st.one_of(
    st.text(alphabet='ab",\n é', max_size=5),
    st.sampled_from(NA_TOKENS),
    st.sampled_from(NA_TOKENS).map(lambda token: f" {token}"),
)


def expected_rows(text):
    frame = pd.read_csv(io.StringIO(text), dtype=str)
    return [tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False)]


def spark_frame(spark, folder, text):
    path = folder / "in.csv"
    path.write_bytes(text.encode("utf-8"))
    return read_text_csv(spark, str(path)).drop("source_file")


def spark_rows(spark, folder, text):
    return [tuple(r) for r in spark_frame(spark, folder, text).coalesce(1).collect()]


@settings(
    max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    rows=st.lists(st.tuples(st.integers(0, 9).map(str), cells, cells), min_size=1, max_size=6),
    quoting=st.sampled_from([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]),
    end=st.sampled_from(["\n", "\r\n"]),
)
def test_random_files(spark, tmp_path, rows, quoting, end):
    out = io.StringIO()
    csv.writer(out, quoting=quoting, lineterminator=end).writerows([("id", " v", "w "), *rows])
    assert spark_rows(spark, tmp_path, out.getvalue()) == expected_rows(out.getvalue())


@pytest.mark.parametrize(
    "text",
    [
        "a,b\n1,x\n\n  \n2,y\n",
        "a,b\n1\n2,y\n",
        "\ufeffa,b\n1,x\n",
        'a,b\n1,"x\r\ny"\n',
        'a,b\r\n1,"x\r\ny"\r\n',
        'a,b\n1,x"y"z\n',
        'a,b\r\n1,"x\ny"\r\n2,"x\ry"\r\n',
        '\ufeffa,b\n1,"x\ny"\n',
        '\ufeffa,b\r\n1,"x\ny"\r\n',
        'a,b\r1,x\r2,y\r',
        "a,b\n1,\\\n2,\\x\n",
        "a,b\n1,x",
        "a,b\n1,#x\n#2,y\n",
    ],
)
def test_edge_cases(spark, tmp_path, text):
    assert spark_rows(spark, tmp_path, text) == expected_rows(text)


@pytest.mark.parametrize(
    "header", ["a,b", " a ,b ", "a,a", "b,a", ",b", "a,", '"",b', '"x,y",b', '"x\ny",b', "NA,b", "_c0,"]
)
def test_headers(spark, tmp_path, header):
    text = f"{header}\n1,x\n2,\n"
    names = [c.strip() for c in pd.read_csv(io.StringIO(text), dtype=str).columns]
    df = spark_frame(spark, tmp_path, text)
    assert df.columns == names
    assert spark_rows(spark, tmp_path, text) == [("1", "x"), ("2", None)]
