"""Files with line breaks in fields, read block by block, against pandas."""

import io
import random

import pandas as pd
import pytest

from parceltrail.sources import csv_text
from parceltrail.sources.csv_text import read_text_csv


@pytest.fixture
def small_blocks(spark):
    """Function setting the bytes of a block."""
    settings = {"spark.sql.files.maxPartitionBytes": "", "spark.sql.files.openCostInBytes": "1"}
    before = {key: spark.conf.get(key) for key in settings}

    def cut(size):
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield cut
    for key, value in before.items():
        spark.conf.set(key, value)


def expected(files):
    rows = []
    for name, text in files.items():
        frame = pd.read_csv(io.StringIO(text, newline=""), dtype=str)
        rows += [tuple(None if pd.isna(v) else v for v in row) + (name,) for row in frame.itertuples(index=False)]
    return sorted(rows, key=repr)


def found(spark, folder, files, **how):
    for name, text in files.items():
        (folder / name).write_bytes(text.encode())
    df = read_text_csv(spark, str(folder), block_above=0, **how)
    return sorted((tuple(r) for r in df.collect()), key=repr)


def field(rng, end):
    """Quoted with breaks and doubled quotes, plain, empty, or with a lone quote that means itself."""
    kind = rng.randrange(8)
    if kind < 3:
        inside = "".join(rng.choice(["a", "é", ",", '""', end, end, " ", "x,y"]) for _ in range(rng.randrange(12)))
        return f'"{inside}"'
    return ("" if kind == 3 else f'{rng.randrange(99)}" wide' if kind == 4 else f"t{rng.randrange(999)}")


def random_file(seed, end, n=40):
    rng = random.Random(seed)
    lines = [f'id,"the{end}note"," w "' if seed % 2 else "id,note,w"]
    for i in range(n):
        lines.append(f"{i},{field(rng, end)},{field(rng, end)}")
        if rng.random() < 0.1:
            lines.append("")
    return end.join(lines) + (end if rng.random() < 0.5 else "")


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("size", [16, 60, 1000])
def test_random_files(spark, tmp_path, small_blocks, end, size):
    files = {f"{s}.csv": random_file(2 * s + size % 2, end) for s in range(4)}
    small_blocks(size)
    assert found(spark, tmp_path, files) == expected(files)


def test_a_record_over_many_blocks_and_blocks_without_records(spark, tmp_path, small_blocks):
    long = "\n".join(f'line {i}, with ""quotes""' for i in range(40))
    files = {"a.csv": f'a,b\n1,"{long}"\n2,x\n3,"{long}"\n4,"y\nz"\n', "b.csv": f'a,b\n1,"{long}"\n'}
    small_blocks(50)
    assert found(spark, tmp_path, files) == expected(files)


def test_files_of_all_ends_and_sizes_in_one_folder(spark, tmp_path, small_blocks):
    files = {f"{n}.csv": random_file(6, end) for n, end in (("lf", "\n"), ("crlf", "\r\n"), ("cr", "\r"))}
    files["clean.csv"] = "id,note,w\n5,plain,row\n"
    small_blocks(100)
    assert found(spark, tmp_path, files) == expected(files)


def test_other_ends_inside_quotes_are_kept(spark, tmp_path, small_blocks):
    files = {
        "lf.csv": 'a,b\n1,"x\r\ny\rz"\n2,"p\nq"\n',
        "crlf.csv": 'a,b\r\n1,"x\ny\rz"\r\n2,"p\r\nq"\r\n',
    }
    small_blocks(10)
    assert found(spark, tmp_path, files) == expected(files)


@pytest.mark.parametrize(
    "text, message",
    [
        ('a,b\n1,"x\ny"\n2,z\r\n3,w\n', "LF and in CRLF in in.csv"),
        ('a,b\r\n1,"x\r\ny"\r\n2,z\n3,w\r\n', "LF and in CRLF in in.csv"),
        ('a,b\n1,"x\ny",z\n', "expected 2 fields in in.csv"),
        ('a,b\n1,"x\ny"z\n', "(?i)quote"),
        ('a,b,c\n1,"x\ny,z\n', "expected 3 fields in in.csv"),
    ],
)
@pytest.mark.parametrize("size", [8, 1000])
def test_malformed_files_fail(spark, tmp_path, small_blocks, text, message, size):
    small_blocks(size)
    with pytest.raises(Exception, match=message):
        found(spark, tmp_path, {"in.csv": text}, multi_line=True)


def test_short_rows(spark, tmp_path, small_blocks):
    small_blocks(8)
    files = {"in.csv": 'a,b,c\n1,"x\ny"\n2,z,w\n'}
    assert found(spark, tmp_path, files) == [("1", "x\ny", None, "in.csv"), ("2", "z", "w", "in.csv")]
    with pytest.raises(Exception, match="expected 3 fields"):
        found(spark, tmp_path, files, pad_short=False)


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    """By size alone, and its lines are not gathered in one task."""
    lines = "".join(f'{i},"break\nin {i}"\n' for i in range(60_000))
    (tmp_path / "large.csv").write_text("id,note\n" + lines)
    small_blocks(200_000)
    df = read_text_csv(spark, str(tmp_path))
    look = csv_text.look_at_files(spark, str(tmp_path))
    assert len(look.in_blocks) == 1
    assert csv_text._records(spark, str(tmp_path), list(look.in_blocks), "\n").rdd.getNumPartitions() > 1
    scans = spark.read.text(str(tmp_path), lineSep="\n")
    assert scans.rdd.getNumPartitions() > 5
    assert sorted((int(r.id), r.note) for r in df.collect()) == [(i, f"break\nin {i}") for i in range(60_000)]


def test_a_file_ended_by_cr_is_not_one_row(spark, tmp_path, monkeypatch):
    """Above the line limit no line is read whole to find out how lines end."""
    monkeypatch.setattr(csv_text, "LONGEST", 100)
    text = "id,note\r" + "".join(f'{i},"x\ry"\r' for i in range(200))
    (tmp_path / "cr.csv").write_bytes(text.encode())
    look = csv_text.look_at_files(spark, str(tmp_path))
    assert list(look.record_wise) == ["\r"]
    assert read_text_csv(spark, str(tmp_path), block_above=0).count() == 200


@pytest.mark.parametrize("line", ['a,"b', 'a,"b"', '"', '""', '"a""', 'a"b', 'x,"a","b', '"a",b"', '"a"b,"c', ",,", '"a","b""'])
def test_lines_as_functions(spark, line):
    """Ends inside, started outside and inside, against a machine that reads character by character."""
    from pyspark.sql import functions as F

    def ends_inside(text, inside):
        at, start = 0, not inside
        while at < len(text):
            c = text[at]
            if inside:
                if c == '"' and text[at + 1 : at + 2] == '"':
                    at += 1
                elif c == '"':
                    inside, start = False, False
            elif c == '"' and start:
                inside = True
            start = not inside and c == ","
            at += 1
        return inside

    df = spark.createDataFrame([(line,)], "v string")
    one = df.select(F.col("v").rlike(csv_text._FROM_OUTSIDE), F.col("v").rlike(csv_text._FROM_INSIDE)).first()
    assert tuple(one) == (ends_inside(line, False), ends_inside(line, True))
